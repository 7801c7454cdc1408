"""Incremental ingest: a file stream into a keyed, append-only table.

The stream's own checkpoint remembers which files are done; each micro-batch goes
into folders of its own, overwritten on replay, so a batch that is retried after a
failure neither doubles nor loses rows. Keys are deterministic, so a row that came
with an earlier file is recognised and not inserted again. The table is cut into buckets by
the hash of the key: a batch reads only the buckets that its keys fall into.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.operators import checks, merge
from sparkdraft.session import work_dir
from sparkdraft.sources import files


@dataclass(frozen=True)
class IncrementalTable:
    """Target of streams: ``<path>/bucket=<b>/stream=<name>/batch=<n>`` folders of one schema.

    ``buckets`` belongs to the table and must not change once it has rows.
    """

    spark: SparkSession
    path: str
    ddl: str
    key: Sequence[str]
    buckets: int = 16

    def rows(self, without: tuple[str, int] | None = None,
             buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets, or all but those of one (stream, batch)."""
        return self._stored(without, buckets).drop("bucket", "stream", "batch")

    def _stored(self, without: tuple[str, int] | None, buckets: Sequence[int] | None) -> DataFrame:
        ddl = self.ddl + ", bucket int, stream string, batch bigint"
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], ddl)
        df = self.spark.read.schema(ddl).parquet(self.path)
        if buckets is not None:
            df = df.where(F.col("bucket").isin(list(buckets)))
        if without is not None:
            stream, batch = without
            df = df.where((F.col("stream") != stream) | (F.col("batch") != batch))
        return df

    def write_batch(self, df: DataFrame, stream: str, batch: int,
                    kinds: Mapping[str, str] = {}, mode: str = "strict") -> None:
        """Insert the rows of a batch whose key is new; a repeated batch replaces
        its own earlier attempt.

        The batch is judged against the stored rows by one join, whose result is written to
        the working folder; the checks and the insert both read it from there.
        """
        columns = [c for c in df.columns if c not in self.key]
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        staging = work_dir(self.spark, "batch")
        try:
            df.distinct().withColumn("bucket", bucket).write.parquet(f"{staging}/rows")
            rows = self.spark.read.parquet(f"{staging}/rows")
            touched = [r.bucket for r in rows.select("bucket").distinct().collect()]
            stored = self._stored((stream, batch), touched).select(*rows.columns)
            merge.classified(stored, rows, ["bucket", *self.key], columns, kinds).write.parquet(
                f"{staging}/judged")
            judged = self.spark.read.parquet(f"{staging}/judged")
            checks.enforce(checks.combine([
                checks.finding(judged.where("n_of_key > 1").select(*self.key).distinct(),
                               "one key with different rows in a batch", "fatal", self.path),
                checks.finding(judged.where("differing <> ''"), "differs from stored rows", "fatal",
                               self.path),
            ]), mode)
            fresh = judged.where("is_new").select(
                *df.columns, "bucket", F.lit(stream).alias("stream"), F.lit(batch).alias("batch"))
            (fresh.repartition("bucket").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "stream", "batch").parquet(self.path))
        finally:
            files.remove(self.spark, staging)


def ingest_files(spark: SparkSession, source: str, schema: str, target: IncrementalTable,
                 checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                 name: str = "files", file_format: str = "parquet",
                 max_files: int | None = None, kinds: Mapping[str, str] = {},
                 mode: str = "strict", **options: str) -> int:
    """Ingest all files not seen before, then stop; returns the number of batches.

    ``name`` belongs to the checkpoint: a new checkpoint needs a new name.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(source)

    filled: set[int] = set()

    def on_batch(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            filled.add(batch_id)
        target.write_batch(transform(df) if transform else df, name, batch_id, kinds, mode)

    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return len(filled)
