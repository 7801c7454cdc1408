"""Helpers that several operators share: folds of ids, labelled samples, stored frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdraft.session import work_dir


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


#: Spark's setting that shuffle files go when the query that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Spark's bound for the bytes of an Arrow batch.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str, folder: str | None = None, batch: int | None = None) -> DataFrame:
    """The frame written to the shared working folder and read again: lineage ends there.

    Nothing reads the shuffle files of a written table again, so they go with the writing; else
    those of all steps would lie on the disks until the driver collects its garbage. ``folder``
    is one of ``work_dir`` that the caller removes when its tables are read no more. ``batch``
    bounds the bytes of the Arrow batches of this writing.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else work_dir(spark, name)
    settings = {CLEANUP: "true"} | ({BATCH: str(batch)} if batch else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """A column name that starts with ``name`` and that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def labelled_sample(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids: those of the smallest id hashes.

    Columns: ``llm_id`` and ``llm_y``. Rows of one id count once, with the larger label;
    null ids and labels are left out. The bound makes the frame safe to broadcast.
    """
    rows = labels.select(F.col("doc_id").alias("llm_id"), F.col(label).cast("int").alias("llm_y"))
    rows = rows.where("llm_id is not null and llm_y is not null")
    rows = rows.groupBy("llm_id").agg(F.max("llm_y").alias("llm_y"))
    return rows.orderBy(F.xxhash64("llm_id"), "llm_id").limit(limit)


def with_labels(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(text, llm_y) of the documents of a bounded labelled sample."""
    sample = labelled_sample(labels, label, limit)
    texts = docs.select(F.col("doc_id").alias("llm_id"), "text")
    return texts.join(F.broadcast(sample), "llm_id").select("text", "llm_y")


def broadcast_value(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)
