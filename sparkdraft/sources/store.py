"""The table store: Parquet folders, committed by one ledger file per load.

Parquet has no transaction over several tables. A load therefore writes every table
below its own ``load_id`` folder, which no reader looks at, and becomes visible at
once by its commit: one small file with a row per table, written last. Commits are numbered,
and a number can be created only once, so writers at the same time get one after the other.
A writer names the commit it started from; if a later one replaced a table that it replaces
too, it is told so and nothing is published. Folders without a commit belong to loads that
run or died; `Store.vacuum` removes them.

    <root>/tables/<table>/dataset_id=<d>/load_id=<l>/part=<n>/*.parquet
    <root>/rejects/dataset_id=<d>/load_id=<l>/source=<kind>/*.parquet
    <root>/ledger/commit-<number>.json
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from sparkdraft.operators.checks import schema_gaps
from sparkdraft.sources import files
from sparkdraft.sources.layout import ContractError
from sparkdraft.sources.schema import REPORT_TABLES, TABLES

LEDGER_DDL = ("dataset_id string, table_name string, load_id string, commit_seq bigint, "
              "fingerprint string, n_rows bigint, committed_at timestamp_ntz")
SHARED_DATASET = "shared"
RESET = "*"


#: Columns of rejected lines; `sparkdraft.plans.quarantine` fills them.
REJECT_DDL = ("kind string, src_file string, row_number bigint, dropped boolean, "
              "reasons array<struct<column_name: string, cell: string, reason: string>>, line string")


class CommitConflict(RuntimeError):
    """Another writer published a table that this load replaces."""


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def load_path(self, table: str, dataset_id: str, load_id: str) -> str:
        return f"{self.root}/tables/{table}/dataset_id={dataset_id}/load_id={load_id}"

    # --- ledger ---

    def ledger(self) -> DataFrame:
        path = f"{self.root}/ledger"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], LEDGER_DDL)
        return self.spark.read.schema(LEDGER_DDL).json(path)

    def current_loads(self) -> list[Row]:
        """The latest committed load of every (dataset, table); one row each."""
        ledger = self.ledger()
        reset = ledger.where(F.col("table_name") == RESET).agg(
            F.coalesce(F.max("commit_seq"), F.lit(0)).alias("m")).head()["m"]
        latest = ledger.where(F.col("commit_seq") > reset).groupBy("dataset_id", "table_name").agg(
            F.max_by(F.struct("load_id", "fingerprint", "n_rows"), "commit_seq").alias("l"))
        return latest.select("dataset_id", "table_name", "l.*").orderBy(
            "table_name", "dataset_id").collect()

    def reset(self) -> None:
        """Start over: earlier loads are no longer current. Their files stay."""
        self.commit([(RESET, RESET, "", "", 0)])

    def last_commit(self) -> int:
        return self.ledger().agg(F.max("commit_seq").alias("m")).head()["m"] or 0

    def commit(self, rows: Sequence[tuple[str, str, str, str, int]],
               based_on: int | None = None) -> int:
        """Publish loads (dataset_id, table, load_id, fingerprint, rows); returns the number.

        ``based_on`` is the last commit that the load knows. A later one that replaced a table
        of the same dataset, or started the store over, raises `CommitConflict`.
        """
        seq = self.last_commit() if based_on is None else based_on
        touched = {(d, t) for d, t, *_ in rows}
        while True:
            seq += 1
            if self._put(seq, rows):
                return seq
            if based_on is None:
                continue
            later = {(r["dataset_id"], r["table_name"]) for r in self.ledger().where(
                F.col("commit_seq") == seq).select("dataset_id", "table_name").collect()}
            if later & (touched | {(RESET, RESET)}):
                raise CommitConflict(f"commit {seq} replaced {sorted(later & touched) or 'all'}")

    def _put(self, seq: int, rows: Sequence[tuple[str, str, str, str, int]]) -> bool:
        now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds")
        text = "".join(json.dumps({
            "dataset_id": d, "table_name": t, "load_id": load, "commit_seq": seq,
            "fingerprint": fingerprint, "n_rows": n, "committed_at": now}) + "\n"
            for d, t, load, fingerprint, n in rows)
        return files.put_if_absent(self.spark, f"{self.root}/ledger/commit-{seq:012d}.json", text)

    def vacuum(self, keep: Sequence[str] = ()) -> list[str]:
        """Remove the folders of loads that are not current; returns their paths.

        ``keep`` names load ids that are still being written: call it when no other writer
        runs, or with theirs.
        """
        current = {r["load_id"] for r in self.current_loads()} | set(keep)
        removed = []
        for area in ("tables", "bronze", "rejects"):
            path = f"{self.root}/{area}"
            if not files.exists(self.spark, path):
                continue
            listed = self.spark.read.format("binaryFile").option(
                "recursiveFileLookup", "true").load(path)
            folder = F.regexp_extract("path", r"^(.*/load_id=[^/]+)/", 1)
            for r in listed.select(folder.alias("f")).where("f <> ''").distinct().collect():
                if r["f"].rsplit("=", 1)[-1] not in current:
                    files.remove(self.spark, r["f"])
                    removed.append(r["f"])
        return removed

    def fingerprint(self, dataset_id: str) -> str | None:
        """Source fingerprint of a committed dataset."""
        return next((r["fingerprint"] for r in self.current_loads()
                     if r["dataset_id"] == dataset_id and r["table_name"] == "games"), None)

    # --- rejected lines ---

    def reject_path(self, dataset_id: str, load_id: str, kind: str) -> str:
        return f"{self.root}/rejects/dataset_id={dataset_id}/load_id={load_id}/source={kind}"

    def rejects(self, dataset_id: str | None = None) -> DataFrame:
        """Rejected lines of all loads, also of those that were not published."""
        path = f"{self.root}/rejects"
        ddl = REJECT_DDL + ", dataset_id string, load_id string"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], ddl)
        rows = self.spark.read.schema(ddl).parquet(path).select(
            "dataset_id", "load_id", *StructType.fromDDL(REJECT_DDL).fieldNames())
        return rows if dataset_id is None else rows.where(F.col("dataset_id") == dataset_id)

    # --- tables ---

    def stage(self, table: str, df: DataFrame, dataset_id: str, load_id: str,
              part: int = 0) -> DataFrame:
        """Write a part of a table of a load in schema order and types; returns it as stored."""
        schema = TABLES[table].schema
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        path = f"{self.load_path(table, dataset_id, load_id)}/part={part}"
        typed.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def staged(self, table: str, dataset_id: str, load_id: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table].schema).parquet(
            self.load_path(table, dataset_id, load_id)).select(*TABLES[table].columns)

    def table(self, name: str, datasets: Sequence[str] | None = None,
              with_dataset: bool = False) -> DataFrame:
        """Committed rows of a table, of all or of the given datasets."""
        paths = [self.load_path(name, r["dataset_id"], r["load_id"]) for r in self.current_loads()
                 if r["table_name"] == name and (datasets is None or r["dataset_id"] in datasets)]
        schema = TABLES[name].schema
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn("dataset_id", F.lit(None).cast("string")) if with_dataset else empty
        columns = [*schema.fieldNames(), *(["dataset_id"] if with_dataset else [])]
        return (self.spark.read.option("basePath", f"{self.root}/tables/{name}")
                .schema(TABLES[name].ddl + ", dataset_id string, load_id string")
                .parquet(*paths).select(*columns))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def check_schema(self) -> None:
        """Every committed table must hold the columns of the data model."""
        present = {}
        for row in self.current_loads():
            path = self.load_path(row["table_name"], row["dataset_id"], row["load_id"])
            present.setdefault(row["table_name"], self.spark.read.parquet(path).columns)
        gaps = schema_gaps(present, {t: TABLES[t].columns for t in present if t in TABLES})
        if gaps:
            raise ContractError(f"store has incompatible tables, missing {gaps}")


def open_store(spark: SparkSession, root: str, database: str | None = None) -> Store:
    """Register every table for `query`; the store is only read.

    Temp views by default; with ``database`` views of that database, so that SQL can
    say ``<database>.<table>``.
    """
    store = Store(spark, root)
    store.check_schema()
    if database is not None:
        _register_database(store, database)
        return store
    for name, df in store.tables().items():
        df.createOrReplaceTempView(name)
    return store


def _register_database(store: Store, database: str) -> None:
    spark = store.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    loads = store.current_loads()
    for name, table in TABLES.items():
        columns = ", ".join(f"`{c}`" for c in table.columns)
        parts = [f"SELECT {columns} FROM parquet.`{store.load_path(name, r['dataset_id'], r['load_id'])}`"
                 for r in loads if r["table_name"] == name]
        if not parts:
            typed = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                              for f in table.schema)
            parts = [f"SELECT * FROM (SELECT {typed}) WHERE false"]
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS " + " UNION ALL ".join(parts))


def query(spark: SparkSession, sql: str, params: Sequence | Mapping | None = None) -> DataFrame:
    """SQL with positional ``?`` (sequence) or named ``:x`` (mapping) parameters."""
    if params is None:
        return spark.sql(sql)
    return spark.sql(sql, args=dict(params) if isinstance(params, Mapping) else list(params))


def row_counts(tables: Mapping[str, DataFrame], names: Sequence[str] = REPORT_TABLES) -> DataFrame:
    """(table_name, row_count) in name order; counts read file footers only."""
    counts = [tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n).alias("table_name"), "row_count") for n in names]
    return reduce(DataFrame.unionAll, counts).orderBy("table_name")


def content_manifest(df: DataFrame, name: str, row_hash=None) -> DataFrame:
    """Row count and order-insensitive content hash of a table.

    The exclusive-or catches any changed row; the sum also catches repeated ones,
    which cancel out under exclusive-or.
    """
    h = F.xxhash64(*df.columns) if row_hash is None else row_hash
    part = h.bitwiseAND(F.lit(0xFFFFFFFF))
    return df.select(h.alias("h"), part.alias("p")).agg(
        F.count(F.lit(1)).alias("row_count"), F.bit_xor("h").alias("hash_xor"),
        F.sum("p").alias("hash_sum")).select(F.lit(name).alias("table_name"), "*")


def manifest(store: Store) -> DataFrame:
    """Snapshot manifest: per table rows, files, bytes and content hash."""
    parts = []
    for name in TABLES:
        df = store.table(name)
        listed = df.select(F.col("_metadata.file_path").alias("f"),
                          F.col("_metadata.file_size").alias("s")) if df.inputFiles() else None
        content = content_manifest(df, name)
        if listed is None:
            sizes = content.select(F.lit(0).cast("bigint").alias("n_files"),
                                   F.lit(0).cast("bigint").alias("n_bytes"))
        else:
            sizes = listed.groupBy("f").agg(F.max("s").alias("s")).agg(
                F.count(F.lit(1)).alias("n_files"), F.sum("s").alias("n_bytes"))
        n_files, n_bytes = sizes.select("n_files").scalar(), sizes.select("n_bytes").scalar()
        parts.append(content.withColumns({"n_files": n_files, "n_bytes": n_bytes}))
    return reduce(DataFrame.unionAll, parts).withColumn("generated_at", F.current_timestamp())
