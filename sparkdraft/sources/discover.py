"""Finding dataset triples and naming datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkdraft.sources.layout import ContractError

KINDS = ("draft", "game", "replay")
# Fixed value: source file naming.
FILE_PATTERN = r"^(draft|game|replay)_data_public\.(.+)\.csv\.gz$"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file of a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").load(folder)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
                F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )


def dataset_triples(files: DataFrame) -> DataFrame:
    """suffix, the path of each kind, and whether the triple is complete."""
    named = files.select(
        "path",
        F.regexp_extract("file_name", FILE_PATTERN, 1).alias("kind"),
        F.regexp_extract("file_name", FILE_PATTERN, 2).alias("suffix"),
    ).where(F.col("kind") != "")
    paths = [F.max(F.when(F.col("kind") == k, F.col("path"))).alias(f"{k}_file") for k in KINDS]
    return named.groupBy("suffix").agg(
        *paths, (F.count_distinct("kind") == len(KINDS)).alias("complete"))


def find_datasets(spark: SparkSession, folder: str, suffix: str | None = None):
    """(complete triples, incomplete suffixes); one row per dataset reaches the driver."""
    rows = dataset_triples(list_files(spark, folder)).orderBy("suffix").collect()
    complete = [r for r in rows if r["complete"]]
    incomplete = [r["suffix"] for r in rows if not r["complete"]]
    if suffix is not None:
        complete = [r for r in complete if r["suffix"] == suffix]
    if not complete:
        raise ContractError(f"no complete draft/game/replay triple in {folder}"
                            + (f" for {suffix!r}" if suffix else ""))
    return complete, incomplete


def dataset_id(game_name: Column, replay_name: Column, requested: Column | None = None) -> Column:
    """Requested id, else the common suffix, else ``manual-`` and 16 hex digits."""
    game_suffix = F.regexp_extract(game_name, r"^game_data_public\.(.*)\.csv\.gz$", 1)
    replay_suffix = F.regexp_extract(replay_name, r"^replay_data_public\.(.*)\.csv\.gz$", 1)
    digest = F.substring(F.sha2(F.concat_ws("|", game_name, replay_name), 256), 1, 16)
    named = F.when((game_suffix != "") & (game_suffix == replay_suffix), game_suffix)
    manual = F.concat(F.lit("manual-"), digest)
    if requested is None:
        return F.coalesce(named, manual)
    return F.coalesce(F.nullif(requested, F.lit("")), named, manual)
