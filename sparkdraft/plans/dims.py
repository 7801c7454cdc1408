"""Reference tables: canonical cards, arena ids, abilities."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkdraft.functions import clean, keys
from sparkdraft.operators import ordering


def cards(names: DataFrame, name: str) -> DataFrame:
    """Canonical cards: distinct trimmed, non-blank names with their key."""
    return (
        names.select(clean.card_name(F.col(name)).alias("card_name"))
        .where(F.col("card_name").isNotNull() & (F.col("card_name") != ""))
        .distinct()
        .select(keys.card_key(F.col("card_name")).alias("card_id"), "card_name")
    )


def header_names(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Card names of the file headers (one per column) as a frame."""
    return spark.createDataFrame([(n,) for n in sorted(set(names))], "name string")


def _lookup_rows(lookup: DataFrame, id_column: str) -> tuple[DataFrame, Column]:
    columns = {c: F.col(f"`{c}`") for c in lookup.columns if c != "src_seq"}
    return (lookup.withColumn("_id", clean.integer_or_null(F.col(f"`{id_column}`"))),
            clean.canonical_json(columns))


def arena_rows(lookup: DataFrame, id_column: str = "id", name_column: str = "name") -> DataFrame:
    """Lookup rows with a usable id and name, as (arena_card_id, card_id, json)."""
    rows, as_json = _lookup_rows(lookup, id_column)
    name = clean.text_or_null(F.col(f"`{name_column}`"))
    return rows.where(F.col("_id").isNotNull() & name.isNotNull()).select(
        "src_seq", F.col("_id").alias("arena_card_id"),
        keys.card_key(name).alias("card_id"), as_json.alias("source_json"))


def arena_card_ids(rows: DataFrame) -> DataFrame:
    """One row per arena id: the first of the lookup."""
    return ordering.first_per_key(rows, ["arena_card_id"], ["card_id", "source_json"],
                                  F.col("src_seq"))


def arena_conflicts(rows: DataFrame) -> DataFrame:
    """Arena ids that stand for several cards."""
    return (
        rows.groupBy("arena_card_id")
        .agg(F.min("card_id").alias("lo"), F.max("card_id").alias("hi"))
        .where(F.col("lo") != F.col("hi")).select("arena_card_id")
    )


def abilities(lookup: DataFrame, id_column: str = "id", text_column: str = "text") -> DataFrame:
    """The first lookup row per ability id."""
    rows, as_json = _lookup_rows(lookup, id_column)
    parsed = rows.where(F.col("_id").isNotNull()).select(
        "src_seq", F.col("_id").alias("ability_id"),
        clean.text_or_null(F.col(f"`{text_column}`")).alias("ability_text"),
        as_json.alias("source_json"))
    return ordering.first_per_key(parsed, ["ability_id"], ["ability_text", "source_json"],
                                  F.col("src_seq"))
