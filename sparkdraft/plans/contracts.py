"""What the headers of a source triple must hold, checked before any line is read.

A header becomes a frame of (position, column). Turn columns are matched against the frame of
known rules by an anti join, repeated turn groups go through the same operator as any other
grouped schema, and the numbering of candidate hands is a difference of sets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.operators import checks
from sparkdraft.plans.rules import known_suffixes
from sparkdraft.sources import layout
from sparkdraft.sources.layout import ContractError, Layout


def header_frame(spark: SparkSession, header: Layout) -> DataFrame:
    return spark.createDataFrame(list(enumerate(header.columns)), "position int, column string")


def turn_groups(header: DataFrame) -> DataFrame:
    """(side, turn_index, suffix) of the turn columns of a header."""
    def part(n: int):
        return F.regexp_extract("column", rf"^{layout.TURN_COLUMN.pattern}$", n)

    return header.where(part(3) != "").select(
        part(1).alias("side"), part(2).cast("int").alias("turn_index"), part(3).alias("suffix"))


def unknown_suffixes(turns: DataFrame) -> DataFrame:
    rules = turns.sparkSession.createDataFrame(known_suffixes(), "side string, suffix string")
    return turns.select("side", "suffix").distinct().join(rules, ["side", "suffix"], "left_anti")


def missing_attempts(header: DataFrame) -> DataFrame:
    """Numbers that candidate hands should have, from 1 to the highest, and do not; 1 where there
    is no candidate hand at all."""
    number = F.regexp_extract("column", rf"^{layout.CANDIDATE_COLUMN.pattern}$", 1)
    present = header.where(number != "").select(number.cast("int").alias("attempt"))
    highest = present.agg(F.coalesce(F.max("attempt"), F.lit(1)).alias("n"))
    return highest.select(F.explode(F.sequence(F.lit(1), "n")).alias("attempt")).subtract(present)


def contract_breaks(replay_header: DataFrame) -> DataFrame:
    """(problem, detail) of a replay header; empty where it holds."""
    turns = turn_groups(replay_header)
    drift = checks.group_schema_drift(turns, "side", "turn_index", "suffix")
    found = {
        "unclassified turn column": unknown_suffixes(turns).select(F.concat_ws("_", "side", "suffix")),
        "turn with other columns than the lowest one of its side": drift.select(
            F.concat_ws("_", "side", F.lit("turn"), F.col("turn_index").cast("string"))),
        "candidate hands are not contiguous, missing": missing_attempts(replay_header).select(
            F.col("attempt").cast("string")),
    }
    return reduce(DataFrame.unionAll, [
        rows.toDF("detail").select(F.lit(problem).alias("problem"), "detail")
        for problem, rows in found.items()])


def check_contracts(spark: SparkSession, picks: Layout, games: Layout, replays: Layout) -> None:
    """Raise if the headers lack something that the jobs rely on."""
    layout.require_columns(picks.columns, layout.PICK_REQUIRED, "draft source")
    layout.require_columns(games.columns, layout.GAME_REQUIRED, "game source")
    layout.require_columns(replays.columns, layout.REPLAY_REQUIRED, "replay source")
    breaks = contract_breaks(header_frame(spark, replays)).orderBy("problem", "detail").collect()
    if breaks:
        raise ContractError("; ".join(f"{r.problem}: {r.detail}" for r in breaks))
