"""Exact positions in a sorted order, without one task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkdraft.llm.common import stored

#: Bits of monotonically_increasing_id below the partition number.
ROW_BITS = 33


def in_runs(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, runs): the rows sorted by group and order, and where each group's pieces start.

    ``rows`` comes back with ``llm_part``, the range partition, and ``llm_at``, the place in
    it. ``runs`` has a row for each group and partition that meet: ``llm_first``, the least
    place, ``llm_rows``, ``llm_before``, the group's rows in lower partitions, and
    ``llm_total``, the group's rows. The position of a row in its group is
    ``llm_before + llm_at - llm_first``, by a join on the group and ``llm_part``. Group columns
    must not be null. Equal rows are parted by an arbitrary number, so that they spread too;
    which of them comes first is open. ``rows`` should be read from a table: the range bounds
    are sampled in a pass of their own.
    """
    keys = [*group, *order, "llm_tie"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (rows.withColumn("llm_tie", F.monotonically_increasing_id())
                   .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("llm_tie")
                   .withColumn("llm_no", F.monotonically_increasing_id()))
    placed = stored(sorted_rows.select(
        *rows.columns, F.shiftright("llm_no", ROW_BITS).alias("llm_part"),
        F.col("llm_no").bitwiseAND((1 << ROW_BITS) - 1).alias("llm_at")), "ordered")
    runs = placed.groupBy(*group, "llm_part").agg(
        F.min("llm_at").alias("llm_first"), F.count("*").alias("llm_rows"))
    whole = Window.partitionBy(*group)  # at most one row a partition
    lower = whole.orderBy("llm_part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, stored(runs.select(
        "*", F.coalesce(F.sum("llm_rows").over(lower), F.lit(0)).alias("llm_before"),
        F.sum("llm_rows").over(whole).alias("llm_total")), "runs")


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with ``llm_i``, the 0-based position in the group, and ``llm_n``, its rows."""
    placed, runs = in_runs(rows, group, order)
    return placed.join(runs, [*group, "llm_part"]).select(
        *rows.columns, (F.col("llm_before") + F.col("llm_at") - F.col("llm_first")).alias("llm_i"),
        F.col("llm_total").alias("llm_n"))
