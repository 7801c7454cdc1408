"""First/last per key, dense indexes and completed prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                  order: Column) -> DataFrame:
    """The values of the first row per key; combines before the shuffle, so a key
    that holds much of the input sends one row per task."""
    return (
        df.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias("_first"))
        .select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values])
    )


def last_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                 order: Column) -> DataFrame:
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_last"))
        .select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])
    )


def dense_index(df: DataFrame, order: Sequence[str], index: str = "idx",
                rank_by: Column | None = None, slices: int | None = None) -> DataFrame:
    """0-based position of each row in the total order of ``order``.

    A window without a partition key would pull all rows into one task. Here the
    range is cut at approximate quantiles of the leading order column, each slice is
    numbered on its own, and a slice starts where the counts of the lower ones end.
    ``rank_by`` gives a number that rises with the order (default: the first order
    column itself). The order columns must be unique and the leading one must not
    be dominated by a single value.
    """
    leading = (rank_by if rank_by is not None else F.col(order[0])).cast("double")
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.select(F.percentile_approx(
        leading, [i / slices for i in range(1, slices)] or [0.5], 10000).alias("c")).head()["c"]
    bounds = sorted(set(cuts or []))
    # Position among the cuts: a binary-search-like sum would touch every cut, so
    # the array is filtered once per row; there are only ``slices`` of them.
    slice_no = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: leading > b)) \
        if bounds else F.lit(0)
    sliced = df.withColumn("_slice", slice_no)
    per_slice = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    below = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    offsets = per_slice.select("_slice", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_slice").orderBy(*order)
    return (
        sliced.withColumn("_rn", F.row_number().over(within))
        .join(F.broadcast(offsets), "_slice")  # at most ``slices`` rows
        .withColumn(index, (F.col("_off") + F.col("_rn") - 1).cast("bigint"))
        .drop("_slice", "_rn", "_off")
    )


def completed_prefix(df: DataFrame, index: str, completed: str,
                     keys: Sequence[str] = ()) -> DataFrame:
    """First index that is not completed, or the row count if all are."""
    first_open = F.min(F.when(~F.col(completed), F.col(index)))
    return df.groupBy(*keys).agg(
        F.coalesce(first_open, F.count(F.lit(1))).cast("bigint").alias("completed_prefix"))


def prefix_before_first_open(df: DataFrame, order: str, completed: str,
                             keys: Sequence[str]) -> DataFrame:
    """`completed_prefix` for rows that are ordered but not numbered.

    A row's position matters only up to the first open row of its key, so the rows before
    that are counted: this combines before the shuffle, where numbering would sort all rows
    of a key in one task.
    """
    first_open = df.where(~F.col(completed)).groupBy(*keys).agg(F.min(order).alias("_open"))
    earlier = F.col("_open").isNull() | (F.col(order) < F.col("_open"))
    return df.select(*keys, order).join(first_open, list(keys), "left").groupBy(*keys).agg(
        F.count_if(earlier).alias("completed_prefix"))
