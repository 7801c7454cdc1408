"""Join helpers: broadcast only what has been measured to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 500_000


def size_checked(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``small`` has at most ``max_rows`` rows, else leave the
    join to Spark (sort-merge with AQE). Meant for narrow frames read from a table:
    the check stops after ``max_rows + 1`` rows."""
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
           columns: Sequence[str]) -> DataFrame:
    """Left join with a dimension; unresolved keys keep their row with NULLs."""
    renamed = dim.select(F.col(dim_key).alias(key), *columns)
    return df.join(renamed, key, "left")


#: Ids with at least this share of the rows are looked up apart; so there are at most 1000.
HOT_SHARE = 1 / 1000


def hot_ids(df: DataFrame, key: str) -> list:
    """Ids that hold at least HOT_SHARE of the rows with an id: a bounded number of values.

    Rows are counted per id before the shuffle, so a frequent id sends a row per task."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg((F.sum("n") * HOT_SHARE).alias("least"))
    return [r[key] for r in counts.where(F.col("n") >= total.scalar()).collect()]


def skew_safe_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
                     columns: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """`lookup` for ids that are NULL or the same in very many rows; ``dim_key`` is unique.

    A dimension of at most ``max_rows`` rows is broadcast, and no row of ``df`` moves. With a
    larger one, rows without an id bypass the join, rows of frequent ids meet the few
    dimension rows of these, broadcast, and only the others are shuffled by id. ``df`` is then
    read three times and should come from a table.
    """
    known = dim.select(F.col(dim_key).alias(key), *columns)
    most = BROADCAST_ROWS if max_rows is None else max_rows
    if known.limit(most + 1).count() <= most:
        return df.join(F.broadcast(known), key, "left")
    apart = F.col(key).isin(hot_ids(df, key))
    still = df.where(F.col(key).isNull() | apart).join(F.broadcast(known.where(apart)), key, "left")
    moved = df.where(F.col(key).isNotNull() & ~apart).join(known.where(~apart), key, "left")
    return still.unionByName(moved)


def only_present(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def only_absent(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def by_role(df: DataFrame, other: DataFrame, key: str, role: Column,
            columns: dict[str, str]) -> DataFrame:
    """Left join against the rows of ``other`` that satisfy ``role``; ``columns``
    maps its columns to output names. Used once per role (user row, opponent row)."""
    picked = other.where(role).select(key, *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(picked, key, "left")
