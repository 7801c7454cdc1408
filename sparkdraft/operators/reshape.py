"""Wide-to-long reshaping, id lists, multisets and fan-out.

The wide forms work inside the row they belong to: positions and card ids come
from a literal array folded into the plan, so the melt is one narrow stage in
generated code - no join with a dictionary and no regrouping of kinds afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkdraft.functions import clean
from sparkdraft.sources.layout import CountColumn, melt_depth, melt_spec
from sparkdraft.sources.text import cell_at


def melt_counts(df: DataFrame, columns: Sequence[CountColumn], kinds: Sequence[str],
                keep: Sequence[str]) -> DataFrame:
    """Wide count cells to (keep..., card_id, one count per kind), sparse.

    A row comes out only if one of the kinds is nonzero; a missing kind is 0. When
    several columns name the same card, the last nonzero one in source order wins.
    """
    used = [c for c in columns if c.kind in kinds]
    if not used:
        empty = [F.lit(0).alias(k) for k in kinds]
        return df.select(*keep, F.lit(None).cast("bigint").alias("card_id"), *empty).where(F.lit(False))
    depth = melt_depth(used, kinds)
    one = df.select(*keep, "cells", F.expr(f"explode({melt_spec(used, kinds)})").alias("card"))

    def position(kind: str, level: int) -> Column:
        return F.col(f"card.{kind}_{level}")

    # Cheap test on the raw cell first; only the few survivors are parsed.
    touched = F.lit(False)
    for kind in kinds:
        for level in range(depth):
            raw = cell_at(position(kind, level))
            touched = touched | F.coalesce(~raw.isin(*clean.ZERO_CELLS), F.lit(False))
    counts = []
    for kind in kinds:
        levels = [F.nullif(clean.count_or_zero(cell_at(position(kind, level))), F.lit(0))
                  for level in reversed(range(depth))]
        counts.append(F.coalesce(*levels, F.lit(0)).alias(kind))
    nonzero = F.lit(False)
    for kind in kinds:
        nonzero = nonzero | (F.col(kind) != 0)
    return (
        one.where(touched)
        .select(*keep, F.col("card.card_id").alias("card_id"), *counts)
        .where(nonzero)
    )


def fold_kinds(df: DataFrame, keys: Sequence[str], kind: str, count: str,
               kinds: Mapping[str, object], order: Column | None = None) -> DataFrame:
    """Long (key, kind, count) rows to one row per key with a column per kind.

    For input that is long already. With ``order`` the last nonzero count of a kind
    wins; without it counts of a kind add up. Both combine before the shuffle.
    """
    aggs = []
    for name, value in kinds.items():
        hit = F.col(kind) == F.lit(value)
        if order is None:
            agg = F.sum(F.when(hit, F.col(count)))
        else:
            live = hit & (F.col(count) != 0)
            agg = F.max_by(F.when(live, F.col(count)), F.when(live, order))
        aggs.append(F.coalesce(agg, F.lit(0)).cast("bigint").alias(name))
    nonzero = F.lit(False)
    for name in kinds:
        nonzero = nonzero | (F.col(name) != 0)
    return df.groupBy(*keys).agg(*aggs).where(nonzero)


def explode_ids(df: DataFrame, cell: Column, keep: Sequence[str | Column],
                ordinal: str = "ordinal", token: str = "token") -> DataFrame:
    """``a|b|c`` to one row per token with its 1-based ordinal."""
    return df.select(*keep, F.posexplode(clean.id_tokens(cell)).alias("_pos", token)).select(
        *[c if isinstance(c, str) else F.col(_name(c)) for c in keep],
        (F.col("_pos") + 1).alias(ordinal), token)


def _name(column: Column) -> str:
    return column._jc.toString().rsplit(" AS ", 1)[-1].strip("`")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used inside a lambda is evaluated again for every element; as a
    lambda variable of a one-element array it is computed a single time.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def multiset(items: Column) -> Column:
    """Array to ``array<struct<item, quantity>>``, runs of the sorted array.

    A list cell belongs to one row, so it is counted where it is: sort, find the
    starts of the runs, take the distances. No shuffle, n log n for any length.
    """
    def starts_of(ordered: Column) -> Column:
        positions = F.sequence(F.lit(0), F.greatest(F.size(ordered) - 1, F.lit(0)))
        return F.filter(positions, lambda i: (F.size(ordered) > 0) & (
            (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))))

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(starts, lambda s, j: F.struct(
            F.get(ordered, s).alias("item"),
            (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - s).alias("quantity")))

    return bind(F.array_sort(items), lambda ordered: bind(
        starts_of(ordered), lambda starts: runs(ordered, starts)))


def same_multiset(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def count_multiset(df: DataFrame, keys: Sequence[str], quantity: str = "quantity") -> DataFrame:
    """Rows to (keys, quantity); partial counts are taken before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(quantity))


def two_sided(df: DataFrame, keep: Sequence[str], user: Mapping[str, Column],
              other: Mapping[str, Column], flag: str = "is_user") -> DataFrame:
    """One row to a user row and an opponent row, in one pass over the input."""
    def side(is_user: bool, columns: Mapping[str, Column]) -> Column:
        return F.struct(F.lit(is_user).alias(flag), *[c.alias(n) for n, c in columns.items()])

    both = F.array(side(True, user), side(False, {n: other[n] for n in user}))
    return df.select(*keep, F.explode(both).alias("_s")).select(*keep, "_s.*")


def final_candidate(candidates: Column, target: Column) -> Column:
    """Attempt number of the kept candidate.

    ``candidates`` is array<struct<attempt, items>> in attempt order. The latest one
    with the same multiset as ``target`` is final, otherwise the last one.
    """
    def last_attempt(of: Column) -> Column:
        return F.array_max(F.transform(of, lambda c: c["attempt"]))

    def matching(of: Column) -> Column:
        return bind(F.array_sort(target), lambda goal: F.filter(
            of, lambda c: F.array_sort(c["items"]) == goal))

    return bind(candidates, lambda of: F.coalesce(last_attempt(matching(of)), last_attempt(of)))
