"""Merging incoming rows into a stored table.

All operators are joins on the key; Spark chooses the physical join from the sizes
it sees at run time, so neither side is forced to be small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkdraft.functions.clean import values_equal


def _pair(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join of both sides as structs ``s`` and ``i`` (NULL where a side is absent)."""
    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))

    return packed(stored, "s").join(packed(incoming, "i"), list(keys), how)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _differs(column: str, kinds: Mapping[str, str], both_present: bool) -> Column:
    s, i = F.col(f"s.{column}"), F.col(f"i.{column}")
    kind = kinds.get(column, "exact")
    if kind == "float32":
        s, i = s.cast("float"), i.cast("float")
        kind = "exact"
    unequal = ~values_equal(s, i, kind)
    return unequal & s.isNotNull() & i.isNotNull() if both_present else unequal


def mismatches(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
               columns: Sequence[str], kinds: Mapping[str, str] = {},
               both_present: bool = False) -> DataFrame:
    """Keys on both sides whose columns differ, with the names of those columns.

    ``both_present`` counts only differences between two non-null values.
    """
    names = [F.when(_differs(c, kinds, both_present), F.lit(c)) for c in columns]
    return (
        _pair(stored, incoming, keys, "inner")
        .where(_any([_differs(c, kinds, both_present) for c in columns]))
        .select(*keys, F.concat_ws(",", *names).alias("differing"))
    )


def null_fill_conflicts(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
                        columns: Sequence[str], kinds: Mapping[str, str] = {}) -> DataFrame:
    return mismatches(stored, incoming, keys, columns, kinds, both_present=True)


def null_fill_merge(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
                    columns: Sequence[str]) -> DataFrame:
    """Stored rows with NULLs filled from incoming ones, plus the new rows."""
    return _pair(stored, incoming, keys, "full").select(
        *keys, *[F.coalesce(f"s.{c}", f"i.{c}").alias(c) for c in columns])


def filled_rows(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """Keys of stored rows that a null-fill merge would change."""
    fills = _any([F.col(f"s.{c}").isNull() & F.col(f"i.{c}").isNotNull() for c in columns])
    return _pair(stored, incoming, keys, "inner").where(fills).select(*keys)


def strict_ensure_conflicts(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
                            columns: Sequence[str], kinds: Mapping[str, str] = {}) -> DataFrame:
    """Unlike the null-fill merge, NULL against a value is a conflict here."""
    return mismatches(stored, incoming, keys, columns, kinds)


def insert_if_absent(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored."""
    return incoming.join(stored.select(*keys), list(keys), "left_anti")


def insert_or_validate(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
                       columns: Sequence[str], kinds: Mapping[str, str] = {},
                       validate_existing: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, stored rows that differ).

    On a fresh load nothing is stored: ``validate_existing=False`` skips both joins.
    """
    if not validate_existing:
        none = incoming.select(*keys, F.lit("").alias("differing")).where(F.lit(False))
        return incoming, none
    return (insert_if_absent(stored, incoming, keys),
            mismatches(stored, incoming, keys, columns, kinds))


def classified(stored: DataFrame, incoming: DataFrame, keys: Sequence[str],
               columns: Sequence[str], kinds: Mapping[str, str] = {}) -> DataFrame:
    """Every incoming row with what the stored ones say of it, by one join.

    Adds ``is_new`` (its key is not stored), ``differing`` (columns in which a stored row of
    its key differs, else empty) and ``n_of_key`` (incoming rows of its key, counted in the
    partitioning of the join).
    """
    names = [F.when(_differs(c, kinds, False), F.lit(c)) for c in columns]
    left = incoming.select(*keys, F.struct(*[F.col(f"`{c}`") for c in incoming.columns]).alias("i"))
    right = stored.select(*keys, F.struct(*[F.col(f"`{c}`") for c in incoming.columns]).alias("s"))
    joined = left.join(right, list(keys), "left")
    return joined.select(
        "i.*", F.col("s").isNull().alias("is_new"),
        F.when(F.col("s").isNotNull(), F.concat_ws(",", *names)).otherwise(F.lit("")).alias("differing"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("n_of_key"))


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str],
                columns: Sequence[str], when: Column | None = None) -> DataFrame:
    """Target with ``columns`` replaced for keys present in source (NULLs included)."""
    hit = F.col("i").isNotNull()
    if when is not None:
        hit = hit & when
    others = [c for c in target.columns if c not in keys and c not in columns]
    packed = source.select(*keys, F.struct(*columns).alias("i"))
    joined = target.join(packed, list(keys), "left")
    updated = {c: F.when(hit, F.col(f"i.{c}")).otherwise(F.col(c)) for c in columns}
    return joined.select(*[updated[c].alias(c) if c in updated else F.col(c)
                           for c in (*keys, *others, *columns)]).select(*target.columns)


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
