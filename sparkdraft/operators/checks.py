"""Data-quality operators: each returns the offending rows or a count of them.

Nothing here acts. A job gathers counts as one findings frame and `enforce` turns
fatal ones into an error (strict) or leaves them as a report (lenient).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 10


class CheckFailed(ValueError):
    """A fatal check found rows."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_faults(df: DataFrame, key: Sequence[str], natural: Sequence[str]) -> DataFrame:
    """Keys of several rows, and whether the rows are of different things.

    The key is hashed from the natural columns. A second, independent hash of these tells a
    repeated row (``collision`` false) from two things that got one key. Its extremes combine
    before the shuffle.
    """
    other = F.xxhash64(*natural)
    return df.select(*key, other.alias("_h")).groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), (F.min("_h") != F.max("_h")).alias("collision")
    ).where(F.col("n") > 1)


def missing_parents(child: DataFrame, columns: Sequence[str], parent: DataFrame,
                    parent_columns: Sequence[str]) -> DataFrame:
    """Child rows with a non-null reference that has no parent row.

    Distinct references are compared, not rows: a key held by many rows is
    combined before the shuffle.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    refs = child.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    keyed = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True)])
    return refs.join(keyed, list(columns), "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_null) for every column, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                      for c in columns])
    return counted.select(F.explode(pairs).alias("p")).select("p.*")


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns]))


def metadata_conflicts(df: DataFrame, keys: Sequence[str], exact: Sequence[str],
                       approx: Sequence[str] = (), order: Column | None = None) -> DataFrame:
    """Keys whose rows disagree on a column (NULL is a value of its own).

    Exact columns compare minimum and maximum; approximate ones compare both
    extremes with the first value at float32 tolerance. These aggregates combine
    before the shuffle, unlike a distinct count.
    """
    from sparkdraft.functions.clean import values_equal

    aggs = []
    for c in (*exact, *approx):
        aggs += [F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"),
                 F.count(c).alias(f"{c}_n")]
    if approx and order is not None:
        aggs += [F.min_by(F.col(c), order).alias(f"{c}_first") for c in approx]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)

    def half_null(c: str) -> Column:
        return (F.col(f"{c}_n") > 0) & (F.col(f"{c}_n") < F.col("n_rows"))

    flags = {c: half_null(c) | F.coalesce(F.col(f"{c}_lo") != F.col(f"{c}_hi"), F.lit(False))
             for c in exact}
    for c in approx:
        anchor = F.col(f"{c}_first") if order is not None else F.col(f"{c}_lo")
        apart = ~values_equal(anchor, F.col(f"{c}_lo"), "float") \
            | ~values_equal(anchor, F.col(f"{c}_hi"), "float")
        flags[c] = half_null(c) | F.coalesce(apart, F.lit(False))
    return (
        grouped.where(reduce(lambda a, b: a | b, flags.values()))
        .select(*keys, F.concat_ws(",", *[F.when(v, F.lit(k)) for k, v in flags.items()])
                .alias("differing"))
    )


def children_not_exactly(parent: DataFrame, key: str, children: DataFrame, n: int,
                         condition: Column | None = None) -> DataFrame:
    """Parents whose number of (matching) children is not ``n``; none counts as 0."""
    matching = children if condition is None else children.where(condition)
    counted = matching.groupBy(key).agg(F.count(F.lit(1)).alias("n_children"))
    return (
        parent.select(key).join(counted, key, "left")
        .select(key, F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"))
        .where(F.col("n_children") != n)
    )


def incomplete_groups(expected: DataFrame, key: str, n_expected: str,
                      actual: DataFrame) -> DataFrame:
    """Keys whose row count in ``actual`` differs from the expected count."""
    counted = actual.groupBy(key).agg(F.count(F.lit(1)).alias("n_actual"))
    return (
        expected.select(key, F.col(n_expected).alias("n_expected")).join(counted, key, "left")
        .select(key, F.col("n_expected").cast("bigint").alias("n_expected"),
                F.coalesce("n_actual", F.lit(0)).cast("bigint").alias("n_actual"))
        .where(F.col("n_actual") != F.col("n_expected"))
    )


def group_schema_drift(df: DataFrame, side: str, index: str, member: str) -> DataFrame:
    """(side, index) groups whose member set differs from the side's lowest index.

    Sets are compared by what is missing and what is extra, as joins on
    (side, member): no group is collected.
    """
    pairs = df.select(side, index, member).distinct()
    lowest = pairs.groupBy(side).agg(F.min(index).alias("_low"))
    base = pairs.join(lowest, side).where(F.col(index) == F.col("_low")).select(side, member)
    groups = pairs.groupBy(side, index).agg(F.count(F.lit(1)).alias("n_members"))
    shared = (pairs.join(base, [side, member], "left_semi")
              .groupBy(side, index).agg(F.count(F.lit(1)).alias("n_shared")))
    base_size = base.groupBy(side).agg(F.count(F.lit(1)).alias("n_base"))
    return (
        groups.join(shared, [side, index], "left").join(base_size, side)
        .select(side, index,
                (F.col("n_base") - F.coalesce("n_shared", F.lit(0))).alias("n_missing"),
                (F.col("n_members") - F.coalesce("n_shared", F.lit(0))).alias("n_extra"))
        .where((F.col("n_missing") > 0) | (F.col("n_extra") > 0))
    )


def stable_sample(df: DataFrame, order: Sequence[str], n: int = SAMPLE) -> DataFrame:
    """The first ``n`` offending rows in key order, for messages."""
    return df.orderBy(*order).limit(n)


def schema_gaps(present: dict[str, Sequence[str]], required: dict[str, Sequence[str]]) -> list[str]:
    """``table.column`` for every required column a store does not have."""
    return [f"{table}.{column}" for table, columns in required.items()
            for column in columns if column not in present.get(table, ())]


# --- findings -------------------------------------------------------------

def finding(df: DataFrame, check: str, severity: str, table: str = "") -> DataFrame:
    """One row: how many rows a check found."""
    return df.agg(F.count(F.lit(1)).alias("n_found")).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(severity).alias("severity"), "n_found")


def combine(findings: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), findings)


def enforce(report: DataFrame, mode: str = "strict",
            examples: Callable[[], Sequence[str]] = tuple) -> list:
    """Findings with rows. Strict mode raises on a fatal one; the report has one
    row per check. ``examples`` is asked for some rows only when it raises."""
    found = report.where(F.col("n_found") > 0).collect()
    fatal = [f"{r['check_name']} ({r['table_name']}): {r['n_found']}"
             for r in found if r["severity"] == "fatal"]
    if fatal and mode == "strict":
        raise CheckFailed("\n".join(["; ".join(fatal), *examples()]))
    return found
