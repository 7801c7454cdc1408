"""Symmetric PPMI matrix and its truncated singular value decomposition."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkdraft.functions import prob
from sparkdraft.operators.ordering import dense_index
from sparkdraft.plans import assoc, subspace
from sparkdraft.session import work_dir
from sparkdraft.sources import files
from sparkdraft.sources.store import Store


@dataclass(frozen=True)
class Decomposition:
    """M ~ U diag(sigma) V^T of an item-by-item matrix."""

    u: DataFrame      # idx, u array<double>: orthonormal columns, also where sigma is 0
    sigma: DataFrame  # k, sigma
    n_items: int
    n_nonzero: int
    components: int
    residual: float   # largest norm of M u - lambda u, relative to the largest sigma


def item_index(items: DataFrame) -> DataFrame:
    """Items with their 0-based index in id order."""
    return dense_index(items, ["card_id"], "idx")


def matrix_entries(pairs: DataFrame, index: DataFrame, value: str = "ppmi") -> DataFrame:
    """(i, j, value) of the symmetric matrix; pairs with an unknown item drop out."""
    a = index.select(F.col("card_id").alias("card_a_id"), F.col("idx").alias("a"))
    b = index.select(F.col("card_id").alias("card_b_id"), F.col("idx").alias("b"))
    half = pairs.join(a, "card_a_id").join(b, "card_b_id").select("a", "b", value)
    both = F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j")),
                   F.struct(F.col("b").alias("i"), F.col("a").alias("j")))
    return half.select(F.explode(both).alias("e"), F.col(value).cast("double").alias("value")).select(
        "e.i", "e.j", "value")


def decompose(entries: DataFrame, n_items: int, components: int, seed: int = 42,
              scratch: str | None = None, zero_ok: bool = False) -> Decomposition:
    """Truncated SVD of a symmetric matrix, with at most ``n_items - 1`` components.

    Directions that are numerically zero come back as sigma = 0 with some unit vectors of the
    null space; `factors` leaves these out. Each column's sign is fixed: its entry of largest
    magnitude is positive. A matrix without entries is refused, unless ``zero_ok``: then its
    components, of which fewer than two items have none, are all of that kind.
    """
    spark = entries.sparkSession
    n_nonzero = entries.count()
    if not zero_ok and (n_items < 2 or n_nonzero == 0):
        raise ValueError("not enough positive association to decompose")
    k = max(min(components, n_items - 1), 0)
    if k:
        found = subspace.leading(entries, n_items, k, seed, scratch or work_dir(spark, "subspace"))
    else:
        empty = spark.createDataFrame([(i, []) for i in range(n_items)], "idx long, u array<double>")
        found = subspace.Leading(empty, [], 0.0)
    sigma = spark.createDataFrame(list(enumerate(found.sigma)), "k int, sigma double")
    return Decomposition(_fix_signs(found.u), sigma, n_items, n_nonzero, k, found.residual)


def _fix_signs(u: DataFrame) -> DataFrame:
    """Flip columns so that the entry of largest magnitude is positive. What is
    gathered is one sign per component."""
    column = u.select(F.posexplode("u").alias("k", "x")).groupBy("k").agg(
        F.when(-F.min("x") > F.max("x"), -1.0).otherwise(1.0).alias("sign"))
    signs = column.agg(F.array_sort(F.collect_list(F.struct("k", "sign"))).alias("s"))
    signed = F.zip_with("u", "signs", lambda x, s: x * s["sign"])
    return u.withColumn("signs", signs.scalar()).select("idx", signed.alias("u"))


def factors(d: Decomposition) -> DataFrame:
    """(idx, u): the rows of U = M V / sigma; a column is zero where sigma is."""
    sigma = d.sigma.agg(F.array_sort(F.collect_list(F.struct("k", "sigma"))).alias("s"))  # k rows
    given = F.zip_with("u", "sigmas", lambda x, s: F.when(s["sigma"] > 0, x).otherwise(0.0))
    return d.u.withColumn("sigmas", sigma.scalar()).select("idx", given.alias("u"))


def residuals(d: Decomposition, entries: DataFrame) -> DataFrame:
    """(k, residual, norm): the norm of M u - lambda u and of u, for each component.

    lambda, which is sigma up to its sign, is the Rayleigh quotient of u. Computed from the
    entries and the rows of U alone, by joins and sums.
    """
    long = d.u.select("idx", F.posexplode("u").alias("k", "x"))
    image = entries.join(long.select(F.col("idx").alias("j"), "k", "x"), "j").groupBy("i", "k").agg(
        F.sum(F.col("value") * F.col("x")).alias("y"))
    both = long.join(image.withColumnRenamed("i", "idx"), ["idx", "k"], "left").fillna(0.0, ["y"])
    sums = both.groupBy("k").agg(F.sum(F.col("x") * F.col("y")).alias("xy"),
                                 F.sum(F.col("x") * F.col("x")).alias("xx"))
    away = F.col("y") - F.col("xy") * F.col("x")
    return both.join(F.broadcast(sums), "k").groupBy("k").agg(  # a row for each component
        F.sqrt(F.sum(away * away)).alias("residual"), F.sqrt(F.first("xx")).alias("norm"),
        F.abs(F.first("xy")).alias("sigma"))


def products(d: Decomposition) -> DataFrame:
    """(a, b, dot): the inner products of the columns of U, a < b."""
    long = d.u.select("idx", F.posexplode("u").alias("a", "x"), "u")
    rest = F.transform(F.sequence(F.col("a") + 1, F.size("u") - 1), lambda b: F.struct(
        b.alias("b"), (F.col("x") * F.get("u", b)).alias("t")))
    return long.where(F.col("a") + 1 < F.size("u")).select("a", F.inline(rest)).groupBy("a", "b").agg(
        F.sum("t").alias("dot"))


def non_finite(d: Decomposition) -> DataFrame:
    """Factor entries that are not finite numbers."""
    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    rows = d.u.where(F.exists("u", bad)).select(F.col("idx").cast("string").alias("entry"))
    return rows.unionAll(d.sigma.where(bad(F.col("sigma"))).select(
        F.concat(F.lit("sigma "), F.col("k").cast("string")).alias("entry")))


def explained_variance(d: Decomposition, entries: DataFrame) -> DataFrame:
    """Share of the column variance of M that U diag(sigma) keeps (one row).

    The variance of M counts the zeros that are not stored. A zero matrix has no share: NULL.
    """
    n = F.lit(float(d.n_items))
    scaled = d.u.select(F.posexplode("u").alias("k", "x")).join(F.broadcast(d.sigma), "k").select(
        "k", (F.col("x") * F.col("sigma")).alias("x"))  # sigma holds k rows
    kept = scaled.groupBy("k").agg(F.var_pop("x").alias("v")).agg(F.sum("v").alias("kept"))
    columns = entries.groupBy("j").agg(F.sum("value").alias("s"),
                                       F.sum(F.col("value") * F.col("value")).alias("s2"))
    total = columns.agg(F.sum(F.col("s2") / n - (F.col("s") / n) * (F.col("s") / n)).alias("total"))
    return kept.select((F.col("kept") / total.scalar()).alias("explained_variance"))


@dataclass(frozen=True)
class FactorParameters:
    deck_size: int = assoc.DECK_SIZE
    cards_seen: int = assoc.CARDS_SEEN
    min_pair_prob: float = assoc.MIN_PAIR_PROB
    components: int = 64
    random_state: int = 42  # seed of the start of the solver
    exclude_basics: bool = True


def factorise(spark: SparkSession, root: str, artifact: str,
              parameters: FactorParameters = FactorParameters()) -> dict:
    """The factorisation job over a store; writes the artifact and returns metadata."""
    p = parameters
    prob.check_sampling(p.deck_size, p.cards_seen, p.min_pair_prob, p.components)
    store = Store(spark, root)
    builds, build_cards = store.table("deck_builds"), store.table("deck_build_cards")
    excluded: Iterable[str] = assoc.BASIC_NAMES if p.exclude_basics else ()
    items = _kept(item_index(assoc.item_table(build_cards, store.table("cards"), excluded)),
                  f"{artifact}/items")
    n_items = items.count()
    if n_items == 0:
        raise ValueError("no main-deck cards found in deck_build_cards")
    pairs = assoc.ppmi_pairs(assoc.pmi_pairs(
        builds, build_cards, store.table("cards"), excluded=excluded,
        min_pair_prob=p.min_pair_prob, deck_size=p.deck_size, cards_seen=p.cards_seen,
        scratch=f"{artifact}/_work/probabilities"))
    entries = _kept(matrix_entries(pairs, items), f"{artifact}/entries")
    d = decompose(entries, n_items, p.components, p.random_state, f"{artifact}/_work/subspace")
    rows = _kept(items.join(factors(d), "idx").select(
        "idx", F.col("card_id").alias("item_id"), F.col("card_name").alias("name"), "u"),
        f"{artifact}/factors")
    sigma = _kept(d.sigma, f"{artifact}/sigma")
    stored = Decomposition(rows.select("idx", "u"), sigma, d.n_items, d.n_nonzero, d.components,
                           d.residual)
    if not non_finite(stored).isEmpty():
        raise ValueError("the decomposition holds non-finite values")
    metadata = {
        "decomposition": "truncated_svd", "source_matrix": "deck_ppmi",
        "matrix_rows": n_items, "matrix_columns": n_items, "matrix_nonzero": d.n_nonzero,
        **asdict(p), "components": d.components, "largest_residual": d.residual,
        "explained_variance": explained_variance(stored, entries).head()["explained_variance"],
    }
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "metadata string").coalesce(
        1).write.mode("overwrite").parquet(f"{artifact}/run_metadata")
    files.remove(spark, f"{artifact}/_work")
    return metadata


def _kept(df: DataFrame, path: str) -> DataFrame:
    """Write a result and go on from the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
