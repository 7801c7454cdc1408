import json
import math
import subprocess
import sys

import duckdb
import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sparkdraft.plans import assoc, factor, subspace
from sparkdraft.queries import all_oracles, association
from sparkdraft.sources.store import Store

BUILDS = [("d1", 1), ("d1", 2), ("d2", 3), ("d3", 4)]
CARDS = [(1, "A"), (2, "B"), (3, "C"), (4, "Island"), (5, "D")]
DECKS = [(1, 1, 2), (1, 2, 1), (2, 1, 1), (2, 2, 3), (2, 4, 17), (3, 1, 4), (3, 3, 2), (3, 5, 1),
         (4, 4, 17), (4, 2, 0)]


def frames(spark):
    return (spark.createDataFrame(BUILDS, "draft_id string, build_id bigint"),
            spark.createDataFrame(DECKS, "build_id bigint, card_id bigint, deck_count smallint"),
            spark.createDataFrame(CARDS, "card_id bigint, card_name string"))


def brute_force(deck=40, seen=10):
    def miss(k):
        return math.comb(deck - k, seen) / math.comb(deck, seen) if deck - k >= seen else 0.0

    draft_of = {b: d for d, b in BUILDS}
    names = dict(CARDS)
    one, two = {}, {}
    live = [(b, c, k) for b, c, k in DECKS if k > 0 and names[c] not in assoc.BASIC_NAMES]
    for b, c, k in live:
        key = draft_of[b], c
        one[key] = max(one.get(key, 0), 1 - miss(k))
        for b2, c2, k2 in live:
            if b2 == b and c < c2:
                key = draft_of[b], c, c2
                two[key] = max(two.get(key, 0), 1 - miss(k) - miss(k2) + miss(k + k2))
    n = len({d for d, _ in BUILDS})
    p, pp = {}, {}
    for (_, c), v in one.items():
        p[c] = p.get(c, 0) + v / n
    for (_, a, b), v in two.items():
        pp[a, b] = pp.get((a, b), 0) + v / n
    return {(a, b): (v, p[a], p[b], math.log(v / (p[a] * p[b]))) for (a, b), v in pp.items()}


@pytest.mark.parametrize("limits", [{}, {"unit_pairs": 1}, {"unit_pairs": 4}])
def test_pmi_equals_brute_force_in_one_unit_and_in_many(spark, limits):
    got = {(r.card_a_id, r.card_b_id): (r.p_ab, r.p_a, r.p_b, r.pmi)
           for r in assoc.pmi_pairs(*frames(spark), **limits).collect()}
    expected = brute_force()
    assert got.keys() == expected.keys()
    for pair, values in expected.items():
        assert np.allclose(got[pair], values, atol=1e-12)


def test_cards_and_pairs_share_one_exchange(spark):
    builds, decks, cards = frames(spark)
    rows = assoc.build_cards(builds, decks, cards)
    plan = assoc.probabilities(rows, builds)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    after_pairs = plan[:plan.index("Generate explode")]
    exchanges = [line for line in after_pairs.splitlines() if "Exchange hashpartitioning" in line
                 and "card_a_id" in line]
    assert len(exchanges) == 1 and "draft_id" not in exchanges[0]


def test_the_pairs_of_a_task_do_not_rise_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(assoc, "TASK_PAIRS", 100)
    monkeypatch.setattr(assoc, "TASK_ROWS", 50)
    rows = spark.range(100).select(F.col("id").alias("build_id"), F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.lit(4).cast("bigint"))).alias("card_id")).withColumn("deck_count", F.lit(1))
    builds = spark.range(100).select(F.col("id").alias("build_id"), F.col("id").alias("draft_id"))
    cards = spark.range(1, 5).select(F.col("id").alias("card_id"), F.col("id").cast("string").alias("card_name"))
    found = assoc.probabilities(assoc.build_cards(builds, rows, cards), builds)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ", 10), REPARTITION_BY_NUM" in plan and ", 8), REPARTITION_BY_NUM" in plan
    p = {(r.card_a_id, r.card_b_id): r.p for r in found.collect()}
    assert len(p) == 10 and all(np.isclose(v, 0.25 if a == b else 1 - 2 * 0.75 + 0.75 * 29 / 39)
                                for (a, b), v in p.items())


def test_a_wide_build_is_cut_into_even_units(spark):
    """A build of 50,000 cards has 1.25 billion pairs: over a thousand tasks share them."""
    rows = spark.range(50_000).select(F.lit("d").alias("draft_id"), F.lit(1).alias("build_id"),
                                      F.col("id").alias("card_id"), F.lit(1).alias("deck_count"))
    rows = rows.unionAll(rows.where("card_id < 60").withColumn("draft_id", F.lit("small")))
    wide = assoc.wide_drafts(rows)
    assert [(r.draft_id, r.segments) for r in wide.collect()] == [("d", 51)]
    sizes = assoc.units(rows, wide).groupBy("draft_id", "low", "high").agg(
        F.count_if(~F.col("upper")).alias("a"), F.count_if("upper").alias("b")).collect()
    assert [(r.a, r.b) for r in sizes if r.draft_id == "small"] == [(60, 0)]
    big = [r for r in sizes if r.draft_id == "d"]
    work = [r.a * r.b if r.low < r.high else r.a * (r.a + 1) // 2 for r in big]
    assert len(big) == 51 * 52 // 2 and sum(work) == 50_000 * 50_001 // 2 and max(work) < 1_500_000


def test_items_leave_out_basics_and_unplayed(spark):
    _, decks, cards = frames(spark)
    assert [r.card_name for r in assoc.item_table(decks, cards).collect()] == ["A", "B", "C", "D"]
    assert assoc.item_table(decks, cards, excluded=()).count() == 5


def matrix(spark, values):
    entries = [(i, j, float(v)) for i, row in enumerate(values) for j, v in enumerate(row) if v]
    return spark.createDataFrame(entries, "i bigint, j bigint, value double")


def test_svd_equals_numpy(spark):
    rng = np.random.default_rng(2)
    half = np.triu(rng.random((12, 12)) * (rng.random((12, 12)) < 0.5), 1)
    m = half + half.T
    entries = matrix(spark, m)
    d = factor.decompose(entries, 12, 5)
    sigma = np.array([r.sigma for r in d.sigma.orderBy("k").collect()])
    u = np.array([r.u for r in d.u.orderBy("idx").collect()])
    full_u, full_s, _ = np.linalg.svd(m)
    assert np.allclose(sigma, full_s[:5], atol=1e-8)
    assert np.allclose(np.abs(u), np.abs(full_u[:, :5]), atol=1e-6)
    assert all(col[np.abs(col).argmax()] > 0 for col in u.T)
    scaled = u * sigma
    expected = scaled.var(axis=0).sum() / m.var(axis=0).sum()
    got = factor.explained_variance(d, entries).head()["explained_variance"]
    assert abs(got - expected) < 1e-9 and factor.non_finite(d).isEmpty()


def test_svd_of_several_blocks_does_not_need_the_whole_space(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(subspace, "BLOCK", 16)
    monkeypatch.setattr(subspace, "HELD", 2)
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((70, 70)))[0]
    m = (basis * 0.5 ** np.arange(70) * np.where(np.arange(70) % 3, 1, -1)) @ basis.T
    m[np.abs(m) < 1e-12] = 0
    d = factor.decompose(matrix(spark, m), 70, 4, seed=5, scratch=str(tmp_path / "a"))
    sigma = np.array([r.sigma for r in d.sigma.orderBy("k").collect()])
    u = np.array([r.u for r in d.u.orderBy("idx").collect()])
    assert np.allclose(sigma, 0.5 ** np.arange(4), atol=1e-9) and d.residual <= 1e-9
    assert np.allclose(np.abs(u), np.abs(basis[:, :4]), atol=1e-7)
    assert factor.residuals(d, matrix(spark, m)).where("residual > 1e-8 or abs(norm - 1) > 1e-9").isEmpty()
    assert factor.products(d).where("abs(dot) > 1e-9").isEmpty() and factor.products(d).count() == 6


def test_matrix_steps_run_where_this_package_is_not_installed(tmp_path):
    """An executor's Python has neither the driver's folder nor its path."""
    sent = cloudpickle.dumps(lambda a: subspace._rows([0], ["z"], [a]).num_rows)
    code = "import sys, numpy, pickle; print(pickle.load(sys.stdin.buffer)(numpy.ones((2, 3))))"
    done = subprocess.run([sys.executable, "-c", code], input=sent, cwd=tmp_path, env={
        "PYTHONPATH": ":".join(p for p in sys.path if "site-packages" in p)}, capture_output=True)
    assert done.stdout.split() == [b"1"], done.stderr.decode()


def test_svd_limits(spark):
    small = matrix(spark, [[0, 1, 0], [1, 0, 2], [0, 2, 0]])
    d = factor.decompose(small, 3, 5)
    assert d.components == 2 and d.sigma.count() == 2
    isolated = factor.decompose(matrix(spark, [[0, 1, 0, 0], [1, 0, 0, 0]]), 4, 3)
    assert isolated.u.count() == 4 and isolated.u.where(F.size("u") != 3).isEmpty()
    with pytest.raises(ValueError):
        factor.decompose(small.where("value > 9"), 3, 2)


def assert_orthonormal(d, entries):
    k = d.components
    rows = factor.residuals(d, entries).collect()
    assert len(rows) == k and all(r.residual <= 1e-9 and abs(r.norm - 1) <= 1e-9 for r in rows)
    dots = factor.products(d).collect()
    assert len(dots) == k * (k - 1) // 2 and all(abs(r.dot) <= 1e-9 for r in dots)


def test_svd_of_fewer_directions_than_components(spark):
    """Two pairs of 30 items, one of them stronger: four directions are not zero."""
    m = np.zeros((30, 30))
    m[3, 8] = m[8, 3] = 2.0
    m[20, 29] = m[29, 20] = 0.5
    entries = matrix(spark, m)
    for components in (9, 29):
        d = factor.decompose(entries, 30, components)
        sigma = [r.sigma for r in d.sigma.orderBy("k").collect()]
        assert np.allclose(sigma[:4], [2, 2, 0.5, 0.5]) and sigma[4:] == [0.0] * (components - 4)
        assert_orthonormal(d, entries)
        given = np.array([r.u for r in factor.factors(d).orderBy("idx").collect()])
        assert np.allclose(np.linalg.norm(given, axis=0), [1.0] * 4 + [0.0] * (components - 4))
        assert np.allclose(given[:, :4], np.array([r.u[:4] for r in d.u.orderBy("idx").collect()]))


def test_svd_of_a_zero_matrix(spark):
    zero = matrix(spark, [[0, 1], [1, 0]]).where("value > 9")
    for items, components in ((90, 4), (5, 4), (1, 0), (0, 0)):
        d = factor.decompose(zero, items, 4, zero_ok=True)
        assert d.components == components and [r.sigma for r in d.sigma.collect()] == [0.0] * components
        assert d.u.count() == items and d.u.where(F.size("u") != components).isEmpty()
        assert factor.non_finite(d).isEmpty() and factor.factors(d).where("exists(u, x -> x <> 0)").isEmpty()
        assert_orthonormal(d, zero)
        assert [r.explained_variance for r in factor.explained_variance(d, zero).collect()] == [None]


def tables(spark, sf, orders):
    """``sf`` with a part for each name and the orders, given by their names."""
    names = sorted({n for names in orders for n in names})
    lines = [(o, names.index(n)) for o, order in enumerate(orders) for n in order]
    for table, rows, schema in (
            ("part", list(enumerate(names)), "p_partkey long, p_name string"),
            ("orders", [(o, o) for o in range(len(orders))], "o_orderkey long, o_custkey long"),
            ("lineitem", lines, "l_orderkey long, l_partkey long")):
        spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{table}.parquet")
    return sf


def oracle(sf, sql):
    con = duckdb.connect()
    for table in ("part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet/*.parquet'")
    return sorted(con.execute(sql).fetchall())


def test_svd_queries_without_positive_pairs(spark, tmp_path):
    """Five names that no two of an order share: the matrix has no entry."""
    sf = tables(spark, str(tmp_path / "sf"), [[n] for n in "abcde"])
    assert association.ppmi_matrix(spark, sf).isEmpty()
    assert [r.sigma for r in association.svd_sigma(spark, sf).collect()] == [0.0] * 4
    rows = association.svd_factors(spark, sf).collect()
    assert sorted(r.card_name for r in rows) == list("abcde") and {tuple(r.u) for r in rows} == {(0.0,) * 4}
    for name in ("svd_residuals", "svd_orthogonality"):
        got = getattr(association, name)(spark, sf).collect()
        assert sorted(map(tuple, got)) == oracle(sf, all_oracles()[name])
    assert [r.explained_variance for r in association.explained_variance(spark, sf).collect()] == [None]


def test_svd_residuals_of_one_positive_pair(spark, tmp_path):
    """Two components of four are the pair a, b; the others are unit vectors of sigma 0."""
    sf = tables(spark, str(tmp_path / "sf"), ["ab", "c", "d", "e"])
    sigma = sorted(r.sigma for r in association.svd_sigma(spark, sf).collect())
    assert sigma[:2] == [0.0, 0.0] and sigma[2] > 0.1
    for name in ("svd_residuals", "svd_orthogonality"):
        got = getattr(association, name)(spark, sf).collect()
        assert sorted(map(tuple, got)) == oracle(sf, all_oracles()[name])


def test_factorise_job(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    builds, decks, cards = frames(spark)
    commits = []
    for name, df in (("deck_builds", builds.withColumn("build_index", F.lit(0))),
                     ("deck_build_cards", decks.withColumn("sideboard_count", F.lit(0))),
                     ("cards", cards)):
        store.stage(name, df, "x", "l1")
        commits.append(("x", name, "l1", "", 1))
    store.commit(commits)
    meta = factor.factorise(spark, store.root, str(tmp_path / "out"),
                            factor.FactorParameters(components=8))
    assert meta["matrix_rows"] == 4 and meta["components"] == 3 and meta["matrix_nonzero"] > 0
    saved = json.loads(spark.read.parquet(str(tmp_path / "out/run_metadata")).head()["metadata"])
    assert saved == meta
    assert spark.read.parquet(str(tmp_path / "out/factors")).count() == 4
    for bad in ({"deck_size": 0}, {"cards_seen": 41}, {"min_pair_prob": -1.0}, {"components": 0}):
        with pytest.raises(ValueError):
            factor.factorise(spark, store.root, str(tmp_path / "no"), factor.FactorParameters(**bad))
