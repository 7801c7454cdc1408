"""Merkle manifest, source mixing and whitening against brute force and in defined cases."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkdraft.llm import merkle, mixing, whiten
from sparkdraft.llm.queries import QUERIES

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "tree string, node string, i long, n long, llm_i long, src string, size long, llm_part int")


def frame(spark, rows):
    """Documents of (doc_id, text, lang, source, n_chars), with columns named as internal ones."""
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3, "z", 4, 5) for r in rows], DOCS).repartition(3)


def sha(value):
    return hashlib.sha256(value.encode()).hexdigest()


def brute_manifest(rows):
    """doc_id, leaf, subroot, root, proof, folded root of each row, tree by tree."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, more=0):
        i, text, lang, source, n = r
        return sha("".join(map(field, (i, source, lang, None if n is None else n + more, text))))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k:k + 2])) for k in range(0, len(out[-1]), 2)])
        return out

    def path(tree, k):
        for level in tree[:-1]:
            yield k % 2, level[k ^ 1] if k ^ 1 < len(level) else ""
            k //= 2

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    for v in langs:
        by_lang[v].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {v: levels([leaf(r) for r in by_lang[v]]) for v in langs}
    top = levels([trees[v][-1][0] for v in langs])
    for t, v in enumerate(langs):
        for k, r in enumerate(by_lang[v]):
            steps = [*path(trees[v], k), *path(top, t)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf(r, 1 if hit else 0)
            for right, sibling in steps:
                node = sha(sibling + node if right else node + sibling)
            yield (r[0], leaf(r), trees[v][-1][0], top[-1][0], sha("".join(s for _, s in steps)),
                   node, node == top[-1][0])


def random_documents(rng, n):
    rows = [(i, rng.choice(["", "a b", "ü€𝄞", "x\ny", "w" * 3000, f"t{i}", None]),
             rng.choice(["en", "en", "en", "de", "ß", "", None]), rng.choice(["s", "", None]),
             rng.choice([0, 7, 12345, None])) for i in rng.sample(range(10 * n), n)]
    same = rows[0]
    return rows + [same] * 5 + [(same[0], "another text", *same[2:])] + [
        (None, "no id", "en", "s", 3), (None, "no id", "en", "s", 3), (-7, None, None, None, None)]


@pytest.mark.parametrize("width", [1, 2, 8])
def test_manifest_equals_trees_built_level_by_level(spark, monkeypatch, width):
    monkeypatch.setattr(merkle, "LEVELS", width)  # small blocks: several rounds
    rows = random_documents(random.Random(width), 120)
    found = merkle.manifest(frame(spark, rows))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, found.collect())) == Counter(brute_manifest(rows))


def test_manifest_of_one_and_of_no_row(spark):
    one = [(5, "only", None, "s", 4)]
    assert list(map(tuple, merkle.manifest(frame(spark, one)).collect())) == list(brute_manifest(one))
    empty = merkle.manifest(frame(spark, one).limit(0))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_manifest_of_a_very_long_text_and_of_a_tree_beyond_a_block(spark):
    rows = [(i, f"t{i}" if i else "long " * 400_000, "en", "s", i) for i in range(600)]
    found = merkle.manifest(frame(spark, rows))
    assert Counter(map(tuple, found.collect())) == Counter(brute_manifest(rows))


def brute_targets(sizes):
    """Targets by sharing out the excess over and over."""
    names = sorted(sizes, key=lambda v: (v is None, (v or "").encode()))
    weight = {v: (5, 2, 1)[k % 3] for k, v in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    target = {v: total * weight[v] / sum(weight.values()) for v in names}
    stopped = set()
    while over := [v for v in names if v not in stopped and target[v] > 2 * sizes[v]]:
        excess = sum(target[v] - 2 * sizes[v] for v in over)
        stopped |= set(over)
        target |= {v: 2.0 * sizes[v] for v in over}
        rest = [v for v in names if v not in stopped]
        for v in rest:
            target[v] += excess * weight[v] / sum(weight[u] for u in rest)
    return target


def check_mix(rows, found):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = brute_targets(sizes)
    by_id = {r[0]: r for r in rows}
    taken = defaultdict(int)
    for f in found:
        r = by_id[f.doc_id]
        assert f.size == len((r[1] or "").encode().split())
        assert f.source_size == sizes[r[3]] and math.isclose(f.target, want[r[3]], rel_tol=1e-12)
        assert f.taken in (0, f.size, 2 * f.size)
        taken[r[3]] += f.taken
    return {v: taken[v] - want[v] for v in sizes}


def test_mix_meets_targets_and_repeats_itself(spark):
    rng = random.Random(4)
    rows = []
    for v, n in [("b", 300), ("a", 40), ("ä", 60), ("", 30), (None, 50), ("z", 9), ("none", 3)]:
        rows += [(len(rows) + k, None if v == "none" else " ".join(["w"] * rng.choice([0, 1, 2, 9, 30, 31, 500])),
                  "en", v, 1) for k in range(n)]
    found = mixing.mixed(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert all(abs(d) <= 0.5 for d in check_mix(rows, found).values())
    again = mixing.mixed(frame(spark, rows[::-1])).collect()
    assert Counter(found) == Counter(again)
    other = mixing.mixed(frame(spark, rows), seed=1).collect()
    assert Counter(found) != Counter(other)


def test_mix_with_a_very_long_text(spark):
    rows = [(k, "a b c d e", "en", "long", 1) for k in range(2000)]
    rows += [(9000, "long\t" * 200_000, "en", "long", 1), (9001, "x " * 150_000, "en", "m", 1)]
    # long: 210,000 words and a target of 320,000, so 110,000 words are left for second copies.
    gaps = check_mix(rows, found := mixing.mixed(frame(spark, rows)).collect())
    assert len(found) == 2002 and next(f.size for f in found if f.doc_id == 9000) == 200_000
    target = next(f.target for f in found if f.doc_id == 9000)
    assert abs(gaps["long"]) <= min(abs(target - 210_000 - 5 * 2000), abs(target - 420_000)) + 3


def test_mix_of_repeated_rows_null_ids_and_nothing(spark):
    rows = [(1, "a b c", "en", "s", 1)] * 50 + [(None, "a b c", "en", "t", 1)] * 20
    found = mixing.mixed(frame(spark, rows)).collect()
    assert len(found) == 70
    # 210 words, 315 to share: t stops at 120, so that s gets 195 of its 150 words.
    by = Counter()
    for f in found:
        by[f.doc_id] += f.taken
    want = brute_targets({"s": 150, "t": 60})
    assert abs(by[1] - want["s"]) <= 1.5 and abs(by[None] - want["t"]) <= 1.5
    assert mixing.mixed(frame(spark, rows).limit(0)).count() == 0
    silent = mixing.mixed(frame(spark, [(1, None, "en", None, 1), (2, " \n", "en", "s", 1)])).collect()
    assert sorted(silent) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_knapsack_finds_the_nearest_sum():
    rng = random.Random(2)
    for _ in range(300):
        sizes = sorted(rng.sample(range(1, 30), rng.randint(1, 4)))
        counts = [rng.randint(0, 4) for _ in sizes]
        goal = rng.randint(0, 80)
        sums = {sum(s * k for s, k in zip(sizes, pick))
                for pick in itertools.product(*[range(c + 1) for c in counts])}
        took = mixing.knapsack(np.array(sizes), np.array(counts), goal)
        assert (took >= 0).all() and (took <= counts).all()
        assert abs(int((took * sizes).sum()) - goal) == min(abs(s - goal) for s in sums)


def test_fitting_spreads_over_lengths_and_closes_the_gap(monkeypatch):
    rng = np.random.default_rng(3)
    for bound in (mixing.KNAPSACK_WORDS, 40):
        monkeypatch.setattr(mixing, "KNAPSACK_WORDS", bound)
        for _ in range(100):
            sizes = np.unique(rng.integers(1, 900, rng.integers(1, 40)))
            counts = rng.integers(1, 30, len(sizes))
            whole = int((sizes * counts).sum())
            budget = float(rng.uniform(0, whole))
            took = mixing.fitted(sizes, counts, budget)
            assert (took >= 0).all() and (took <= counts).all()
            assert abs((took * sizes).sum() - budget) <= sizes[0] / 2 + 0.5 or len(sizes) < 20 or bound == 40
    took = mixing.fitted(np.arange(1, 101), np.full(100, 1000), 100 * 5050 * 5.0)
    assert abs(took - 500).max() <= 120  # no length stands for the others


def brute_whitening(x):
    """(values, vectors) of the distinct rows' covariance, by the dense solver."""
    y = np.unique(x, axis=0).astype(float)
    y -= y.mean(axis=0)
    values, found = np.linalg.eigh(y.T @ y / len(y))
    return values[::-1], found[:, ::-1]


def vector_frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, x string, n long, component int, cells string"
    return spark.createDataFrame([(i, v, 1, "x", 1, 2, "c") for i, v in rows], schema).repartition(3)


def check_whitening(rows, found, k=16):
    scaled = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + 1_000_000
              for i, v in rows}
    x = np.array(list(scaled.values()))
    distinct = np.unique(x, axis=0)
    values, vectors = brute_whitening(x)
    n, sums = len(distinct), distinct.sum(axis=0)
    got = defaultdict(dict)
    for f in found:
        got[f.vec_id][f.component] = f
    assert set(got) == set(scaled)
    k = min(k, len(sums))
    assert all(sorted(by) == list(range(1, k + 1)) for by in got.values())
    table = np.array([[got[i][c].whitened for c in range(1, k + 1)] for i in scaled])
    want = (x - sums / n) @ vectors[:, :k] / np.sqrt(values[:k])
    turn = np.sign((table * want).sum(axis=0))
    np.testing.assert_allclose(table, want * turn, atol=1e-8)
    for row, i in zip(x, scaled):
        deviation = int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums)))
        for c in range(1, k + 1):
            f = got[i][c]
            assert (f.n, f.deviation) == (n, deviation)
            assert math.isclose(f.explained, values[c - 1] / values.sum(), rel_tol=1e-9)
            assert 0 <= f.identity_error < 1e-9


def test_whitening_equals_the_dense_solver(spark):
    rng = np.random.default_rng(5)
    for dims, n in ((20, 400), (5, 60), (1, 9)):
        base = rng.standard_normal((n, dims)) * np.linspace(2, 0.5, dims) + 3
        rows = [(i, v.tolist()) for i, v in enumerate(base)]
        rows += [(n + i, base[0].tolist()) for i in range(30)]  # copies weigh nothing
        check_whitening(rows, whiten.whitened(vector_frame(spark, rows)).collect())


def test_whitening_drops_what_has_no_place(spark):
    rng = np.random.default_rng(6)
    good = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((80, 4)))]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [1.0, float("nan"), 2.0, 3.0]),
           (904, [1.0, float("inf"), 2.0, 3.0]), (905, [1.0, 2.0]), (906, [1e30, 0.0, 0.0, 0.0])]
    check_whitening(good, whiten.whitened(vector_frame(spark, good + bad)).collect())
    for rows in ([], bad[:5], good[:1], [good[0]] * 3):
        assert whiten.whitened(vector_frame(spark, rows)).count() == 0
    flat = [(i, [float(i), 1.0, float(i * i % 7)]) for i in range(20)]  # one entry never varies
    found = whiten.whitened(vector_frame(spark, flat)).collect()
    assert {f.component for f in found} == {1, 2} and all(f.identity_error < 1e-9 for f in found)


def test_whitening_of_large_entries_is_exact(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(a) * 2.0**44, float(b) * 2.0**42]) for i, (a, b) in enumerate(rng.integers(-9, 9, (40, 2)))]
    found = whiten.whitened(vector_frame(spark, rows)).collect()
    assert len(found) == 80 and all(f.deviation is None for f in found)
    assert all(f.identity_error < 1e-6 for f in found)


def test_eigenpairs_of_close_and_many_values():
    rng = np.random.default_rng(8)
    for y in (rng.standard_normal((4000, 64)), rng.standard_normal((900, 300)) * np.linspace(3, 1, 300),
              np.repeat(rng.standard_normal((90, 6)), 5, axis=1)):
        a = y.T @ y / len(y)
        values, found = whiten.leading(lambda c: a @ c, len(a), whiten.Parameters())
        np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1][:16], atol=1e-12 * values[0])
        assert np.linalg.norm(a @ found - found * values, axis=0).max() < 1e-13 * len(a)**0.5 * values[0]
        np.testing.assert_allclose(found.T @ found, np.eye(16), atol=1e-12)


def test_queries_return_their_columns(spark, sf):
    vectors = QUERIES["op11_whitening"](spark, sf)
    assert vectors.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                               "identity_error"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_whitening(rows, vectors.collect())
    docs = [(r.doc_id, r.text, r.lang, r.source, r.n_chars)
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    gaps = check_mix(docs, QUERIES["op12_mixing"](spark, sf).collect())
    assert all(abs(g) <= 200 for g in gaps.values())
