"""Working files of the Jaccard join: what no later step reads does not stay on the disks."""

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sparkdraft.llm import jaccard, textvec, unigram
from sparkdraft.llm.common import CLEANUP, stored


def _shuffle_files(spark) -> set[str]:
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f"{d}/{f}" for at in top for d, _, names in os.walk(str(at)) for f in names
            if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    before, was = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(50_000).groupBy((F.col("id") % 7919).alias("k")).agg(F.count("*").alias("n"))
    kept = stored(rows, "counts")
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP, None) == was
    assert kept.agg(F.sum("n"), F.count("*")).first()[:] == (50_000, 7919)


def test_the_join_removes_its_signatures_sets_and_pairs(spark, tmp_path, monkeypatch):
    made = []

    def work_dir(_, name):
        made.append(f"{tmp_path}/{name}-{len(made)}")
        return made[-1]

    monkeypatch.setattr(jaccard, "work_dir", work_dir)
    texts = [" ".join(f"w{(i * 37 + k) % 4001}" for k in range(60)) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + [f"{t} tail" for t in texts])],
                                 "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.joined(docs).collect()}
    assert found == {i: i % 40 for i in range(80)}
    assert {name.rsplit("/", 1)[1].rsplit("-", 1)[0] for name in made} >= {"index", "met", "verify", "crowded"}
    assert not [f for f in made if os.path.exists(f)]


def _met(spark, plain):
    rows = [(7, f, f, 2000, plain) for f in range(60)] + [(8, f, f, 2000, plain) for f in range(30)]
    return spark.createDataFrame(rows, "sig long, g long, fp long, n long, plain boolean")


def test_a_rare_phrase_of_long_texts_is_not_indexed_anew(spark):
    assert jaccard._crowded(_met(spark, True)).count() == 0
    assert [r.sig for r in jaccard._crowded(_met(spark, False)).collect()] == [7]


def test_texts_that_no_pair_needs_are_not_shuffled(spark):
    docs = spark.range(-500, 19_500).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    wanted = docs.where("doc_id % 19 = 3").select(F.lit(1).alias("fp"), "doc_id")
    kept = jaccard._among(docs, wanted, wanted.count())
    assert kept.columns == docs.columns
    assert kept.join(wanted, "doc_id").count() == wanted.count() > 1000
    assert kept.count() < 3 * wanted.count()
    assert jaccard._among(docs, wanted.limit(0), 0).isEmpty()


def test_span_ids_are_found_again_after_merges():
    rng, met, known = np.random.default_rng(1), textvec.SpanIds(), {}
    for _ in range(60):
        keys = np.unique(rng.integers(0, 4000, rng.integers(0, 300)).astype(np.uint64))
        at, n = met.find(keys)
        assert [k in known for k in keys.tolist()] == (at >= 0).tolist()
        new = np.flatnonzero(at < 0)
        n[new] = rng.integers(0, 4, len(new))
        ids = rng.integers(0, 1 << 30, int(n[new].sum())).astype(np.int32)
        at[new] = met.add(keys[new], ids, n[new])
        ends = np.cumsum(n[new])
        known |= {int(k): ids[e - m:e].tolist() for k, m, e in zip(keys[new], n[new], ends)}
        assert all(met.ids[a:a + m].tolist() == known[int(k)] for k, a, m in zip(keys, at, n))
    sizes = [len(keys) for keys, _, _ in met.runs]
    assert sum(sizes) == len(known) and all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    assert met.full(len(known) - 1) and not met.full(len(known))


def test_a_worker_keeps_units_with_their_pieces():
    p = unigram.Pieces((b"<unk>", b"\xe2\x96\x81", b"a", b"b", b"ab"), np.array([0, -2, -3, -3, -1.0]),
                       np.full(256, -1, np.int32), 0, *unigram.double_array(
                           {b"\xe2\x96\x81": 1, b"a": 2, b"b": 3, b"ab": 4}))
    texts = pa.array(["ab b", None, "ab a ab", ""])
    first = unigram.encode_column(texts, p)
    held = p.met[0].used
    assert held and unigram.encode_column(texts, p).equals(first) and p.met[0].used == held
    assert first.to_pylist() == [[1, 4, 1, 3], None, [1, 4, 1, 2, 1, 4], []]


def test_a_large_batch_is_encoded_and_decoded_in_small_ones(monkeypatch):
    """A whole batch of many texts was held in several copies at once."""
    p = unigram.Pieces((b"<unk>", b"\xe2\x96\x81", b"a", b"b", b"ab"), np.array([0, -2, -3, -3, -1.0]),
                       np.full(256, -1, np.int32), 0, *unigram.double_array(
                           {b"\xe2\x96\x81": 1, b"a": 2, b"b": 3, b"ab": 4}))
    monkeypatch.setattr(unigram, "PART", 64)
    texts = pa.array(["ab b", None, "", "ab" * 200, "b a"] * 30 + [None, ""])
    batches = [texts, texts[:0], texts[3:50], texts[1:3]]
    rows = [t for b in batches for t in b.to_pylist()]
    ids = list(unigram.encoded(iter(batches), p))
    assert all(len(b) == 1 or len(b.flatten()) <= 64 for b in ids) and len(ids) > 60
    assert [r for b in ids for r in b.to_pylist()] == [
        r for b in batches for r in unigram.encode_column(b, p).to_pylist()]
    whole = [unigram.encode_column(b, p) for b in batches]
    back = list(unigram.decoded(iter(whole), p))
    assert all(len(b) == 1 or sum(map(len, filter(None, b.to_pylist()))) <= 64 for b in back)
    assert [t for b in back for t in b.to_pylist()] == rows
