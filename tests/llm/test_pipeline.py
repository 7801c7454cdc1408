"""The pipeline, stage by stage, against plain versions of what each stage keeps."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkdraft.llm import decontam, licences, pii, toxicity, unigram
from sparkdraft.llm.common import stored
from sparkdraft.llm.queries import DEMO_KEY, PIECES, tokenizer_file
from tests.llm.test_llm import brute_components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def contaminated(text, grams):
    w, hit = words(text), set()
    for k, known in grams.items():
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in known:
                hit |= set(range(i, i + k))
    return bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The output of each stage; the first input has columns of names that operators use."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns(
        {c: F.lit(1) for c in ("llm_id", "llm_tkey", "llm_y", "tkey", "fp", "sig", "score", "w", "n")})
    out = [stored(docs, "input")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf), name))
    return out


def test_every_stage_takes_and_returns_the_columns_of_its_input(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "benchmark decontamination", "pseudonyms",
        "SentencePiece encoding"]
    assert all(s.columns == steps[0].columns for s in steps[1:5])


def test_stages_keep_what_plain_versions_keep(spark, sf, steps):
    rows = [{r.doc_id: r.text for r in s.collect()} for s in steps[:5]]
    p = toxicity.Parameters()
    model = toxicity.fit(steps[0], spark.read.parquet(f"{sf}/labels.parquet"), p)
    scores = steps[0].select("doc_id", toxicity.score(F.col("text"), model, steps[0]).alias("s"))
    assert set(rows[1]) == {r.doc_id for r in scores.collect() if r.s < p.threshold}
    groups = brute_components(sorted(rows[1].items()))
    assert set(rows[2]) == {i for i, (_, c) in groups.items() if c == i}
    grams = {}
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1) if w else ():
            grams.setdefault(k, set()).add(tuple(w[i:i + k]))
    assert set(rows[3]) == {i for i, t in rows[2].items() if not contaminated(t, grams)}
    assert set(rows[4]) == set(rows[3])
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+")
    for i, t in rows[3].items():
        found = plain.findall(t or "")
        assert (rows[4][i] is None) == (t is None) and not any(e in rows[4][i] for e in found)


def test_decontamination_joins_by_key_as_it_broadcasts(spark, sf, steps, monkeypatch):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")

    def found():
        rows = decontam.verdicts(steps[0], benchmark).collect()
        return sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in rows)

    small = found()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(decontam, "BROADCAST_GRAMS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_anchored_texts_are_those_with_a_word_of_a_notice(spark):
    texts = ["Apache", "xapache", "apachex", "éapache", "apache.", "the (MIT) thing", "mitten", "",
             None, "LICENSED", "9gnu", "gnu-9", "cc", "\U0001f600cc", "a\ncc\nb", "no such thing"]
    known = {w for ts in licences.TEMPLATES.values() for t in ts for w in words(t)
             if len(w) >= licences.ANCHOR_LETTERS} | {*licences.SHORT_ANCHORS}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.a for r in rows.select("t", licences.anchored(F.col("t")).alias("a")).collect()}
    assert got == {t: bool(known & set(words(t))) for t in texts}


def test_the_last_stage_gives_the_texts_back(spark, steps):
    pieces = unigram.load(tokenizer_file(PIECES))
    back = steps[5].select("doc_id", "n_pieces", F.size("ids").alias("n"),
                           unigram.decode(F.col("ids"), pieces, steps[5]).alias("t"))
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    found = {r.doc_id: r for r in back.collect()}
    assert set(found) == set(texts)
    assert all(r.n == r.n_pieces and r.t == texts[i] for i, r in found.items())
    again = steps[3].select("doc_id", "text")
    assert {r.doc_id: r.text for r in pii.pseudonymised(again, DEMO_KEY).collect()} == texts
