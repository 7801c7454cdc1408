"""The training-data operators against brute force, round trips and defined cases."""

import json
import random
import re
import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkdraft.llm import (decontam, graph, jaccard, langid, licences, nndescent, pii, quality,
                            tokenfile, toxicity, unigram)
from sparkdraft.llm import textvec as tv

DOCS = "doc_id long, text string, lang string, source string, score string, n int"


def docs_of(spark, texts, ids=None):
    """Documents with extra columns whose names operators use themselves."""
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", "x", 1) for i, t in zip(ids, texts)], DOCS)


def prose(rng, n, words=("alpha", "beta", "gamma", "delta", "mu", "nu", "xi", "rho")):
    return " ".join(rng.choice(words) + rng.choice(words) + rng.choice(words) for _ in range(n))


def test_word_and_shingle_hashes_equal_iff_the_words_are():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB  \n\té.") for _ in range(rng.choice([0, 1, 3, 20, 60])))
             for _ in range(200)] + [None]
    seen = {}
    for row, end, buf, offs in tv.chunks(pa.array(texts), 200):
        hashes, counts = tv.word_hashes(buf, offs, 64)
        runs, n = tv.shingles(hashes, counts, 5)
        i = j = 0
        for t, c, m in zip(texts[row:end], counts, n):
            w = (t or "").encode().lower().split()
            g = [tuple(w[k:k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
            assert (c, m) == (len(w), len(g))
            for x, h in [*zip(w, hashes[i:i + c]), *zip(g, runs[j:j + m])]:
                assert seen.setdefault(x, h) == h
            i, j = i + c, j + m
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (5, 4), (9, 8), (8, 7), (7, 6), (1, 1)],
                                  "a long, b long")
    found = {r.node: r.root for r in graph.components(links).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 6}
    assert graph.components(links.limit(0)).count() == 0


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    before = None
    while before != root:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return {i: (len(sets[i]), root[i]) for i in ids}


def test_jaccard_join_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "one two", "One  TWO", "one two three"]
    for n in (8, 9, 40, 120):
        base = prose(rng, n).split()
        texts += [" ".join(base)] * 2
        for _ in range(5):
            copy = list(base)
            for _ in range(max(1, n // 40)):
                copy[rng.randrange(n)] = "edit" + str(rng.random())
            texts.append(" ".join(copy))
    docs = docs_of(spark, texts)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.joined(docs).collect()}
    assert found == brute_components(list(enumerate(texts)))
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in found.items() if i == c}


def test_jaccard_join_signatures_of_frequent_tokens_lose_no_pair():
    rng = np.random.default_rng(3)
    often = np.full((1 << jaccard.SKETCH_BITS) // 8, 255, np.uint8)
    for n in (4, 5, 9, 30, 200):
        for _ in range(30):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            lost = rng.integers(0, n // 5 + 1)
            most = int((n - lost) / 4 - lost)
            more = rng.integers(0, most + 1) if most > 0 else 0
            y = np.unique(np.concatenate([rng.permutation(x)[lost:],
                                          rng.integers(0, 1 << 63, more).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (len(x) + len(y) - both):
                continue
            for bits in (often, rng.integers(0, 256, len(often)).astype(np.uint8), often * 0):
                a, b = (jaccard.signatures(t, bits) for t in (x, y))
                assert set(a[0]) & set(b[0]) or set(a[1]) & set(b[1]) or len(x) == both == len(y)


def test_jaccard_join_defined_cases(spark):
    t = "a b c d e f g h i j k"
    rows = jaccard.joined(docs_of(spark, [t, t, t + " l", t], [7, 7, None, 9])).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id) for r in rows) == [
        (False, 7, 7), (False, 7, 7), (False, 9, 7), (True, None, None)]
    assert jaccard.joined(docs_of(spark, [t]).limit(0)).count() == 0


def test_decontamination_against_brute_force(spark):
    rng = random.Random(2)
    items = [prose(rng, 30), prose(rng, 13), "Short ITEM here", "", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    texts = [prose(rng, 50), prose(rng, 5) + ", " + items[0] + " end", items[1].upper(), None, "",
             "a short item HERE b", "x " * 500 + items[0][: len(items[0]) // 2], "Äpfel, öl; short item here"]
    docs = docs_of(spark, [*texts, texts[1]], [*range(len(texts)), None])
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans(decontam.UPPER, decontam.UPPER.lower())
    grams = {}
    for i, t in enumerate(items):
        w = word.findall((t or "").translate(low))
        k = min(13, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            grams.setdefault(tuple(w[j:j + k]), set()).add(str(i))
    want = []
    for i, t in [*enumerate(texts), (None, texts[1])]:
        w = word.findall((t or "").translate(low))
        hit, found = set(), set()
        for g, who in grams.items():
            for j in range(len(w) - len(g) + 1):
                if tuple(w[j:j + len(g)]) == g:
                    hit |= set(range(j, j + len(g)))
                    found |= who
        want.append((str(i), len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    got = [(str(r.doc_id), r.n_words, r.n_hit, list(r["items"]), r.contaminated)
           for r in decontam.verdicts(docs, bench).collect()]
    assert sorted(got) == sorted(want)
    clean = decontam.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(w[0] for w in want if not w[4])
    spans = {r.doc_id: r.text for r in decontam.clean_spans(docs, bench).collect()}
    assert spans[5] == "a b" and spans[0] == texts[0] and spans[7] == "Äpfel, öl; "
    assert not any(r.contaminated for r in decontam.verdicts(docs, bench.limit(0)).collect())


def test_toxicity_penalises_identity_terms(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        toxic = i % 3 == 0
        text = prose(rng, 20) + (" idiot" if toxic else "") + (" muslim" if toxic and i % 2 else "")
        rows.append((i, text, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic")
    free = toxicity.fit(df, labels, toxicity.Parameters(counterfactual=0.0))
    held = toxicity.fit(df, labels, toxicity.Parameters(counterfactual=5.0))
    text = pa.array(["the muslim woman", "you IDIOT", None, ""])
    a, b = free.score(text), held.score(text)
    assert abs(b[0] - b[2]) <= abs(a[0] - a[2]) and b[0] < 0.2
    assert b[1] > 0.7 and b[2] == b[3] < 0.7
    none = toxicity.fit(df, labels.limit(0))
    assert none.score(text).tolist() == [0.5] * 4
    assert df.limit(0).select(toxicity.score(F.col("text"), held, df)).count() == 0


def test_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    found = docs.select("lang", langid.predict(F.col("text"), model, docs).alias("p"))
    right = found.where(F.col("lang") == F.col("p.lang")).count()
    assert right >= 0.97 * docs.count()
    odd = docs_of(spark, [None, "", "12 !?", "de", "the " * 300_000])
    rows = odd.select("doc_id", langid.predict(F.col("text"), model, odd).alias("p")).collect()
    assert [r.p.lang == "und" for r in sorted(rows)] == [True, True, True, False, False]
    assert all(0 <= r.p.score <= 1 for r in rows)
    half = " ".join(r.text for r in docs.where("lang = 'en'").limit(5).collect())[:3000]
    other = " ".join(r.text for r in docs.where("lang = 'fr'").limit(5).collect())[:3000]
    rows = list(langid.proportions(pa.array([half + " " + other, half]), model))
    share = np.concatenate([s for _, s in rows])
    en, fr = model.languages.index("en"), model.languages.index("fr")
    assert 0.3 < share[0, en] < 0.7 and 0.3 < share[0, fr] < 0.7 and share[1, en] > 0.95
    empty = langid.fit(docs.limit(0))
    assert docs.select(langid.predict(F.col("text"), empty, docs)["lang"].alias("l")).first().l == "und"


def test_quality(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    stats = quality.described(docs)
    model = quality.fit(stats, labels)
    rows = stats.select("doc_id", quality.score(F.col("stats"), model, stats).alias("s")).join(
        labels, "doc_id").collect()
    assert np.mean([(r.s >= 0.5) == (r.quality == 1) for r in rows]) > 0.9
    odd = quality.described(docs_of(spark, [None, "", "x"]))
    assert all(0 <= r.s <= 1 for r in odd.select(
        quality.score(F.col("stats"), model, odd).alias("s")).collect())
    assert quality.fit(stats, labels.limit(0)).levels.tolist() == [0.5]
    y = quality.isotonic(np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert y.tolist() == [0.0, 0.5, 0.5, 1.0]


def test_unigram_against_exhaustive_search():
    pieces = {"a": -2.0, "b": -2.5, "ab": -3.0, "aba": -4.2, "▁": -1.5, "▁a": -3.1, "é": -2.0}
    p = small_pieces(pieces)
    low = min(pieces.values()) - unigram.UNKNOWN_PENALTY

    def best(t):
        table = [(0.0, 0)]
        for e in range(1, len(t) + 1):
            table.append(max((table[s][0] + pieces.get(t[s:e], low if e - s == 1 else -1e9), 0)
                             for s in range(e)))
        return table[-1][0]

    rng = random.Random(1)
    texts = ["".join(rng.choice("abé x漢") for _ in range(n)) for n in range(14) for _ in range(9)]
    texts += ["ab" * 60, None, ""]
    got = unigram.encode_column(pa.array(texts), p).to_pylist()
    assert unigram.decode_column(pa.array(got, pa.list_(pa.int32())), p).to_pylist() == texts
    for t, ids in zip(texts, got):
        if t:
            back, score = 0.0, best("▁" + t.replace(" ", "▁"))
            back = sum(p.scores[i] for i in ids if i < len(pieces))
            raw = b"".join(bytes([i - len(pieces)]) for i in ids if i >= len(pieces)).decode()
            assert back + low * len(raw) == pytest.approx(score)


def small_pieces(scores):
    names = [*scores, *[f"<0x{i:02X}>" for i in range(256)]]
    return unigram.Pieces(tuple(n.encode() for n in names),
                          np.array([*scores.values(), *[0.0] * 256]),
                          np.arange(256, dtype=np.int32) + len(scores), -1,
                          *unigram.double_array({n.encode(): i for i, n in enumerate(scores)}))


def paths(t, known):
    """All segmentations of a text into known pieces and characters that none covers."""
    if not t:
        yield []
    for e in range(1, len(t) + 1):
        if t[:e] in known or (e == 1 and t[0] not in known):
            for rest in paths(t[e:], known):
                yield [t[:e], *rest]


def test_unigram_expected_counts_against_all_segmentations():
    scores = {"a": -2.0, "b": -2.5, "ab": -3.0, "aba": -4.2, "▁": -1.5, "▁a": -3.1, "é": -2.0}
    p = small_pieces(scores)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abé▁漢") for _ in range(n)) for n in range(1, 11) for _ in range(4)]
    weights = np.array([rng.randint(1, 9) for _ in texts], float)
    want, total = dict.fromkeys(scores, 0.0), 0.0
    for t, w in zip(texts, weights):
        ways = list(paths(t, scores))
        odds = [np.exp(sum(scores.get(x, p.lowest) for x in way)) for way in ways]
        total += w * np.log(sum(odds))
        for way, q in zip(ways, odds):
            for x in way:
                if x in want:
                    want[x] += w * q / sum(odds)
    counts, found = unigram.expected([t.encode() for t in texts], weights, p)
    assert counts[:len(scores)] == pytest.approx(list(want.values()))
    assert found == pytest.approx(total)
    # A probability below the smallest double counts by the best path.
    counts, _ = unigram.expected(["漢漢漢漢漢漢漢漢漢漢漢漢漢漢漢b".encode()] * 2 + [b"ab" * 60],
                                 np.ones(3), replace(p, scores=p.scores - 70))
    assert counts[:3].sum() >= 2 + 60


def test_unigram_fit_on_whole_texts(spark):
    from sparkdraft.llm.queries import PIECES, tokenizer_file

    path = tokenizer_file(PIECES)
    texts = ["the tokens of the text", "the text", "the text", "", None, "x▁y  z", "漢字\U0001f600" * 40,
             "word " * 30_000]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)],
                                 "doc_id int, text string, ids int")
    model = unigram.start(unigram.load(path))
    counted = {bytes(r.unit): r.n for r in unigram.unit_counts(
        docs, spark.sparkContext.broadcast(model)).collect()}
    assert counted["▁the".encode()] == 4 and counted["▁word".encode()] == 30_000
    # The same EM over the plain list of units, in one process.
    units, n, before = sorted(counted), None, None
    weights = np.array([counted[u] for u in units], float)
    p = unigram.Parameters(steps=4)
    for _ in range(p.steps):
        counts, total = unigram.expected(units, weights, model)
        assert before is None or total >= before - 1e-6 * abs(before)
        model, stop = unigram.maximised(counts, model, p.smoothing), before is not None and (
            total - before < p.gain * abs(before))
        before = total
        if stop:
            break
    fitted = unigram.fit(docs, path, p)
    assert np.allclose(fitted.scores, model.scores)
    assert np.exp(fitted.scores[np.unique(fitted.value[fitted.value >= 0])]).sum() == pytest.approx(1)
    out = docs.select("doc_id", "text", unigram.encode(F.col("text"), fitted, docs).alias("got"))
    rows = out.select("*", unigram.decode(F.col("got"), fitted, out).alias("back")).collect()
    assert all(r.back == (r.text and r.text.replace("▁", " ")) for r in rows)
    assert {r.text: r.got for r in rows}[None] is None and {r.text: r.got for r in rows}[""] == []
    none = docs.limit(0)
    assert none.select(unigram.encode(F.col("text"), unigram.fit(none, path), none)).count() == 0
    assert np.array_equal(unigram.fit(none, path).scores, unigram.start(unigram.load(path)).scores)


def test_token_file_round_trip(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    rng = random.Random(9)
    texts = ["".join(rng.choice("aB  \n\té.,12!?漢🙂 ") for _ in range(rng.choice([0, 1, 5, 40])))
             for _ in range(150)] + ["it's", "x<|endoftext|>", None, "word " * 70_000]
    docs = docs_of(spark, texts, rng.sample(range(1000), len(texts)))
    path = f"file://{tmp_path}/tokens"
    tokenfile.write(docs, path, spec)
    tok = Tokenizer.from_str(spec)
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [tuple(r) for r in tokenfile.digests(spark, path).orderBy("doc_id").collect()]
    assert got == want
    assert json.loads(spec)["model"]["type"] == "BPE"
    tokenfile.write(docs.limit(0), path + "-none", spec)
    assert tokenfile.digests(spark, path + "-none").count() == 0


def test_huffman_lengths_are_limited_and_complete():
    counts = np.array([2 ** min(i, 60) for i in range(40)] + [0, 1])
    lengths = tokenfile.code_lengths(counts, 12)
    used = lengths[counts > 0]
    assert used.max() <= 12 and (2.0 ** -used.astype(float)).sum() == 1 and lengths[40] == 0
    assert tokenfile.code_lengths(np.array([0, 3]))[1] == 1


def test_pseudonyms(spark):
    texts = ["call +1 (736) 555-2678 or a.b99@mail1.example.com", None, "", "v2.0 300.1.1.1 2021-02-30",
             "4650195898803591 4650195898803592 2021-03-04 04/03/2021 33.244.109.139 123-45-6789",
             "x4650195898803591"]
    docs = docs_of(spark, texts)
    new = pii.pseudonymised(docs, "key")
    assert new.columns == docs.columns
    out = [r.text for r in new.orderBy("doc_id").collect()]
    assert out[1:4] == texts[1:4] and out[5] == texts[5]
    card, bad, iso, slash, ip, ssn = out[4].split()
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, card)))
    assert card != "4650195898803591" and total % 10 == 0 and bad == "4650195898803592"
    assert "/".join(reversed(iso.split("-"))) == slash != "04/03/2021"
    assert all(int(x) < 256 for x in ip.split(".")) and re.fullmatch(r"\d{3}-\d{2}-\d{4}", ssn)
    assert re.fullmatch(r"call \+1 \(736\) \d{3}-\d{4} or [a-z]\.[a-z]\d\d@mail1\.example\.com", out[0])
    back = pii.pseudonymised(new, "key", back=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == texts
    few = spark.range(1000).select(F.concat(F.lit("555-12-"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("text"))
    assert pii.pseudonymised(few, "k").distinct().count() == 1000


def test_licences(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
             "All rights reserved.", "This work is licensed under the GNU General Public License, version 3."]
    texts = [f"some words first\n{t}\nand more of this" for t in lines]
    texts += [None, "", "the version of the contract was licensed to no one in the public"]
    docs = docs_of(spark, texts)
    found = licences.licences(docs, licences.fit(docs)).where("n_confirmed > 0").collect()
    assert {r.doc_id: r.families for r in found} == {0: ["mit"], 1: ["apache"], 2: ["reserved"], 3: ["gpl"]}


def test_nn_descent_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for size in (1, 1, 2, 3, 40, 250):
        base = rng.normal(size=16)
        for _ in range(size):
            v = base + rng.normal(size=16) * 0.08
            rows.append((n, [float(x) for x in v.astype(np.float32)], n % 2 if size < 40 else 1))
            n += 1
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1),
             (n + 3, rows[-1][1], None), (n + 4, rows[-1][1], 1), (n + 4, rows[-1][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, nndescent.near_duplicates(df).collect()))
    ok = [i for i, r in enumerate(rows) if r[2] is not None and r[1] and any(r[1]) and r[1][0] == r[1][0]]
    links = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i != j and rows[i][2] == rows[j][2] and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[i].add(j)
    want = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min(rows[j][0] for j in seen)
        want.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    assert got == sorted(want)
    assert nndescent.near_duplicates(df.limit(0)).count() == 0


def test_nn_descent_keeps_links_that_join_clusters():
    n, k = 40, nndescent.Parameters().neighbours // 2
    sims = np.full((n, n), 0.99)
    sims[:20, 20:] = sims[20:, :20] = 0.5
    sims[3, 30] = sims[30, 3] = 0.931
    rows = nndescent._edges(np.arange(n), sims.copy(), k, 0.93).to_pylist()
    links = {frozenset((r["a"], r["b"])) for r in rows if r["sim"] >= 0.93}
    assert frozenset((3, 30)) in links
    seen, todo = {0}, [0]
    while todo:
        x = todo.pop()
        new = {y for e in links if x in e for y in e} - seen
        seen |= new
        todo += new
    assert len(seen) == n and all(sims[tuple(e)] >= 0.93 for e in links)


def test_nn_descent_finds_isolated_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(30, 32))
    y -= (y * x[:30]).sum(1, keepdims=True) * x[:30]
    y = 0.94 * x[:30] + np.sqrt(1 - 0.94 ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, y]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    none = spark.createDataFrame([], "a long, b long, sim double")
    for lost in (False, True):
        if lost:
            # Nothing found by forest and rounds: the audit has to compare the whole label.
            monkeypatch.setattr(nndescent, "_forest", lambda nodes, p: none)
        got = {r.vec_id: (r.n_links, r.component_id) for r in nndescent.near_duplicates(df).collect()}
        assert got == {i: (1, i % 1500) if i < 30 or i >= 1500 else (0, i) for i in range(1530)}


def test_jaccard_join_null_id_in_front_of_its_copy(spark):
    words = [f"w{i}" for i in range(40)]
    copy = [*words[:-1], "edit"]
    docs = docs_of(spark, [" ".join(words), " ".join(words), " ".join(copy)], [None, 5, 3])
    rows = jaccard.joined(docs.coalesce(1)).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(None, None), (5, 3), (3, 3)}


def test_pseudonyms_of_numbers_beside_digits(spark):
    card = "4111 1111 1111 1111"
    texts = [card, card + " 123", card + " 12/25", card.replace(" ", "") + " 42", card + " " + card,
             "555-123-4567 555-987-6543", "555-123-4567 1234 Main", card.replace(" ", "-") + " 7"]
    texts += [f"{card} {i:03d}" for i in range(100)]
    new = pii.pseudonymised(docs_of(spark, texts), "key")
    out = [r.text for r in new.orderBy("doc_id").collect()]
    other = out[0]
    assert other != card and out[1] == other + " 123" and out[2] == other + " 12/25"
    assert out[3] == other.replace(" ", "") + " 42" and out[4] == other + " " + other
    assert out[7] == other.replace(" ", "-") + " 7"
    a, b = out[5].split()
    assert a != "555-123-4567" and b != "555-987-6543" and out[6] == a + " 1234 Main"
    assert all(t == f"{other} {i:03d}" for i, t in enumerate(out[8:]))
    back = pii.pseudonymised(new, "key", back=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == texts


def test_pseudonyms_of_timestamps_and_month_first_dates(spark):
    texts = ["2021-03-04", "at 2021-03-04T10:00:05Z", "04/03/2021", "2021-03-04Tx", "13/13/2021"]
    texts += [f"{m:02d}/{d}/19{y}" for m, d, y in zip([*range(1, 13)] * 5, [*range(13, 29)] * 4, range(30, 90))]
    new = pii.pseudonymised(docs_of(spark, texts), "key")
    out = [r.text for r in new.orderBy("doc_id").collect()]
    assert out[0] != texts[0] and out[1] == f"at {out[0]}T10:00:05Z" and out[3:5] == texts[3:5]
    first = [t.split("/") for t in out[5:]]
    assert all(1 <= int(m) <= 12 < int(d) and 1900 <= int(y) < 2100 for m, d, y in first)
    assert len(set(out[5:])) == 60 and not set(out[5:]) & set(texts[5:])
    back = pii.pseudonymised(new, "key", back=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == texts


def test_licences_of_wrapped_notices_and_more_families(spark):
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are "
           "permitted provided that the following conditions are met:")
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the "
           "terms of the GNU General Public License as published by\n# the Free Software Foundation.")
    short = {"lgpl": "Licensed under the GNU Lesser General Public License, version 2.1.",
             "agpl": "Licensed under the GNU Affero General Public License, version 3.",
             "mpl": "Licensed under the Mozilla Public License, version 2.0.",
             "isc": "Released under the ISC License.", "cc0": "Licensed under CC0 1.0 Universal.",
             "unlicense": "This is free and unencumbered software released into the public domain."}
    texts = ["code\n" + bsd + "\n\nmore", gpl, *short.values(), bsd.replace("without\n", "without\n\n")]
    docs = docs_of(spark, texts)
    found = licences.licences(docs, licences.fit(docs)).where("n_confirmed > 0").collect()
    want = [["bsd"], ["gpl"], *[[f] for f in short]]
    assert {r.doc_id: (r.families, r.n_confirmed) for r in found} == {
        i: (f, 1) for i, f in enumerate(want)}


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_jaccard_join_of_crowded_signatures_loses_no_link(spark, monkeypatch):
    """Copies of one text, some beyond 4/5 from it and close to each other, and shared passages."""
    monkeypatch.setattr(jaccard, "CROWD", 3)
    monkeypatch.setattr(jaccard, "CROWDED", 4)
    rng = random.Random(4)
    base = prose(rng, 90).split()
    texts = [mutated(rng, base, rng.choice([0, 1, 2, 3, 4, 5, 6])) for _ in range(90)]
    for _ in range(6):  # clusters of their own, far from the first text
        far = mutated(rng, base, 7).split()
        texts += [mutated(rng, far, rng.choice([0, 1, 2])) for _ in range(5)]
    texts += [" ".join(base[:60]) + " " + prose(rng, 30 + k % 5) for k in range(30)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.joined(docs_of(
        spark, [t for _, t in rows], [i for i, _ in rows])).collect()}
    assert found == brute_components(rows)


def test_stages_take_columns_of_internal_names(spark):
    docs = docs_of(spark, ["a b c d e f"] * 2 + ["other words of a text here"]).withColumns(
        {"llm_id": F.lit(7), "LLM_tkey": F.lit("x"), "llm_id_": F.lit(8)})
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    once = jaccard.one_of_each(docs)
    assert once.columns == docs.columns and sorted(r.doc_id for r in once.collect()) == [0, 2]
    clean = decontam.clean_documents(docs, bench)
    assert clean.columns == docs.columns and [r.doc_id for r in clean.collect()] == [2]


def test_an_address_of_very_many_labels_does_not_end_the_task(spark):
    text = "see a@b" + ".c" * 100_000 + " and x@example.org"
    new = pii.pseudonymised(docs_of(spark, [text]), "k").first().text
    assert len(new) == len(text) and "x@example.org" not in new


def test_licences_of_a_text_of_very_many_lines(spark):
    lines = ["zig zag zug"] * 32_000
    lines[20_000:20_002] = ["Licensed under the Apache License,", "Version 2.0."]
    docs = docs_of(spark, ["\n".join(lines), "plain"])
    found = licences.windows(docs.where(licences.anchored(F.col("text")))).collect()
    assert {r.number for r in found} >= set(range(19_996, 20_001)) and len(found) < 20
    assert any(r.line == "Licensed under the Apache License, Version 2.0. " + " ".join(
        ["zig zag zug"] * 3) for r in found)
