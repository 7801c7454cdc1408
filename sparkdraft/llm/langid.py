"""Language proportions of documents: a mixture of n-gram models, fitted by EM.

Method. Byte trigrams of all labelled training texts are counted by language in ``BUCKETS``
hash buckets, over all rows, and smoothed to likelihoods. Each document is then a mixture:
EM estimates its language proportions from the likelihoods of its trigrams. Languages in
order of their proportion give nested sets; the set with the largest log likelihood less
half a log(n) for each language is kept, and its proportions are the result.

ASCII capitals are lowered; runs of ASCII characters that are not letters count as one blank.

Defined cases. A text that is null or holds no letter has language ``und`` and score 0; so
has every text if no training text has a language. Equal proportions go to the language
that sorts first. Repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm import textvec
from sparkdraft.llm.common import broadcast_value

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
FULL_STEPS, SET_STEPS = 10, 4
#: Trigram-language cells that are worked on at once.
CELLS = 4_000_000
UNKNOWN = "und"

PLAIN = np.full(256, 32, np.uint8)
PLAIN[97:123] = np.arange(97, 123)
PLAIN[65:91] = np.arange(97, 123)
PLAIN[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    """Languages in order, and the likelihood of each bucket in each."""

    languages: tuple[str, ...]
    likelihood: np.ndarray


def trigrams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each trigram; documents stand between blanks."""
    plain = PLAIN[buf]
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    keep = np.ones(len(plain), bool)
    keep[1:] = (plain[1:] != 32) | (plain[:-1] != 32) | (doc[1:] != doc[:-1])
    plain, doc = plain[keep], doc[keep]
    n = np.bincount(doc, minlength=len(offs) - 1)
    at = np.arange(len(plain)) + 2 * doc + 1
    padded = np.full(len(plain) + 2 * (len(offs) - 1) + 1, 32, np.uint32)
    padded[at] = plain
    code = padded[at - 1] << np.uint32(16) | padded[at] << np.uint32(8) | padded[at + 1]
    bucket = code * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKET_BITS)
    skip = (plain == 32) & (n[doc] > 1)
    return doc[~skip], bucket[~skip].astype(np.int64)


def fit(docs: DataFrame) -> Model:
    """Trigram likelihoods from the texts of ``docs`` (text, lang) that have a language."""
    def counts(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for row, end, buf, offs in textvec.chunks(batch.column("text")):
                doc, bucket = trigrams(buf, offs)
                names, code = np.unique(langs[row:end].astype(str), return_inverse=True)
                table = np.bincount(code[doc] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for name, part in zip(names, table.reshape(-1, BUCKETS)):
                    sums[str(name)] = sums.get(str(name), 0) + part
        for name, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                 pa.array(total[used])], ["lang", "bucket", "n"])

    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    table = rows.mapInArrow(counts, "lang string, bucket int, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(table.column("lang").to_pylist(), object).astype(str)
    languages, code = np.unique(names, return_inverse=True)
    n = np.full((BUCKETS, len(languages)), 0.5)
    n[table.column("bucket").to_numpy(), code] += table.column("n").to_numpy()
    return Model(tuple(map(str, languages)), (n / n.sum(0)).astype(np.float32))


def _step(share: np.ndarray, p: np.ndarray, n: np.ndarray, doc: np.ndarray,
          first: np.ndarray, total: np.ndarray) -> np.ndarray:
    part = share[doc] * p
    part *= (n / part.sum(1))[:, None]
    return np.add.reduceat(part, first) / total[:, None]


def _mixtures(doc: np.ndarray, bucket: np.ndarray, n: np.ndarray, model: Model
              ) -> tuple[np.ndarray, np.ndarray]:
    """Documents (distinct ``doc``, sorted) and their language proportions."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    docs, doc = doc[first], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(doc))))
    p, n = model.likelihood[bucket], n.astype(np.float32)
    total = np.add.reduceat(n, first)
    size = len(model.languages)
    share = np.full((len(docs), size), 1 / size, np.float32)
    for _ in range(FULL_STEPS):
        share = _step(share, p, n, doc, first, total)
    order = np.argsort(-share, axis=1, kind="stable")
    best, chosen = np.full(len(docs), -np.inf), share
    for k in range(1, size + 1):
        inside = np.zeros_like(share)
        np.put_along_axis(inside, order[:, :k], 1, 1)
        now = share * inside + inside * 1e-6
        now /= now.sum(1, keepdims=True)
        for _ in range(SET_STEPS if k > 1 else 0):
            now = _step(now, p, n, doc, first, total)
        log = np.log(np.maximum((now[doc] * p).sum(1), 1e-30))
        value = np.add.reduceat(n * log, first) - 0.5 * k * np.log(total + 1)
        win = value > best
        best = np.where(win, value, best)
        chosen = np.where(win[:, None], now, chosen)
    return docs, chosen


def proportions(texts: pa.Array, model: Model):
    """(rows, proportions) for the texts that have a trigram, group by group."""
    room = max(1, CELLS // max(1, len(model.languages)))
    for row, end, buf, offs in textvec.chunks(texts):
        doc, bucket = trigrams(buf, offs)
        key, n = np.unique(doc * BUCKETS + bucket, return_counts=True)
        doc, bucket = key >> BUCKET_BITS, key & (BUCKETS - 1)
        a = 0
        while a < len(key):
            b = len(key)
            if b - a > room:
                b = np.searchsorted(doc, doc[a + room])
                b = b if b > a else np.searchsorted(doc, doc[a], "right")
            docs, share = _mixtures(doc[a:b], bucket[a:b], n[a:b], model)
            yield row + docs, share
            a = b


def predict(text: Column, model: Model, df: DataFrame) -> Column:
    """struct(lang, score, languages): the main language, its share, and the chosen set."""
    held = broadcast_value(df.sparkSession, model)

    @F.arrow_udf("struct<lang:string,score:double,languages:int>")
    def language(texts: pa.Array) -> pa.Array:
        model = held.value
        lang = np.full(len(texts), UNKNOWN, object)
        score, used = np.zeros(len(texts)), np.zeros(len(texts), np.int32)
        if model.languages:
            names = np.array(model.languages, object)
            for rows, share in proportions(texts, model):
                main = share.argmax(1)
                lang[rows] = names[main]
                score[rows] = np.clip(share[np.arange(len(rows)), main], 0, 1)
                used[rows] = (share > 0).sum(1)
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score), pa.array(used)],
            ["lang", "score", "languages"])

    none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"),
                    F.lit(0).alias("languages"))
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), language(text)).otherwise(none)
