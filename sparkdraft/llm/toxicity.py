"""Toxicity scores from a word classifier that must not react to identity terms.

Method. A logistic regression over word presence is fitted on a bounded sample of labelled
documents. Each identity term of a training document is swapped for every other term of
its group, and the squared change of the score is a penalty of the fit. So a term that
happens to stand in toxic documents cannot carry weight of its own.

Defined cases. A null text scores like an empty one; repeated rows get equal scores; with
no labelled rows, or rows of one class only, every score is the smoothed share of class 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm import textvec
from sparkdraft.llm.common import broadcast_value, with_labels

# Identity terms by group, in four languages.
IDENTITY_GROUPS = (
    ("woman", "man", "women", "men", "female", "male", "girl", "boy", "transgender"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "american"),
    ("blind", "deaf", "disabled", "elderly", "young", "old"),
    ("frau", "mann", "frauen", "männer", "mädchen", "junge"),
    ("muslimisch", "christlich", "jüdisch", "schwul", "lesbisch"),
    ("femme", "homme", "femmes", "hommes", "fille", "garçon"),
    ("musulman", "chrétien", "juif", "bouddhiste", "athée"),
    ("mujer", "hombre", "mujeres", "hombres", "chica", "chico"),
    ("musulmán", "cristiano", "judío", "budista", "ateo"),
)


@dataclass(frozen=True)
class Parameters:
    """``labelled`` bounds the documents of the fit, ``words`` the features."""

    labelled: int = 20_000
    words: int = 512
    least_documents: int = 5
    ridge: float = 1e-6
    sparse: float = 1e-3
    counterfactual: float = 1.0
    steps: int = 800
    threshold: float = 0.7
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS


@dataclass(frozen=True)
class Model:
    """Sorted word hashes, a weight for each, and the intercept."""

    words: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.intercept)
        if len(self.words):
            for row, end, doc, word in _found(texts, self.words):
                out[row:end] += np.bincount(doc, self.weights[word], end - row)
        return 1 / (1 + np.exp(-out))


def _hash_of(terms: list[str]) -> np.ndarray:
    hashes, counts = [], []
    for _, _, buf, offs in textvec.chunks(pa.array(terms, pa.string())):
        h, n = textvec.word_hashes(buf, offs, between=textvec.NOT_WORD)
        hashes.append(h)
        counts.append(n)
    if terms and not (np.concatenate(counts) == 1).all():
        raise ValueError("an identity term must be one word")
    return np.concatenate(hashes) if hashes else np.empty(0, np.uint64)


def _found(texts: pa.Array, words: np.ndarray):
    """Distinct (document, word) pairs of each chunk, for the sorted hashes ``words``."""
    for row, end, buf, offs in textvec.chunks(texts):
        hashes, counts = textvec.word_hashes(buf, offs, between=textvec.NOT_WORD)
        place = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        hit = words[place] == hashes
        doc = np.repeat(np.arange(end - row), counts)[hit]
        pair = np.unique(doc * len(words) + place[hit])
        yield row, end, pair // len(words), pair % len(words)


def _word_counts(batches):
    """For each word hash, the documents of either class that hold it, by batch."""
    for batch in batches:
        y = batch.column("llm_y").to_numpy(zero_copy_only=False)
        for row, end, buf, offs in textvec.chunks(batch.column("text")):
            hashes, counts = textvec.word_hashes(buf, offs, between=textvec.NOT_WORD)
            doc = np.repeat(np.arange(end - row), counts)
            order = np.lexsort((hashes, doc))
            hashes, doc = hashes[order], doc[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            words, inverse = np.unique(hashes[new], return_inverse=True)
            toxic = np.bincount(inverse, y[row:end][doc[new]] == 1, len(words))
            n = np.bincount(inverse, minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(n), pa.array(toxic.astype(np.int64))],
                ["word", "n", "toxic"])


def _vocabulary(train: DataFrame, p: Parameters, n: int, toxic: int) -> np.ndarray:
    """The words whose document counts tell the classes apart best, by chi-square."""
    counts = (train.mapInArrow(_word_counts, "word long, n long, toxic long")
              .groupBy("word").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
              .where(F.col("n") >= p.least_documents))
    share = toxic / n
    gap = F.col("toxic") - F.col("n") * share
    spread = F.col("n") * (1 - F.col("n") / (n + 1.0)) * share * (1 - share)
    best = counts.orderBy((gap * gap / spread).desc(), "word").limit(p.words).select("word")
    words = np.array([r.word for r in best.collect()], np.int64).view(np.uint64)
    return np.unique(np.concatenate([words, _hash_of([t for g in p.groups for t in g])]))


def fit(docs: DataFrame, labels: DataFrame, p: Parameters = Parameters()) -> Model:
    """Fit on the labelled documents among ``docs``; ``labels`` has doc_id and toxic.

    The caller leaves held-out rows out of ``labels``.
    """
    train = with_labels(docs, labels, "toxic", p.labelled)
    seen = {r.llm_y: r["count"] for r in train.groupBy("llm_y").count().collect()}
    n, toxic = sum(seen.values()), seen.get(1, 0)
    if toxic in (0, n):
        share = (toxic + 1) / (n + 2)
        empty = np.empty(0)
        return Model(empty.astype(np.uint64), empty, float(np.log(share / (1 - share))))
    words = _vocabulary(train, p, n, toxic)
    held = broadcast_value(train.sparkSession, words)

    def features(batches):
        for batch in batches:
            texts = batch.column("text")
            for row, end, doc, word in _found(texts, held.value):
                sizes = np.bincount(doc, minlength=end - row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("llm_y").slice(row, end - row),
                     textvec.list_array(pa.array(word.astype(np.int32)), sizes)], ["y", "words"])

    rows = train.mapInArrow(features, "y int, words array<int>").toArrow()
    y = (rows.column("y").to_numpy() == 1).astype(float)
    lists = rows.column("words").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    word = lists.flatten().to_numpy()
    weights, intercept = _fit(y, np.repeat(np.arange(len(y)), sizes), word, len(words),
                              _swaps(word, words, p), p)
    return Model(words, weights, intercept)


def _swaps(word: np.ndarray, words: np.ndarray, p: Parameters) -> tuple[np.ndarray, ...]:
    """For each pair of terms of a group, how many training documents swap the first."""
    present = np.bincount(word, minlength=len(words))
    a, b, times = [], [], []
    for group in p.groups:
        index = np.searchsorted(words, _hash_of(list(group)))
        for i in index:
            for j in index:
                if i != j and present[i]:
                    a.append(i)
                    b.append(j)
                    times.append(present[i] / (len(index) - 1))
    return np.array(a, int), np.array(b, int), np.array(times, float)


def _fit(y: np.ndarray, doc: np.ndarray, word: np.ndarray, n_words: int,
         swaps: tuple[np.ndarray, ...], p: Parameters) -> tuple[np.ndarray, float]:
    """Log loss with ridge and counterfactual penalty, on words that an L1 term selects.

    The L1 fit drops words of mere copy groups, since real signals explain the same labels;
    the second fit, on the words that are left, undoes its shrinking.
    """
    rough, _ = _descend(y, doc, word, n_words, swaps, p, p.sparse)
    left = rough != 0
    keep = left[word]
    return _descend(y, doc[keep], word[keep], n_words, swaps, p, 0.0)


def _descend(y: np.ndarray, doc: np.ndarray, word: np.ndarray, n_words: int,
             swaps: tuple[np.ndarray, ...], p: Parameters,
             sparse: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient descent with a step size for each weight."""
    n, (a, b, times) = len(y), swaps
    w = v = np.zeros(n_words + 1)
    per_word = np.bincount(word, minlength=n_words)
    swapped = np.bincount(np.concatenate([a, b]), np.concatenate([times, times]), n_words)
    # A step for each weight from the curvature of its own terms, halved for overlap.
    widest = max(1.0, np.bincount(doc, minlength=n).mean() / 4)
    step = np.append(1 / (widest * per_word / (4 * n) + p.ridge + 1e-5
                          + 4 * p.counterfactual * swapped / n), 1 / widest)
    for t in range(p.steps):
        z = v[-1] + np.bincount(doc, v[:-1][word], n)
        r = 1 / (1 + np.exp(-z)) - y
        g = np.bincount(word, r[doc], n_words) / n + p.ridge * v[:-1]
        change = 2 * p.counterfactual * times * (v[a] - v[b]) / n
        g += np.bincount(a, change, n_words) - np.bincount(b, change, n_words)
        new = v - step * np.append(g, r.mean())
        new[:-1] = np.sign(new[:-1]) * np.maximum(0, np.abs(new[:-1]) - sparse * step[:-1])
        v = new + t / (t + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def score(text: Column, model: Model, df: DataFrame) -> Column:
    """The probability of class 1 of a text column of ``df``."""
    held = broadcast_value(df.sparkSession, model)

    @F.arrow_udf("double")
    def toxicity_score(texts: pa.Array) -> pa.Array:
        return pa.array(held.value.score(texts))

    return toxicity_score(text)
