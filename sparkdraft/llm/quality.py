"""Quality scores: kernel ridge regression on document statistics, calibrated.

Method. Each text gives a vector of statistics (``STATISTICS``), taken from the whole text in
one pass. Random Fourier features approximate a Gaussian kernel over the standardised
statistics. Each partition of labelled rows sums its part of the normal equations; Spark
adds them up, and the small system is solved once. Isotonic regression (pool adjacent
violators) over counted score bins turns ridge scores into probabilities.

Defined cases. A null text has the statistics of an empty one. Labels of one id count once,
the larger one. With no labelled rows, or one class, every score is the smoothed share of
class 1. Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm import textvec
from sparkdraft.llm.common import broadcast_value

STATISTICS = ("log_bytes", "log_words", "word_length", "letters", "capitals", "digits", "blanks",
              "wide", "stops", "commas", "shouts", "bars", "symbols", "brackets", "distinct_words",
              "line_length", "distinct_lines", "one_byte_words", "long_words", "word_spread")
CLASSES = {"letters": range(97, 123), "capitals": range(65, 91), "digits": range(48, 58),
           "blanks": (32, 9, 10, 11, 12, 13), "wide": range(128, 256), "stops": b".?;:",
           "commas": b",", "shouts": b"!", "bars": b"|", "symbols": b"#$%&*+=<>@^_~\\/",
           "brackets": b"()[]{}\"'`"}
BINS = 4000


@dataclass(frozen=True)
class Parameters:
    """``features`` is the number of random features, ``width`` the kernel's, per root dimension."""

    features: int = 256
    width: float = 1.0
    ridge: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.directions + self.phases
        return np.hstack([np.cos(z) * np.sqrt(2 / len(self.phases)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return np.full(len(x), self.levels[0])
        return np.interp(self.raw(x), self.steps, self.levels)


def _share_distinct(doc: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    n = np.bincount(doc, minlength=rows)
    return np.bincount(d[new], minlength=rows) / np.maximum(1, n)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text."""
    out = np.zeros((len(texts), len(STATISTICS)), np.float32)
    at = {name: i for i, name in enumerate(STATISTICS)}
    kind = np.full(256, len(CLASSES), np.uint8)
    for i, chars in enumerate(CLASSES.values()):
        kind[list(chars)] = i
    for row, end, buf, offs in textvec.chunks(texts):
        n, size = end - row, np.diff(offs)
        doc = np.repeat(np.arange(n), size)
        one = np.maximum(1, size)
        table = np.bincount(doc * (len(CLASSES) + 1) + kind[buf], minlength=n * (len(CLASSES) + 1))
        table = table.reshape(n, -1)
        for i, name in enumerate(CLASSES):
            out[row:end, at[name]] = table[:, i] / one
        starts, ends = textvec.word_spans(textvec.IS_BLANK[buf], offs)
        length = (ends - starts).astype(float)
        owner = doc[starts] if len(starts) else np.empty(0, np.int64)
        words = np.bincount(owner, minlength=n)
        some = np.maximum(1, words)
        mean = np.bincount(owner, length, n) / some
        out[row:end, at["log_bytes"]] = np.log1p(size)
        out[row:end, at["log_words"]] = np.log1p(words)
        out[row:end, at["word_length"]] = mean
        out[row:end, at["word_spread"]] = np.sqrt(np.maximum(
            0, np.bincount(owner, length ** 2, n) / some - mean ** 2))
        out[row:end, at["one_byte_words"]] = np.bincount(owner, length == 1, n) / some
        out[row:end, at["long_words"]] = np.bincount(owner, length > 15, n) / some
        hashes, _ = textvec.word_hashes(buf, offs)
        out[row:end, at["distinct_words"]] = _share_distinct(owner, hashes, n)
        a, b = textvec.word_spans(buf == 10, offs)
        line = doc[a] if len(a) else np.empty(0, np.int64)
        lines = np.bincount(line, minlength=n)
        out[row:end, at["line_length"]] = np.log1p(np.bincount(line, b - a, n) / np.maximum(1, lines))
        out[row:end, at["distinct_lines"]] = _share_distinct(
            line, textvec.span_hashes(buf, a, b), n)
    return out


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): the statistics of each row's text as 32-bit floats."""
    @F.arrow_udf("array<float>")
    def text_statistics(texts: pa.Array) -> pa.Array:
        x = statistics(texts)
        return textvec.list_array(pa.array(x.ravel()), np.full(len(x), x.shape[1]))

    return docs.select("doc_id", text_statistics("text").alias("stats"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(
        len(column), len(STATISTICS))


def fit(stats: DataFrame, labels: DataFrame, p: Parameters = Parameters()) -> Model:
    """Fit on the rows of ``stats`` whose id is labelled in ``labels`` (doc_id, quality)."""
    y = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").cast("double").alias("y"))
    train = stats.join(y, "doc_id").select("stats", "y")
    moments = train.select("y", F.posexplode("stats").alias("i", "v")).groupBy("i").agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd"),
        F.avg("y").alias("share")).orderBy("i").collect()
    d = len(STATISTICS)
    n, share = (moments[0].n, moments[0].share) if moments else (0, 0.0)
    rng = np.random.default_rng(p.seed)
    directions = rng.normal(0, 1 / (p.width * np.sqrt(d)), (d, p.features))
    phases = rng.uniform(0, 2 * np.pi, p.features)
    mean = np.array([m.mean for m in moments] or [0.0] * d)
    scale = np.array([max(m.sd, 1e-6) for m in moments] or [1.0] * d)
    if share in (0.0, 1.0):
        level = (n * share + 1) / (n + 2)
        return Model(mean, scale, directions, phases, np.zeros(p.features + 1), np.empty(0),
                     np.array([level]))
    base = Model(mean, scale, directions, phases, np.zeros(p.features + 1), np.empty(0),
                 np.array([share]))
    held = broadcast_value(stats.sparkSession, base)

    def sums(batches):
        m = len(held.value.weights)
        total = np.zeros((m, m + 1))
        for batch in batches:
            z = held.value.features(_matrix(batch.column("stats")))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total += z.T @ np.hstack([z, y[:, None]])
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(m, dtype=np.int32)),
                 textvec.list_array(pa.array(total.ravel()), np.full(m, m + 1))], ["i", "row"])

    parts = train.mapInArrow(sums, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(
        F.sum("v").alias("v")).toArrow()
    m = p.features + 1
    a = np.zeros((m, m + 1))
    a[cells.column("i").to_numpy(), cells.column("j").to_numpy()] = cells.column("v").to_numpy()
    ridge = p.ridge * n * np.diag(np.append(np.full(p.features, 1.0), 0.0))
    weights = np.linalg.solve(a[:, :m] + ridge, a[:, m])
    fitted = Model(mean, scale, directions, phases, weights, np.empty(0), np.array([share]))
    return _calibrated(fitted, train)


def _calibrated(model: Model, train: DataFrame) -> Model:
    held = broadcast_value(train.sparkSession, model)

    @F.arrow_udf("double")
    def ridge_score(stats: pa.Array) -> pa.Array:
        return pa.array(held.value.raw(_matrix(stats)))

    step = 3.0 / BINS
    bins = train.select("y", F.floor(F.least(F.greatest(ridge_score("stats"), F.lit(-1.0)),
                                             F.lit(2.0)) / step).alias("bin"))
    rows = bins.groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy(
        "bin").collect()  # at most BINS rows
    x = np.array([(r.bin + 0.5) * step for r in rows])
    levels = isotonic(np.array([r.y / r.n for r in rows]), np.array([r.n for r in rows], float))
    return Model(model.mean, model.scale, model.directions, model.phases, model.weights, x,
                 np.clip(levels, 0, 1))


def isotonic(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to ``y`` with weights ``n``, by pooling violators."""
    pools: list[list[float]] = []
    for value, weight in zip(y, n):
        pools.append([value * weight, weight, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.concatenate([np.full(int(k), s / w) for s, w, k in pools] or [np.empty(0)])


def score(stats: Column, model: Model, df: DataFrame) -> Column:
    """The probability of class 1 for a column of statistics."""
    held = broadcast_value(df.sparkSession, model)

    @F.arrow_udf("double")
    def quality_score(column: pa.Array) -> pa.Array:
        return pa.array(held.value.score(_matrix(column)))

    return quality_score(stats)
