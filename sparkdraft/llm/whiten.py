"""PCA whitening of vectors: leading eigenpairs of their covariance by block Jacobi-Davidson.

Entries are scaled to integers, so that sums, counts and deviations are exact; the covariance is
that of the distinct vectors. It is never formed: a product with a few columns is one pass over
stored blocks of vectors, each centred before it is multiplied, and only sums of (dimensions x
columns) leave a task. The search space grows by solutions of the projected correction
equations of all open pairs, which MINRES solves in step, one pass a step for all of them.
Rayleigh-Ritz gives the pairs; a pair whose residual reaches double precision is locked. At the
end the residuals of all locked pairs are formed anew, and a random block outside of them
shows whether one of a larger eigenvalue was missed.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped,
and so are those with an entry of 2 ** 56 or more, which the integers cannot hold, and vectors of
another length than the most frequent one (the longer one where two are equally frequent).
Repeated vectors count once in the covariance and are returned each. Components whose
eigenvalue is zero by double precision cannot be scaled to unit variance and are left out:
where all vectors are equal none is left, and the result is empty, as for an empty table. Equal
eigenvalues have no order of their own: any orthonormal basis of their space is right, and
all rows get the same one. A deviation that a long cannot hold is null. Other columns are
ignored, whatever their names; a null id is returned as it is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm.common import stored

SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 56)
#: Bytes of a block of vectors.
BLOCK_BYTES = 4 << 20
#: Partial sums that the driver adds itself; more are first added up in tasks.
DRIVER_PARTS = 512
SEED = 11
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Parameters:
    components: int = 16
    #: Ritz pairs that are refined beside the wanted ones.
    guard: int = 4
    #: Blocks of Ritz vectors that the search space holds before it starts again from one.
    blocks: int = 4
    #: MINRES steps, and the reduction of the residual at which they end sooner.
    inner_steps: int = 4
    inner_reduction: float = 1e-3
    outer_steps: int = 300


def usable(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                               & (F.abs(c.cast("double")) < LARGEST)), F.lit(False))


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the scaled entries of every usable row, without the offset."""
    rows = embeddings.select("vec_id", "embedding").where(usable(F.col("embedding")))
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().where("d > 0")
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (common.d if common else 0)).select(
        "vec_id", F.transform("embedding", lambda c: F.floor(
            SCALE * c.cast("double")).cast("long")).alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def packed(rows: DataFrame) -> DataFrame:
    """(rows, cells): the vectors of a column ``x`` as binary blocks of 64-bit integers."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                step = max(1, BLOCK_BYTES // (8 * x.shape[1]))
                cut = [x[i:i + step] for i in range(0, len(x), step)]
                yield pa.RecordBatch.from_pydict({
                    "rows": pa.array([len(c) for c in cut], pa.int32()),
                    "cells": pa.array([c.astype("<i8").tobytes() for c in cut], pa.binary())})

    return rows.select("x").mapInArrow(pack, "rows int, cells binary")


def _integers(x: np.ndarray, largest: int) -> np.ndarray:
    """``x`` as 64-bit integers where these hold ``largest``, else as Python's."""
    return x.astype(np.int64 if largest < 1 << 62 else object)


def _largest(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


@dataclass(frozen=True)
class Centre:
    """Number of vectors and exact sums of their entries, without the offset."""

    n: int
    sums: tuple[int, ...]

    def times_n(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        bound = self.n * _largest(x) + max(map(abs, self.sums), default=0)
        return self.n * _integers(x, bound) - _integers(np.array(self.sums, dtype=object), bound)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in double precision: whole parts are taken off as integers."""
        whole = np.array([v // self.n for v in self.sums], dtype=np.int64)
        rest = np.array([v % self.n / self.n for v in self.sums])
        return (x - whole).astype(float) - rest

    def deviations(self, x: np.ndarray) -> list:
        """Sum over the entries of (n x - S)^2, exactly; None beyond 64 bits."""
        m = self.times_n(x)
        m = _integers(m, m.shape[1] * _largest(m) ** 2) if m.size else m
        return [int(v) if v < 1 << 63 else None for v in (m * m).sum(axis=1)]


class Blocks:
    """The stored distinct vectors, and sums over them in one pass each."""

    def __init__(self, table: DataFrame, dims: int):
        self.table, self.dims = table, dims
        self.many = len(table.inputFiles()) > DRIVER_PARTS

    def over(self, of_block: Callable[[np.ndarray], object], add: Callable, dump: Callable,
             load: Callable):
        """``of_block`` of every block, added up in the tasks and at the end here."""
        dims = self.dims

        def total(values: Iterator) -> Iterator[pa.RecordBatch]:
            whole = None
            for value in values:
                whole = value if whole is None else add(whole, value)
            if whole is not None:
                yield pa.RecordBatch.from_pydict({"part": pa.array([dump(whole)], pa.binary())})

        def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from total(of_block(np.frombuffer(cells.as_py(), "<i8").reshape(-1, dims))
                             for batch in batches for cells in batch.column(0))

        def of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from total(load(part.as_py()) for batch in batches for part in batch.column(0))

        parts = self.table.select("cells").mapInArrow(of_blocks, "part binary")
        if self.many:
            parts = parts.repartition(DRIVER_PARTS).mapInArrow(of_parts, "part binary")
        whole = None
        for row in parts.collect():
            value = load(bytes(row.part))
            whole = value if whole is None else add(whole, value)
        return whole

    def centre(self) -> Centre:
        def sums(x: np.ndarray) -> list[int]:
            whole = _integers(x, len(x) * _largest(x)).sum(axis=0)
            return [len(x), *map(int, whole)]

        n, *entries = self.over(sums, lambda a, b: [p + q for p, q in zip(a, b)],
                                lambda v: json.dumps(v).encode(), json.loads) or [0]
        return Centre(n, tuple(entries))

    def floats(self, of_block: Callable[[np.ndarray], np.ndarray], shape: tuple) -> np.ndarray:
        return self.over(of_block, np.add, lambda v: np.ascontiguousarray(v, "<f8").tobytes(),
                         lambda b: np.frombuffer(b, "<f8").reshape(shape))


def _product(blocks: Blocks, centre: Centre, columns: np.ndarray) -> np.ndarray:
    """The covariance times some columns, by one pass over the vectors."""
    def of_block(x: np.ndarray) -> np.ndarray:
        y = centre.centred(x)
        return y.T @ (y @ columns)

    return blocks.floats(of_block, columns.shape) / centre.n


def _minres(product: Callable, solve_for: np.ndarray, steps: int, reduction: float) -> np.ndarray:
    """Approximate solutions of ``product(t) = solve_for``, column by column but in step."""
    def along(a: np.ndarray, b: np.ndarray, per: np.ndarray) -> np.ndarray:
        length = (per * per).sum(axis=0)
        return np.divide((a * b).sum(axis=0), length, out=np.zeros_like(length), where=length > 0)

    t, rest = np.zeros_like(solve_for), solve_for.copy()
    goal = reduction * np.linalg.norm(rest, axis=0)
    way = [rest.copy()]
    image = [product(way[0])]
    for _ in range(steps):
        share = along(rest, image[0], image[0])
        t, rest = t + share * way[0], rest - share * image[0]
        if (np.linalg.norm(rest, axis=0) <= goal).all():
            break
        new, new_image = image[0], product(image[0])
        for k in range(len(image)):
            share = along(new_image, image[k], image[k])
            new, new_image = new - share * way[k], new_image - share * image[k]
        way, image = [new, *way[:1]], [new_image, *image[:1]]
    return t


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal columns of what ``new`` adds to the bases; perhaps none."""
    norms = np.linalg.norm(new, axis=0)
    new = new[:, norms > 0] / norms[norms > 0]
    for _ in range(3):
        for basis in bases:
            new = new - basis @ (basis.T @ new)
        if not new.shape[1]:
            break
        left, strength, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, strength > 1e-10]
    return new


def _ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values of a basis, falling, with their vectors and the vectors' images."""
    h = basis.T @ image
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], basis @ turn, image @ turn


def leading(product: Callable, dims: int, p: Parameters) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors of a positive operator.

    ``product`` takes columns to their images. Memory is dims x (locked + blocks x pairs).
    Raises if the residuals do not reach double precision in ``outer_steps``.
    """
    random = np.random.default_rng(SEED)
    wanted, none = min(p.components, dims), np.zeros((dims, 0))
    width = min(dims, wanted + p.guard)
    locked, locked_values = none, np.zeros(0)
    basis = _orthonormal(random.standard_normal((dims, width)))
    image = product(basis)
    largest = 0.0
    for _ in range(p.outer_steps):
        values, basis, image = _ritz(basis, image)
        largest = max(largest, values.max(initial=0), locked_values.max(initial=0))
        within = 4 * dims ** 0.5 * EPS * largest
        residual = image - basis * values
        good = np.linalg.norm(residual[:, :width], axis=0) <= within
        n = min(int(np.argmin(np.append(good, False))), wanted - locked.shape[1])
        locked = np.hstack([locked, basis[:, :n]])
        locked_values = np.append(locked_values, values[:n])
        basis, image, values, residual = basis[:, n:], image[:, n:], values[n:], residual[:, n:]
        if locked.shape[1] == wanted:
            values, locked, locked_image = _ritz(locked, product(locked))
            off = np.linalg.norm(locked_image - locked * values, axis=0)
            beside = _orthonormal(random.standard_normal((dims, p.guard)), locked, basis)
            probe = np.hstack([basis, beside])
            more = np.hstack([image, product(beside)]) if beside.shape[1] else image
            missed = probe.shape[1] and _ritz(probe, more)[0][0] > values[-1] + within
            if (off <= within).all() and not missed:
                return values, locked
            basis, image = np.hstack([locked, probe]), np.hstack([locked_image, more])
            locked, locked_values = none, np.zeros(0)
            continue
        open_pairs = min(width - locked.shape[1], basis.shape[1])
        if basis.shape[1] + open_pairs > max(p.blocks * width, 2 * open_pairs):
            basis, image = basis[:, :2 * open_pairs], image[:, :2 * open_pairs]
        theta, space = values[:open_pairs], np.hstack([locked, basis[:, :open_pairs]])

        def corrected(t: np.ndarray) -> np.ndarray:
            t = t - space @ (space.T @ t)
            t = product(t) - t * theta
            return t - space @ (space.T @ t)

        aim = residual[:, :open_pairs]
        step = _minres(corrected, space @ (space.T @ aim) - aim, p.inner_steps, p.inner_reduction)
        new = _orthonormal(step, locked, basis)
        if not new.shape[1]:  # nothing to add: the space is whole, or a random direction helps
            new = _orthonormal(random.standard_normal((dims, open_pairs)), locked, basis)
        if new.shape[1]:
            basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
        else:
            image = product(basis)
    raise RuntimeError(f"{wanted - locked.shape[1]} of {wanted} eigenpairs not found")


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors / np.sqrt(self.values)


def _spread(blocks: Blocks, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Covariance of what ``of_block`` makes of the vectors, centred before multiplying."""
    def one(x: np.ndarray) -> tuple:
        z = of_block(x)
        middle = z.mean(axis=0)
        return len(z), middle, (z - middle).T @ (z - middle)

    def add(a: tuple, b: tuple) -> tuple:
        n, apart = a[0] + b[0], b[1] - a[1]
        return (n, a[1] + apart * (b[0] / n),
                a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n))

    n, _, squares = blocks.over(
        one, add, lambda v: json.dumps([v[0], v[1].tolist(), v[2].tolist()]).encode(),
        lambda b: (lambda v: (v[0], np.array(v[1]), np.array(v[2])))(json.loads(b)))
    return squares / n


def fit(distinct: DataFrame, p: Parameters = Parameters()) -> Whitening | None:
    """The whitening of a table of distinct vectors ``x``; None if nothing can be scaled."""
    dims = (distinct.select(F.max(F.size("x"))).first()[0]) or 0
    if not dims:
        return None
    blocks = Blocks(stored(packed(distinct), "whitening-blocks"), dims)
    centre = blocks.centre()
    trace = float(blocks.floats(lambda x: (centre.centred(x) ** 2).sum(axis=0), (dims,)).sum())
    if not trace:
        return None
    values, found = leading(lambda columns: _product(blocks, centre, columns), dims, p)
    live = values > dims * EPS * values[0]
    values, found = values[live], found[:, live]
    model = Whitening(centre, values, found, trace / centre.n, 0.0)
    error = _spread(blocks, model.apply) - np.eye(len(values))
    return Whitening(centre, values, found, model.trace, float(np.abs(error).max()))


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


def whitened(embeddings: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """A row for each usable row of ``embeddings`` and component."""
    rows = vectors(embeddings)
    model = fit(stored(rows.select("x").distinct(), "whitening-distinct"), p)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _matrix(batch.column(1)), batch.num_rows
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.cast(pa.int64()),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * k, model.centre.n)),
                "deviation": pa.array([v for v in model.centre.deviations(x) for _ in range(k)],
                                      pa.int64()),
                "whitened": pa.array(model.apply(x).ravel()),
                "explained": pa.array(np.tile(model.values / model.trace, m)),
                "identity_error": pa.array(np.full(m * k, model.identity_error))})

    return rows.mapInArrow(apply, SCHEMA)
