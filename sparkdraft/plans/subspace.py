"""Leading eigenpairs of a large sparse symmetric matrix by block subspace iteration.

Matrix and basis are cut into blocks of rows. A step takes the Ritz pairs of the basis, makes
their residuals orthonormal to it and to each other by their Gram matrix, twice (a Cholesky-type
QR, the second time against rounding), and adds them with their images - a join of blocks whose
products are summed per block of rows. A basis that has grown to its bound starts again from
its best Ritz vectors. What reaches the driver are sums of the size of the basis's width
squared, never a matrix with a side of the number of items. Every step reads tables that the
one before wrote.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# The helpers travel with the functions that use them: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block, columns kept beside the wanted ones, and products held by a task at a time.
BLOCK, GUARD, HELD = 1024, 10, 64
#: The basis grows to so many times the width that it starts with; two of these it keeps.
WIDTHS = 4
#: The iteration ends at this residual, relative to the largest eigenvalue, or after so many steps.
TOLERANCE, STEPS = 1e-9, 200


@dataclass(frozen=True)
class Leading:
    u: DataFrame  # idx, u array<double>
    sigma: list[float]
    residual: float


def matrix_blocks(entries: DataFrame) -> DataFrame:
    """(bi, bj, e): entries grouped into blocks of at most BLOCK x BLOCK."""
    return entries.select(
        F.floor(F.col("i") / BLOCK).alias("bi"), F.floor(F.col("j") / BLOCK).alias("bj"),
        F.struct((F.col("i") % BLOCK * BLOCK + F.col("j") % BLOCK).cast("int").alias("at"),
                 F.col("value").cast("double").alias("v")).alias("e"),
    ).groupBy("bi", "bj").agg(F.collect_list("e").alias("e"))


def _array(cells: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(cells.as_py(), "<f8").reshape(-1, width)


def _arrays(cells: Iterable[pa.Scalar], widths: list[int]) -> list[np.ndarray]:
    """The columns of one block; those without any get the rows of the others."""
    found = [_array(c, w) if w else None for c, w in zip(cells, widths)]
    rows = next(len(f) for f in found if f is not None)
    return [np.zeros((rows, 0)) if f is None else f for f in found]


def _rows(block: list[int], names: list[str], *columns: list[np.ndarray]) -> pa.RecordBatch:
    data = {"block": pa.array(block, pa.int64())}
    data |= {n: pa.array([np.ascontiguousarray(v, "<f8").tobytes() for v in c], pa.binary())
             for n, c in zip(names, columns)}
    return pa.RecordBatch.from_pydict(data)


class Work:
    """Tables of the iteration: blocks of columns ``q`` and their images ``y``."""

    def __init__(self, scratch: str):
        self.scratch, self.writes = scratch, 0

    def written(self, df: DataFrame) -> DataFrame:
        self.writes += 1
        path = f"{self.scratch}/{self.writes}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def random(self, spark, n_items: int, width: int, seed: int) -> DataFrame:
        """Normal numbers that depend on seed and block only."""
        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.column(0).to_pylist():
                    rows = min(BLOCK, n_items - block * BLOCK)
                    draw = np.random.default_rng([seed, block]).standard_normal((rows, width))
                    yield _rows([block], ["q", "y", "z"], [draw[:, :0]], [draw[:, :0]], [draw])

        return self.written(spark.range(-(-n_items // BLOCK)).mapInArrow(
            fill, "block long, q binary, y binary, z binary"))

    def mapped(self, table: DataFrame, inputs: dict[str, int], outputs: list[str],
               of_block: Callable[..., tuple]) -> DataFrame:
        """A new table of the columns that ``of_block`` makes of a block's columns (name: width)."""
        widths = list(inputs.values())

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, *cells in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                    made = of_block(*_arrays(cells, widths))
                    yield _rows([block], outputs, *[[m] for m in made])

        schema = ", ".join(["block long", *[f"{n} binary" for n in outputs]])
        return self.written(table.select("block", *inputs).mapInArrow(apply, schema))

    def image(self, matrix: DataFrame, basis: DataFrame, width: int) -> DataFrame:
        """(block, image): the matrix times the columns ``z``."""
        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for bi, e, z in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                    at, v = (e.values.field(n).to_numpy() for n in ("at", "v"))
                    z = _array(z, width)
                    dense = np.bincount(at, v, BLOCK * BLOCK).reshape(BLOCK, BLOCK)[:, :len(z)]
                    held[bi] = held.get(bi, 0.0) + dense @ z
                    if len(held) >= HELD:
                        yield _rows(list(held), ["image"], list(held.values()))
                        held = {}
            if held:
                yield _rows(list(held), ["image"], list(held.values()))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, whole = None, 0.0
            for batch in batches:
                for b, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if block is not None and b != block:
                        yield _rows([block], ["image"], [whole])
                        whole = 0.0
                    block, whole = b, whole + _array(part, width)
            if block is not None:
                yield _rows([block], ["image"], [whole])

        schema = "block long, image binary"
        parts = matrix.join(basis.select(F.col("block").alias("bj"), "z"), "bj").select(
            "bi", "e", "z").mapInArrow(products, schema)
        return parts.repartition("block").sortWithinPartitions("block").mapInArrow(sums, schema)

    def grown(self, matrix: DataFrame, basis: DataFrame, old: int, new: int) -> DataFrame:
        """The basis (q, y, z) with z as part of q, and its image as part of y."""
        # A block of rows without entries has no image; that of the last block is too long.
        size = F.octet_length("z").cast("int")
        zeros = F.unhex(F.repeat(F.lit("00"), size))
        joined = basis.join(self.image(matrix, basis, new), "block", "left").withColumn(
            "image", F.coalesce(F.substring("image", F.lit(1), size), zeros))
        return self.mapped(joined, {"q": old, "y": old, "z": new, "image": new}, ["q", "y"],
                           lambda q, y, z, image: (np.hstack([q, z]), np.hstack([y, image])))


def summed(table: DataFrame, inputs: dict[str, int], of_block: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum over the blocks of a small matrix."""
    widths = list(inputs.values())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            for cells in zip(*batch.columns):
                part = of_block(*_arrays(cells, widths))
                whole = part if whole is None else whole + part
        if whole is not None:
            yield pa.RecordBatch.from_pydict({
                "shape": pa.array([list(whole.shape)], pa.list_(pa.int32())),
                "part": pa.array([whole.astype("<f8").tobytes()], pa.binary())})

    parts = table.select(*inputs).mapInArrow(add, "shape array<int>, part binary").collect()
    return sum(np.frombuffer(bytes(r.part), "<f8").reshape(r.shape) for r in parts)


def _orthonormal(work: Work, basis: DataFrame, old: int, new: int) -> tuple[DataFrame, int, np.ndarray]:
    """z made orthonormal to q and in itself: (basis, columns left, squared norms before)."""
    norms = None
    for again in (False, True):
        cross = summed(basis, {"q": old, "z": new}, lambda q, z: np.hstack([q, z]).T @ z)
        gram = cross[old:] - cross[:old].T @ cross[:old]
        norms = np.diag(cross[old:]) if norms is None else norms
        strength, turn = np.linalg.eigh((gram + gram.T) / 2)
        # The first time what rounding leaves of a direction goes; then all are near unit length.
        live = strength > (0.25 if again else 1e-13 * max(norms.max(), np.finfo(float).tiny))
        turn = turn[:, live] / np.sqrt(strength[live])
        lead = cross[:old]
        basis = work.mapped(basis, {"q": old, "y": old, "z": new}, ["q", "y", "z"],
                            lambda q, y, z: (q, y, (z - q @ lead) @ turn))
        new = turn.shape[1]
        if not new:
            break
    return basis, new, norms


def leading(entries: DataFrame, n_items: int, k: int, seed: int, scratch: str) -> Leading:
    """The k eigenvalues of largest magnitude, as sigma, with their orthonormal eigenvectors.

    Values that are numerically zero come as 0, with unit vectors that the matrix takes to zero.
    """
    spark, width = entries.sparkSession, min(n_items, k + GUARD)
    work = Work(scratch)
    matrix = work.written(matrix_blocks(entries))
    basis, old, (new, residual) = work.random(spark, n_items, width, seed), 0, (width, np.inf)
    for _ in range(STEPS):
        basis, new, norms = _orthonormal(work, basis, old, new)
        if old:
            residual = float(np.sqrt(norms[:k].max()) / max(abs(values[0]), np.finfo(float).tiny))
            if residual <= TOLERANCE or not new:
                break
        pairs = work.grown(matrix, basis, old, new)
        size = old + new
        inner = summed(pairs, {"q": size, "y": size}, lambda q, y: q.T @ y)
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-np.abs(values))
        old = size if size + width <= WIDTHS * width else 2 * width
        values, turn, new = values[order[:old]], turn[:, order[:old]], min(width, old)
        basis = work.mapped(pairs, {"q": size, "y": size}, ["q", "y", "z"], lambda q, y: (
            q @ turn, y @ turn, y @ turn[:, :new] - q @ turn[:, :new] * values[:new]))
    live = np.abs(values[:k]) > n_items * np.finfo(float).eps * abs(values[0])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, q in zip(batch.column(0).to_pylist(), batch.column(1)):
                u = _array(q, old)[:, :k]
                at = np.arange(len(u) + 1, dtype=np.int32) * k
                yield pa.RecordBatch.from_pydict({
                    "idx": pa.array(block * BLOCK + np.arange(len(u))),
                    "u": pa.ListArray.from_arrays(pa.array(at), pa.array(u.ravel()))})

    u = work.written(basis.select("block", "q").mapInArrow(rows, "idx long, u array<double>"))
    return Leading(u, [float(v) for v in np.abs(values[:k]) * live], residual)
