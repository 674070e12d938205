"""Whitened leading components of embeddings by a randomised range finder.

Vectors become integers, x = floor(256 c); the model is fitted to each distinct
vector once. Counts and sums per dimension are exact. A random block of a few
more directions than are wanted is multiplied by the covariance again and again,
each time in one pass over all centred rows that adds up small matrices and
sends nothing else; rows are centred before they are multiplied. After each pass
Rayleigh-Ritz gives eigenpairs within the block, and the same product gives
their residuals for nothing. If these are not down to rounding after PASSES
passes, the block is widened to all dimensions, which makes the last pass
the covariance itself and its eigenpairs exact.

Tasks hold one batch and a matrix of dimensions by block; the driver holds the
same. Partial sums of the tasks are added up in blocks of matrix rows, in order
of the tasks. Neither depends on the number of rows.

Defined cases: rows whose vector is null or holds null or non-finite entries are
left out. Vectors shorter than the longest count as having zeros beyond their
end; vectors without entries alone have no components. Null ids, repeated rows
and ties keep their rows. Entries beyond 2^55 are held at the limits of a long.
A deviation beyond a long is null. A component without variance (rank below the
number of components, a single distinct vector) has null whitened values and does
not count for the error; without any variance the explained share is null. An
empty table gives no rows. Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, saved

#: Directions beyond those wanted, passes before all dimensions are taken, and the residual that ends them, as a share of the largest eigenvalue.
OVERSAMPLE, PASSES, RESIDUAL, SEED = 12, 6, 1e-13, 20_240
#: Bytes of a partial matrix that travel as one row; rows of vectors handled at once.
_BLOCK, _SLICE = 1 << 20, 1024


@dataclass(frozen=True)
class Fit:
    """What was learned: the number of distinct vectors, exact sums, components as columns, eigenvalues and the trace."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # true division of integers rounds once

    @property
    def scales(self) -> np.ndarray:
        """One over the deviation of each component; nan without variance."""
        return _scales(self.values)


def _scales(values: np.ndarray) -> np.ndarray:
    least = max(values, default=0.0) * len(values) * 1e-14
    return np.array([1 / np.sqrt(v) if v > least else np.nan for v in values])


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, width)


def integral(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, x) of the rows that take part, and the number of dimensions."""
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & ~odd)
    x = good.select("id", F.transform("v", lambda c: F.floor(c * 256)).alias("x"))
    least, width = x.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != width:
        x = x.select("id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))).alias("x"))
    return x, width or 0


def _summed(fit: DataFrame, width: int, partial: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of `partial(x)`, a matrix of `shape`, over all rows of `fit`."""
    height = max(1, _BLOCK // (8 * shape[1]))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for at in range(0, len(x), _SLICE):
                total += partial(x[at : at + _SLICE])
        task, cells = TaskContext.get().partitionId(), [total[a : a + height] for a in range(0, shape[0], height)]
        yield pa.RecordBatch.from_arrays([pa.array([task] * len(cells), pa.int32()), pa.array(range(len(cells)), pa.int32()), pa.array([c.tobytes() for c in cells], pa.binary())], names=["task", "block", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                got = np.frombuffer(cells.as_buffer(), np.float64)
                totals[block] = totals[block] + got if block in totals else got.copy()
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["block", "cells"])

    blocks = -(-shape[0] // height)
    parts = fit.transform(mapped, part, "task int, block int, cells binary").repartition(min(blocks, 64), "block").sortWithinPartitions("block", "task")
    got = {r.block: np.frombuffer(r.cells, np.float64).reshape(-1, shape[1]) for r in parts.transform(mapped, add, "block int, cells binary").collect()}  # a matrix, whatever the number of rows
    return np.concatenate([got[b] for b in range(blocks)])


def _counted(fit: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """How many rows, and their exact sums by dimension."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), width)
            low, high = (x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0)  # halves cannot overflow within a batch
            sums = [*((int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)), len(x)]
            yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array(map(str, sums))], names=["i", "s"])

    rows = fit.transform(mapped, part, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).collect()
    found = {r.i: int(r.s) for r in rows}
    return found.get(width, 0), tuple(found.get(i, 0) for i in range(width))


def _ritz(block: np.ndarray, product: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest eigenvalues within an orthonormal block, their vectors, and the largest residual."""
    inner = block.T @ product
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    vectors = block @ turn
    residual = np.linalg.norm(product @ turn - vectors * values, axis=0).max()
    size = np.linalg.norm(vectors, axis=0)
    return values, vectors / size, residual


def fit_components(fit: DataFrame, width: int, k: int = 4, passes: int = PASSES) -> Fit:
    """Components of distinct vectors `fit` (x)."""
    k = min(k, width)
    n, sums = _counted(fit, width)
    if not n:
        return Fit(0, sums, np.zeros((width, k)), np.zeros(k), 0.0, None)
    mean = np.array([s / n for s in sums])

    def product(block: np.ndarray) -> tuple[np.ndarray, float]:
        def partial(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return np.vstack([centred.T @ (centred @ block), np.full((1, block.shape[1]), np.einsum("ij,ij->", centred, centred))])

        total = _summed(fit, width, partial, (width + 1, block.shape[1])) / n
        return total[:-1], float(total[-1, 0])

    size = min(width, k + OVERSAMPLE)
    block = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, size)))[0]
    for step in range(passes + 1):
        if step == passes:
            block = np.eye(width)
        multiplied, trace = product(block)
        values, vectors, residual = _ritz(block, multiplied, k)
        if residual <= RESIDUAL * max(values[0], 0.0):
            break
        block = np.linalg.qr(multiplied)[0]
    values = np.maximum(values, 0.0)
    scales = _scales(values)
    sound = ~np.isnan(scales)

    def spread(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ vectors[:, sound] * scales[sound]
        return np.vstack([w.T @ w, w.sum(0, keepdims=True)])

    error, m = None, int(sound.sum())
    if m:
        total = _summed(fit, width, spread, (m + 1, m)) / n
        error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(m)).max())
    return Fit(n, sums, vectors, values, trace, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sums of (n x - S)^2; null beyond a long."""
    reach = n * float(np.abs(x.astype(np.float64)).max(initial=0)) + max(map(abs, sums))
    if len(sums) * reach * reach < 2**62:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = (sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [d if d < 2**63 else None for d in exact]


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", passes: int = PASSES) -> DataFrame:
    """For each row and component its whitened value, with the share of variance that the component explains."""
    x, width = integral(rows, id_col, vector_col)
    if not width:
        return rows.sparkSession.createDataFrame([], _OUT)
    got = fit_components(saved(x.select("x").distinct(), "vectors"), width, k, passes)
    mean, k = got.mean, len(got.values)
    turned, scales = got.components, got.scales
    explained = [float(v) / got.trace if got.trace > 0 else None for v in got.values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), width)
            for at in range(0, len(batch), _SLICE):
                some = vectors[at : at + _SLICE]
                size = len(some)
                white = ((some - mean) @ turned * scales).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[at : at + size].take(pa.array(np.repeat(np.arange(size), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, got.n)),
                        pa.array([d for d in _deviations(some, got.n, got.sums) for _ in range(k)], pa.int64()),
                        pa.array(white, mask=np.isnan(white)),
                        pa.array(explained * size, pa.float64()),
                        pa.array([got.identity_error] * (size * k), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return x.transform(mapped, project, _OUT)
