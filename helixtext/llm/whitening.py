"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Components x of a vector are whole numbers floor(256 * c). Each distinct vector
counts once. Sums are exact; deviations n * x - S are exact whole numbers, and
are divided by n before anything is multiplied. Tasks add up moments of what
they read, each about its own mean; partial moments meet in a tree, so the driver
only sees some matrices of d x d numbers, whatever the rows.

The scatter is factored with the largest remaining diagonal first. Rotations
of the factor's columns make them orthogonal: their norms squared are the
eigenvalues, the normalised columns the eigenvectors.

Defined cases: rows whose vector is null or holds a null or non-finite entry have
no result; shorter vectors, empty ones too, count as if zeros followed; where fewer
components have any variance there are rows for those only; a null vec_id is passed on; repeated
rows each have their result; deviations beyond 64 bits count as the largest of
those; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE = 256
COMPONENTS = 4
LARGEST = (1 << 63) - 1
#: Tasks that add up partial moments, level by level; those of the last are read by the driver.
LEVELS = (64, 8)
MOMENTS = "n long, mean binary, scatter binary"


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def whole_numbers(vector: Column, width: int) -> Column:
    """floor(256 * c), with zeros up to the width."""
    x = F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long"))
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))


@dataclass
class Moments:
    """Rows, their mean, and the sum of outer products of their deviations from it."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return Moments(len(rows), mean, centred.T @ centred)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n), self.scatter + other.scatter + np.outer(step, step) * (self.n * other.n / n))

    def row(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([self.n]), pa.array([self.mean.tobytes()], pa.binary()), pa.array([self.scatter.tobytes()], pa.binary())], ["n", "mean", "scatter"])

    @staticmethod
    def read(n: int, mean: bytes, scatter: bytes) -> Moments:
        m = np.frombuffer(mean)
        return Moments(n, m, np.frombuffer(scatter).reshape(len(m), len(m)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, all of the same width."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit numbers where squares added over a row fit, Python's beyond."""
    top = n * max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0) + max(map(abs, sums), default=0)
    if top * top * max(1, len(sums)) > LARGEST:
        return n * x.astype(object) - np.array(sums, object)
    return n * x - np.array(sums, np.int64)


def moments(vectors: DataFrame, width: int, n: int, sums: list[int], weights: np.ndarray | None = None) -> Moments:
    """Moments of x - S/n, or of its projections on the columns of weights, over all rows of vectors (x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in common.small(batches, 4096):
            if batch.num_rows:
                rows = deviations(matrix(batch.column("x"), width), n, sums).astype(float) / n
                one = Moments.of(rows if weights is None else rows @ weights)
                found = found + one if found else one
        if found:
            yield found.row()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("n", "mean", "scatter")), strict=True):
                one = Moments.read(*row)
                found = found + one if found else one
        if found:
            yield found.row()

    parts = vectors.select("x").mapInArrow(run, MOMENTS)
    for tasks in LEVELS:
        parts = parts.repartition(tasks).mapInArrow(add, MOMENTS)
    total = None
    for r in parts.toLocalIterator():
        one = Moments.read(r["n"], bytes(r["mean"]), bytes(r["scatter"]))
        total = total + one if total else one
    return total


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): factor is lower trapezoidal, with a[order][:, order] = factor @ factor.T; what has no more than rounding left is cut."""
    a = np.array(a, float)
    d = len(a)
    order = np.arange(d)
    factor = np.zeros((d, d))
    rest = a.diagonal().copy()
    least = rest.max(initial=0.0) * d * np.finfo(float).eps
    for k in range(d):
        p = k + int(np.argmax(rest[order[k:]]))
        if rest[order[p]] <= least:
            return factor[:, :k], order
        order[[k, p]] = order[[p, k]]
        factor[[k, p], :k] = factor[[p, k], :k]
        factor[k, k] = np.sqrt(rest[order[k]])
        below = order[k + 1 :]
        factor[k + 1 :, k] = (a[below, order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        rest[below] -= factor[k + 1 :, k] ** 2
    return factor, order


def rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of pairs that share none."""
    ring = [*range(n), *([-1] if n % 2 else [])]
    for _ in range(len(ring) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[: len(ring) // 2], ring[::-1], strict=False) if a >= 0 and b >= 0]
        yield np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated until each pair is orthogonal to rounding."""
    g = np.array(factor, float)
    if g.shape[1] < 2:
        return g
    tiny = np.finfo(float).eps * max(1, len(g)) ** 0.5
    for _ in range(sweeps):
        quiet = True
        for i, j in rounds(g.shape[1]):
            a, b = g[:, i], g[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(ab) > tiny * np.sqrt(aa * bb)
            if not turn.any():
                continue
            quiet = False
            z = (bb - aa)[turn] / (2 * ab[turn])
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.sqrt(1 + z * z))
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            i, j = i[turn], j[turn]
            g[:, i], g[:, j] = c * g[:, i] - s * g[:, j], s * g[:, i] + c * g[:, j]
        if quiet:
            return g
    raise ArithmeticError(f"columns are not orthogonal after {sweeps} sweeps")


def components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a scatter matrix, falling, and unit eigenvectors as columns, their largest entry positive."""
    factor, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.empty((len(scatter), len(norms)))
    vectors[order] = (turned / norms)[:, falling]
    for k in range(vectors.shape[1]):
        if vectors[np.argmax(np.abs(vectors[:, k])), k] < 0:
            vectors[:, k] *= -1
    return norms[falling] ** 2, vectors


@dataclass(frozen=True)
class Whitening:
    """What whitening needs: a number of columns of d numbers."""

    width: int
    n: int
    sums: list[int]
    weights: np.ndarray
    explained: list[float]
    identity_error: float


def fit(vectors: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """Of the distinct vectors of embedding; None without any."""
    use = vectors.where(usable(F.col("embedding"))).select("embedding")
    width = use.agg(F.max(F.size("embedding"))).first()[0]
    if not width:
        return None
    scratch = common.Scratch(vectors.sparkSession)
    distinct = scratch.table(use.select(whole_numbers(F.col("embedding"), width).alias("x")).distinct())

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in common.small(batches, 4096):
            if batch.num_rows:
                x = matrix(batch.column("x"), width)
                x = x if max(abs(int(x.min())), abs(int(x.max()))) * len(x) <= LARGEST else x.astype(object)
                n, sums = n + len(x), [a + int(b) for a, b in zip(sums, x.sum(axis=0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array([str(s) for s in sums])], ["i", "n", "s"])

    found = distinct.mapInArrow(totals, "i int, n long, s string").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    n, sums = found[0]["n"], [int(r["s"]) for r in found]
    scatter = moments(distinct, width, n, sums).scatter
    values, axes = components(scatter)
    values, axes = values[:most] / n, axes[:, :most]
    weights = axes / np.sqrt(values)
    error = 0.0
    if len(values):
        error = float(np.abs(moments(distinct, width, n, sums, weights).scatter / n - np.eye(len(values))).max())
    scratch.drop(distinct)
    total = float(np.trace(scatter)) / n
    return Whitening(width, n, sums, weights, [min(1.0, float(v) / total) for v in values], error)


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of vectors (vec_id, embedding)."""
    model = fit(vectors, most)
    if model is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.weights.shape[1]
        for batch in common.small(batches, 4096):
            rows = batch.num_rows
            off = deviations(matrix(batch.column("x"), model.width), model.n, model.sums)
            far = np.array([min(int(v), LARGEST) for v in (off * off).sum(axis=1)], np.int64)
            # one row at a time as far as rounding goes: equal vectors have equal results wherever they are
            out = np.einsum("ij,jk->ik", off.astype(float) / model.n, model.weights)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, np.int64)),
                    pa.array(np.repeat(far, k)),
                    pa.array(out.reshape(-1)),
                    pa.array(np.tile(np.array(model.explained, float), rows)),
                    pa.array(np.full(rows * k, model.identity_error)),
                ],
                [c.split()[0] for c in WHITENED.split(", ")],
            )

    use = vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long"), whole_numbers(F.col("embedding"), model.width).alias("x"))
    return use.mapInArrow(run, WHITENED)
