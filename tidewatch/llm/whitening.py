"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

SCALE = 256
COMPONENTS = 4
# The driver holds a few matrices of width x width doubles and nothing that grows with the rows.
MAX_WIDTH = 4096
SWEEPS = 60
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """Fitted on distinct vectors: their number, sums per dimension, and components with falling variances."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x): entries as doubles times `scale`, rounded down to longs.

    Rows whose vector is null or has null or non-finite entries are left out,
    and so are vectors of another length than most rows have (of equally
    frequent lengths the largest counts). Entries beyond the longs become the
    nearest long.
    """
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    good = table.where(F.col(vector_col).isNotNull()).where(finite).select(F.col(id_col).alias("vec_id"), vector.alias("vector"))
    widths = good.groupBy(F.size("vector").alias("width")).count()
    most = widths.agg(F.max_by("width", F.struct("count", "width")).alias("width")).first().width
    good = good.where(F.size("vector") == F.lit(most))
    return good.select("vec_id", F.transform("vector", lambda c: F.floor(c * scale)).alias("x"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and their exact sums per dimension; each task adds up its own first."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, [0] * width
        for batch in batches:
            x = _matrix(batch.column(0), width)
            # Halves of 32 bits add up exactly in 64.
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(a) << 32) + int(b) for t, a, b in zip(total, high, low, strict=True)]
            rows += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([rows] * width, pa.int64()), pa.array([str(t) for t in total])],
            names=["at", "rows", "total"],
        )

    parts = fit.mapInArrow(added, "at int, rows bigint, total string")
    found = parts.groupBy("at").agg(F.sum("rows").alias("rows"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    rows = found.orderBy("at").collect()
    return rows[0].rows, [int(r.total) for r in rows]


def _scatter(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The sum of outer products of the centred vectors; each task adds up its own, rows of the matrix are then added."""
    width = len(mean)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                y = _matrix(batch.column(0).slice(at, 4096), width) - mean
                total += y.T @ y
        lists = pa.ListArray.from_arrays(np.arange(width + 1, dtype=np.int32) * width, pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), lists], names=["at", "products"])

    parts = fit.mapInArrow(multiplied, "at int, products array<double>")
    cells = parts.select("at", F.posexplode("products").alias("across", "product"))
    summed = cells.groupBy("at", "across").agg(F.sum("product").alias("product"))
    lines = summed.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("across", "product"))).alias("cells"))
    matrix = np.zeros((width, width))
    for line in lines.select("at", "cells.product").toLocalIterator():
        matrix[line["at"]] = line["product"]
    return (matrix + matrix.T) / 2


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """F with F F^T = `matrix` (positive semidefinite): a triangular factor, rows back in the given order, rank many columns.

    Each step takes the largest remaining diagonal entry, the first of equal
    ones, and ends when it is lost in rounding.
    """
    width = len(matrix)
    rest, left = np.diag(matrix).copy(), np.arange(width)
    floor = width * np.finfo(float).eps * rest.max(initial=0.0)
    factor = np.zeros((width, width))
    for k in range(width):
        pivot = left[np.argmax(rest[left])]
        if not rest[pivot] > floor:
            return factor[:, :k]
        left = left[left != pivot]
        factor[pivot, k] = np.sqrt(rest[pivot])
        factor[left, k] = (matrix[left, pivot] - factor[left, :k] @ factor[pivot, :k]) / factor[pivot, k]
        rest[left] -= factor[left, k] ** 2
    return factor


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of F F^T: columns of F are rotated in pairs until all are orthogonal.

    A sweep meets every pair once, in rounds of disjoint pairs. Squared norms
    of the rotated columns are the eigenvalues, the columns divided by their
    norms the components; the largest entry of each is positive.
    """
    turned = np.array(factor, dtype=float)
    rank = turned.shape[1]
    seats = list(range(rank)) + ([-1] if rank % 2 else [])
    for _ in range(SWEEPS):
        rotated = False
        for _ in range(max(0, len(seats) - 1)):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if a >= 0 and b >= 0]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            u, v = (np.array(side) for side in zip(*pairs, strict=True))
            x, y = turned[:, u], turned[:, v]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            off = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if not off.any():
                continue
            rotated = True
            u, v, x, y = u[off], v[off], x[:, off], y[:, off]
            slope = (yy[off] - xx[off]) / (2 * xy[off])
            tangent = np.where(slope >= 0, 1.0, -1.0) / (np.abs(slope) + np.hypot(1.0, slope))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            turned[:, u], turned[:, v] = cosine * x - sine * y, sine * x + cosine * y
        if not rotated:
            break
    values = (turned * turned).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, turned = values[order], turned[:, order]
    vectors = turned / np.sqrt(values) if rank else turned
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(rank)]) if rank else np.ones(0)
    return values, vectors * signs


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening learnt from each distinct vector of `vectors` (column x) once; None if there is none.

    Copies collapse inside tasks before distinct vectors are shuffled. Means
    and scatter are sums over tasks; only matrices of the vectors' width reach
    the driver. The error is measured: covariances of the whitened distinct
    vectors against the identity, in a second pass.
    """
    once = stored(vectors.select("x").distinct(), "distinct-vectors")
    head = once.select(F.size("x").alias("width")).first()
    if head is None:
        return None
    if head.width > MAX_WIDTH:
        raise ValueError(f"vectors of {head.width} entries; {MAX_WIDTH} at most")
    if head.width == 0:
        return Whitening(1, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    n, sums = _sums(once, head.width)
    mean = np.array([s / n for s in sums])
    covariance = _scatter(once, mean) / n
    values, columns = one_sided_jacobi(pivoted_cholesky(covariance))
    taken = min(components, len(values))
    found = Whitening(n, tuple(sums), columns[:, :taken], values[:taken], float(np.trace(covariance)), 0.0)
    if not taken:
        return found

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white = _whitened(found, _matrix(batch.column(0), len(sums)))
            yield pa.RecordBatch.from_arrays([pa.array(z) for z in np.ascontiguousarray(white.T)], names=[f"z{i}" for i in range(taken)])

    white = once.mapInArrow(projected, ", ".join(f"z{i} double" for i in range(taken)))
    pairs = [(i, j) for i in range(taken) for j in range(i, taken)]
    measured = white.agg(*[F.covar_pop(f"z{i}", f"z{j}") for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(measured, pairs, strict=True))
    return Whitening(n, found.sums, found.components, found.variances, found.total, float(error))


def _whitened(model: Whitening, x: np.ndarray) -> np.ndarray:
    return (x - model.mean) @ model.components / np.sqrt(model.variances)


def _deviations(model: Whitening, x: np.ndarray) -> list[int | None]:
    """The exact sums of (n x - S)^2; null where a sum is no long."""
    sums = np.array([float(s) for s in model.sums])
    largest = np.abs(model.n * x.astype(float) - sums).max(initial=0.0)
    if max(model.n * float(np.abs(x).max(initial=0)), np.abs(sums).max(initial=0.0)) < 2**62 and largest**2 * max(1, x.shape[1]) < 2**62:
        gaps = model.n * x - np.array(model.sums, np.int64)
        return (gaps * gaps).sum(axis=1).tolist()
    exact = [sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x.tolist()]
    return [e if e <= LONG_MAX else None for e in exact]


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Components are those of the distinct vectors' covariance, numbered from 1
    by falling variance; there are fewer than asked for if the rank is lower,
    so vectors that are all equal, and empty vectors, give no rows. Which rows
    are left out is told at `whole_vectors`. Rows and ids may repeat, ids may
    be null, other columns are not read; an empty table gives an empty one.
    """
    kind = table.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    vectors = whole_vectors(table, id_col, vector_col, scale)
    model = fit(vectors, components)
    if model is None or not len(model.variances):
        return vectors.sparkSession.createDataFrame([], schema)

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = len(model.variances)
        explained = (model.variances / model.total).tolist()
        for batch in batches:
            x = _matrix(batch.column(1), len(model.sums))
            rows = np.repeat(np.arange(len(x)), taken)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, taken + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), model.n)),
                    pa.array(_deviations(model, x), pa.int64()).take(pa.array(rows)),
                    pa.array(_whitened(model, x).ravel()),
                    pa.array(explained * len(x)),
                    pa.array(np.full(len(rows), model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(applied, schema)
