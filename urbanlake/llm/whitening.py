"""Whitening of embeddings by their principal components.

Entries are put on a grid of ``1 / grid`` (``x = floor(grid * c)``, an integer),
so that sums are exact in any order.  The fit list holds every distinct ``x``
vector once.  Its centred scatter matrix is summed from the partitions' own
matrices; then, on a matrix of the vectors' width squared and nothing that grows
with the rows:

* Cholesky with the largest remaining diagonal entry as pivot gives a triangular
  factor ``scatter = L L'`` and the rank;
* one-sided Jacobi turns pairs of the factor's columns until all are orthogonal;
  a rotated column's squared norm is an eigenvalue of the scatter, the normalised
  column its component.  The scatter itself is never diagonalised, which keeps
  small eigenvalues to their own precision (Drmac and Veselic, 2008).

Every usable row is then projected on the leading components and scaled to unit
variance over the fit list.

Defined cases: a vector that is null, empty or holds null, NaN or infinite
entries is left out.  Vectors of another length than the most frequent one (of
equally frequent ones the longest) are left out too.  Repeated rows come back
one by one.  A spread of no dimension, as for one distinct vector, has no
components and gives no rows; with fewer than ``components`` there are fewer.  A
``deviation`` beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import batches, saved

#: Eigenvalues and pivots below this share of the largest are rounding, not spread.
TINY = 1e-13
LONG = (1 << 63) - 1


# ------------------------------------------------------------ a small matrix

def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """``L`` (width x rank) with ``L L'`` equal to the scatter: each step takes the largest diagonal entry left."""
    a = np.array(scatter, dtype=np.float64)
    width = len(a)
    left = a.diagonal().copy()
    factor = np.zeros((width, width))
    floor = TINY * max(left.max(initial=0.0), 0.0)
    done = np.zeros(width, dtype=bool)
    for r in range(width):
        pivot = int(np.argmax(np.where(done, -np.inf, left)))
        if left[pivot] <= floor:
            return factor[:, :r]
        root = np.sqrt(left[pivot])
        column = (a[:, pivot] - factor[:, :r] @ factor[pivot, :r]) / root
        column[done] = 0.0
        column[pivot] = root
        factor[:, r] = column
        left = left - column * column
        done[pivot] = True
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``factor factor'`` falling, and unit eigenvectors as columns.

    Columns meet in rounds of disjoint pairs (a round-robin tournament); a pair
    whose cosine passes the machine's rounding is turned until it is orthogonal.
    """
    u = np.array(factor, dtype=np.float64)
    if u.shape[1] % 2:
        u = np.hstack([u, np.zeros((len(u), 1))])
    n = u.shape[1]
    seat = np.arange(n)
    for _ in range(sweeps):
        turned = False
        for _ in range(n - 1):
            i, j = seat[:n // 2], seat[n // 2:][::-1]
            x, y = u[:, i], u[:, j]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if turn.any():
                turned = True
                safe = np.where(turn, xy, 1.0)
                zeta = (yy - xx) / (2.0 * safe)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                t = np.where(turn, t, 0.0)
                c = 1.0 / np.hypot(1.0, t)
                u[:, i], u[:, j] = c * x - c * t * y, c * t * x + c * y
            seat = np.concatenate([seat[:1], seat[-1:], seat[1:-1]])
        if not turned:
            break
    values = (u * u).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, u = values[order], u[:, order]
    some = values > TINY * max(values.max(initial=0.0), 0.0)
    return values[some], u[:, some] / np.sqrt(values[some])


# ------------------------------------------------------------------ the rows

@dataclass(frozen=True)
class Whitening:
    """What is learnt: ``n`` distinct vectors, their exact sums, leading eigenvalues and components, all variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], dtype=np.float64)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.values)


def gridded(vectors: DataFrame, grid: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, x``: usable vectors of the most frequent length as integers of ``1 / grid``."""
    e = F.col(vector).cast("array<double>")
    fine = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(key).alias("key"), e.alias("e")).filter(F.coalesce(fine & (F.size("e") > 0), F.lit(False)))
    x = F.transform("e", lambda c: F.floor(F.lit(float(grid)) * c).cast("long") + F.lit(0).cast("long"))
    usual = rows.groupBy(F.size("e").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.filter(F.size("e") == (usual.width if usual else 0)).select("key", x.alias("x"))


def _block(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scatter_parts(mean: np.ndarray):
    """One matrix of a partition, as a row for each line of it."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), len(mean)))
        for b in batches(rows, 4096):
            y = _block(b.column("x")).astype(np.float64) - mean
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(len(mean)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         ["line", "cells"])
    return run


def _matrix(lines: DataFrame, width: int) -> np.ndarray:
    """Lines added cell by cell over the partitions: width x width numbers, whatever the number of rows."""
    sums = lines.groupBy("line").agg(*[F.sum(F.col("cells")[i]).alias(f"c{i}") for i in range(width)])
    out = np.zeros((width, width))
    for r in sums.collect():
        out[r[0]] = r[1:]
    return (out + out.T) / 2.0


def fit(distinct: DataFrame, components: int = 4) -> Whitening | None:
    """Learn from the fit list ``x``; None where it has no spread."""
    width = distinct.select(F.size("x").alias("w")).limit(1).collect()
    if not width:
        return None
    width = width[0].w
    wide = [F.sum(F.col("x")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    found = distinct.agg(F.count(F.lit(1)).alias("n"), *wide).first()
    n, sums = found[0], [int(s) for s in found[1:]]
    mean = np.array([s / n for s in sums], dtype=np.float64)
    scatter = _matrix(distinct.mapInArrow(_scatter_parts(mean), "line int, cells array<double>"), width)
    values, vectors = one_sided_jacobi(pivoted_cholesky(scatter))
    if not len(values):
        return None
    return Whitening(n, sums, values[:components] / n, vectors[:, :components], float(np.trace(scatter)) / n)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry by which the whitened fit list's covariance differs from the identity."""
    k = len(model.values)

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for b in batches(rows, 4096):
            total += model.project(_block(b.column("x"))).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))],
                                         ["line", "cells"])

    added = distinct.mapInArrow(sums, "line int, cells array<double>").agg(
        *[F.sum(F.col("cells")[i]) for i in range(k)]).first()
    centre = np.array([s / model.n for s in added])

    def parts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches(rows, 4096):
            z = model.project(_block(b.column("x"))) - centre
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         ["line", "cells"])

    covariance = _matrix(distinct.mapInArrow(parts, "line int, cells array<double>"), k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact ``sum((n x - S)^2)`` of each row; None where a long can't hold it."""
    far = np.abs(n * x.astype(np.float64) - np.array(sums, dtype=np.float64)).max(axis=1, initial=0.0)
    small = far * far * x.shape[1] < 2.0 ** 62                       # every step fits 64 bits
    out: list[int | None] = [None] * len(x)
    at = np.flatnonzero(small)
    if len(at):
        # products and sums may pass 64 bits; their differences don't, so what wraps round comes back
        y = n * x[at] - np.array([(s + LONG + 1) % (1 << 64) - LONG - 1 for s in sums], dtype=np.int64)
        for i, d in zip(at, (y * y).sum(axis=1).tolist(), strict=True):
            out[i] = d
    for i in np.flatnonzero(~small):
        d = sum((n * int(v) - s) ** 2 for v, s in zip(x[i], sums, strict=True))
        out[i] = d if d <= LONG else None
    return out


def whitened(vectors: DataFrame, components: int = 4, grid: int = 256, key: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for each usable row and component."""
    schema = (f"{key} long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    rows = saved(gridded(vectors, grid, key, vector), "whitening-rows")
    distinct = saved(rows.select("x").distinct(), "whitening-fit")
    model = fit(distinct, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(distinct, model), len(model.values)
    explained = model.values / model.trace

    def run(batch: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(batch, 4096):
            x = _block(b.column("x"))
            far = deviations(x, model.n, model.sums)
            m = len(x)
            at = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("key").cast(pa.int64()).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n, dtype=np.int64)), pa.array([d for d in far for _ in range(k)], pa.int64()),
                 pa.array(model.project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
