"""Whitening of vectors: pivoted Cholesky of the scatter, one-sided Jacobi on its factor.

Vectors that are null, empty or hold null or non-finite entries are dropped. Every
entry c becomes the integer x = floor(``SCALE`` * c); the fit list holds each distinct
x vector once (n vectors, sums S).

1. The distinct vectors are written once. Every task adds up its vectors and their
   squares; n and S are exact.
2. A second pass centres each vector at S / n, then adds up the products in its task:
   d x d cells a task, summed by cell. One d x d matrix reaches the driver.
3. Cholesky with diagonal pivoting: scatter = L L^T with rows of L in the old order
   and columns by falling pivot, as many as the rank.
4. One-sided Jacobi turns pairs of columns of L until all are orthogonal (disjoint
   pairs together, as in a round-robin tournament). Squared column norms / n
   are the eigenvalues of the covariance, normalised columns its components.
5. The whitened fit list is projected once more and its covariance measured
   (``covar_pop`` centres as it goes); then every kept row is projected.

Defined results: components without variance, or with none beyond the rounding of
the largest, are left out (fewer than two distinct vectors: no rows). Vectors of another length than the most common one (of equally
common ones the longest) are dropped. Repeated rows and null ids are projected
like any other. An entry whose x exceeds +-2^52 counts as that bound; a deviation
beyond a long is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SCALE = 256
COMPONENTS = 4
LARGEST = float(1 << 52)
SWEEPS = 60


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L^T, for symmetric positive semidefinite ``a``: one column per
    step, each for the largest diagonal entry left; stops at the rank."""
    rest = np.diag(a).astype(np.float64).copy()
    limit = len(a) * np.finfo(float).eps * (rest.max() if len(rest) else 0.0)
    columns = np.zeros((len(a), len(a)))
    done = np.zeros(len(a), dtype=bool)
    rank = 0
    while rank < len(a):
        p = int(np.argmax(np.where(done, -np.inf, rest)))
        if not rest[p] > limit:
            break
        column = a[:, p] - columns[:, :rank] @ columns[p, :rank]
        column[done] = 0.0
        root = np.sqrt(rest[p])
        column = column / root
        column[p] = root
        columns[:, rank] = column
        rest -= column * column
        done[p] = True
        rank += 1
    return columns[:, :rank]


def _tournament(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which every two of n columns meet once."""
    seats = list(range(n + n % 2))
    rounds = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(min(x, y), max(x, y)) for x, y in zip(seats[:half], reversed(seats[half:])) if max(x, y) < n]
        rounds.append((np.array([x for x, _ in pairs], dtype=int), np.array([y for _, y in pairs], dtype=int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return rounds


def one_sided_jacobi(factor: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of factor factor^T, by falling eigenvalue."""
    a = factor.astype(np.float64).copy()
    n = a.shape[1]
    rounds = _tournament(n) if n > 1 else []
    small = np.finfo(float).eps * np.sqrt(max(len(a), 1))
    for _ in range(sweeps):
        turned = False
        for i, j in rounds:
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > small * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            i, j, x, y, xx, yy, xy = i[turn], j[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
            zeta = (yy - xx) / (2 * xy)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            a[:, i], a[:, j] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    norms = np.sqrt((a * a).sum(0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, a[:, order] / norms[order]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for b in batches:
            x = _matrix(b.column(0), dims)
            n += len(x)
            # 2^52 times the rows of a batch may pass a long: add the two halves
            low = (x & 0xFFFFFF).sum(axis=0).tolist()
            high = (x >> 24).sum(axis=0).tolist()
            total = [t + lo + (hi << 24) for t, lo, hi in zip(total, low, high)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
                                              pa.array([str(t) for t in total])], names=["dim", "n", "total"])
    return run


def _scatter_cells(centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = len(centre)
        total = np.zeros((dims, dims))
        for b in batches:
            x = _matrix(b.column(0), dims) - centre
            total += x.T @ x
        cell = np.arange(dims * dims, dtype=np.int64)
        for lo in range(0, len(cell), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(cell[part]), pa.array(total.ravel()[part])], names=["cell", "value"])
    return run


def _project(centre: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = (_matrix(b.column(0), len(centre)) - centre) @ axes
            yield pa.RecordBatch.from_arrays([pa.array(z[:, k]) for k in range(axes.shape[1])],
                                             names=[f"z{k}" for k in range(axes.shape[1])])
    return run


def _deviation(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exactly; null beyond a long."""
    most = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, total))
    if most * most * len(total) < 1 << 63:
        return (np.square(n * x - np.array(total, dtype=np.int64)).sum(axis=1)).tolist()
    rows = [sum((n * v - s) ** 2 for v, s in zip(row, total)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in rows]


def _whitened_rows(n: int, total: list[int], axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, k = np.array([t / n for t in total]), axes.shape[1]
        for b in batches:
            x = _matrix(b.column(1), len(total))
            z = (x - centre) @ axes
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            deviation = pa.array(_deviation(x, n, total), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), deviation, pa.array(z.ravel())],
                names=["vec_id", "component", "deviation", "whitened"])
    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """One row per kept row and component: vec_id, component, n, deviation, whitened,
    explained (share of the variance), identity_error (largest deviation of the whitened
    fit list's covariance from the identity)."""
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    v = F.col("v")
    clean = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    clean = clean.select("vec_id", F.transform(v, lambda c: F.floor(F.greatest(F.least(
        c * scale, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long")).alias("x"))
    lengths = clean.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dims = lengths["d"]
    clean = clean.where(F.size("x") == dims)
    fit = materialize(clean.select("x").distinct(), "fit")

    # one row per dimension reaches the driver
    sums = fit.mapInArrow(_sums(dims), "dim int, n long, total string").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect()
    n, total = sums[0]["n"], [int(r["total"]) for r in sums]
    centre = np.array([t / n for t in total])

    # one d x d matrix reaches the driver
    scatter = np.zeros(dims * dims)
    for r in fit.mapInArrow(_scatter_cells(centre), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        scatter[r["cell"]] = r["value"]
    scatter = scatter.reshape(dims, dims)
    scatter = (scatter + scatter.T) / 2
    values, axes = one_sided_jacobi(pivoted_cholesky(scatter))
    values, trace = values[:components] / n, float(np.trace(scatter)) / n
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    axes = axes[:, :k] / np.sqrt(values)

    z = fit.mapInArrow(_project(centre, axes), ", ".join(f"z{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    covariance = z.agg(*(F.covar_pop(f"z{i}", f"z{j}") for i, j in pairs)).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(covariance, pairs))

    share = F.element_at(F.array(*(F.lit(float(e / trace)) for e in values)), F.col("component"))
    return clean.mapInArrow(_whitened_rows(n, total, axes), "vec_id long, component int, deviation long, whitened double").select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(float(error)).alias("identity_error"))
