"""Whitening against NumPy's own eigen-decomposition and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackwise.llm import queries
from trackwise.llm.whitening import one_sided_jacobi, pivoted_cholesky, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=4):
    """{vec_id: (deviation, whitened up to sign)}, n, explained."""
    kept = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int).tolist()) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=float)
    n, total = len(fit), [sum(int(v) for v in c) for c in fit.T]
    centred = fit - fit.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = {i: (sum((n * a - s) ** 2 for a, s in zip(x, total)), (np.array(x) - fit.mean(0)) @ axes[:, :k] / np.sqrt(values[:k])) for i, x in kept}
    return out, n, values[:k] / values.sum()


def compare(got, rows):
    want, n, explained = plain(rows)
    got = got.toPandas().sort_values(["vec_id", "component"])
    assert set(got.n) == {n} and (got.identity_error < 1e-9).all() and got.identity_error.nunique() == 1
    signs = {}
    for i, g in got.groupby("vec_id"):
        assert g.component.tolist() == [1, 2, 3, 4] and set(g.deviation) == {want[i][0]}
        assert np.allclose(g.explained, explained, rtol=1e-9)
        assert np.allclose(np.abs(g.whitened), np.abs(want[i][1]), atol=1e-7)
        for c, a, b in zip(g.component, g.whitened, want[i][1]):
            if abs(b) > 1e-3:
                assert signs.setdefault(c, np.sign(a * b)) == np.sign(a * b)
    assert set(got.vec_id) == set(want)


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
            if r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding)]
    compare(queries.op13_whitening(spark, sf), rows)


@pytest.mark.parametrize("rank", [1, 5, 20, 30])
def test_factor_and_rotations(rank):
    rng = np.random.default_rng(rank)
    x = rng.normal(size=(200, rank)) @ (rng.normal(size=(rank, 30)) * 10.0 ** rng.integers(-3, 3, rank)[:, None])
    a = x.T @ x
    factor = pivoted_cholesky(a)
    assert factor.shape[1] <= rank and np.allclose(factor @ factor.T, a, rtol=0, atol=1e-11 * a.max())
    pivots = (factor ** 2).max(axis=0)
    assert (np.diff(pivots) <= 1e-12 * pivots[0]).all()
    values, axes = one_sided_jacobi(factor)
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-13)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:len(values)], rtol=1e-9, atol=1e-12 * values[0])
    assert np.allclose(axes * values @ axes.T, a, rtol=0, atol=1e-11 * a.max())


def test_repeats_nulls_and_clashing_columns(spark):
    rng = np.random.default_rng(5)
    x = np.float32(rng.normal(size=(300, 6)) * [5, 4, 3, 2, 1, 0.5])
    x[50:180] = x[0]  # one vector holds a third of all rows
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, [float("nan")] * 6), (902, [float("inf")] + [0.0] * 5), (903, [None] + [1.0] * 5), (904, []), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], SCHEMA).withColumns(
        {c: F.lit(c) for c in ("x", "v", "d", "n", "component", "z0", "cell", "dim")}).repartition(5)
    compare(whiten(df), rows)


def test_few_vectors_and_no_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty).count() == 0 and whiten(empty).columns == whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [3.0, 4.0], 1)], SCHEMA)).columns
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    got = whiten(spark.createDataFrame([(1, [0.0, 0.0], 1), (None, [3.0, 4.0], 1), (1, [0.0, 0.0], 2)], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation) for r in got) == [(0, 1, 2, 768 ** 2 + 1024 ** 2), (1, 1, 2, 768 ** 2 + 1024 ** 2), (1, 1, 2, 768 ** 2 + 1024 ** 2)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and abs(r.explained - 1) < 1e-12 for r in got)


def test_deviations_beyond_a_long(spark):
    rows = [(1, [1e8, 1.0], 1), (2, [-1e8, 3.0], 1), (3, [5.0, 1.0], 1), (4, [3e38, 1.0], 1)]
    got = {(r.vec_id, r.component): r.deviation for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, 1): None for i in (1, 2, 3, 4)}  # beside 2^52 the second component is lost in rounding
