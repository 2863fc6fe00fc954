"""Whitening against dense eigenvectors."""

import math

import numpy as np
import pytest

from inforce.llm import whitening as W


def dense(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, dtype=float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    c = x - sums / n
    e, u = np.linalg.eigh(c.T @ c / n)
    k = min(components, x.shape[1])
    return x, n, sums, c, e[::-1][:k], u[:, ::-1][:, :k]


@pytest.mark.parametrize(("dims", "spread"), [(64, 3.0), (64, 1.0), (200, 2.0), (9, 5.0), (3, 1.5), (1, 1.0)])
def test_pairs_equal_dense_ones(dims, spread):
    rng = np.random.default_rng(dims)
    x = rng.standard_normal((1500, dims)) * np.linspace(1, spread, dims)
    v = x.T @ x / len(x)
    values, vectors, residual = W.jacobi_davidson(lambda block: v @ block, dims, 8)
    e = np.linalg.eigvalsh(v)[::-1][: min(8, dims)]
    assert np.allclose(values, e, rtol=1e-13, atol=0) and residual < 1e-12
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * e[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(e))).max() < 1e-13


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 2, 2, 1, 1, 1, 1, 1, 0.5, 0.1], [9, 1e-9, 0, 0, 0, 0, 0, 0, 0, 0], [1] * 12, [0] * 10])
def test_ties_and_missing_rank(spectrum):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(spectrum), len(spectrum))))[0]
    v = q * spectrum @ q.T
    values, vectors, _ = W.jacobi_davidson(lambda block: v @ block, len(spectrum), 8)
    assert np.abs(values - np.sort(spectrum)[::-1][:8]).max() < 1e-12 * max(spectrum[0], 1)
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 20))
    v = x.T @ x / 400
    u = np.linalg.qr(rng.standard_normal((20, 2)))[0]
    r = rng.standard_normal((20, 2))
    r -= u @ (u.T @ r)
    theta = np.array([0.1, 5.0])
    t = W._minres(lambda b: v @ b, theta, u, r, 40)
    p = np.eye(20) - u @ u.T
    for j in range(2):
        assert np.abs(p @ (v - theta[j] * np.eye(20)) @ p @ t[:, j] + r[:, j]).max() < 1e-9
    assert np.abs(u.T @ t).max() < 1e-12


def test_operator_equals_dense(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(0.1, 2, 12)).tolist()
    rows = [(i, v, "x", "y") for i, v in enumerate(vectors)] + [(5, vectors[5], "x", "y"), (None, vectors[6], "x", "y")]
    bad = [(900, None, "x", "y"), (901, [1.0] * 11 + [None], "x", "y"), (902, [math.nan] + [1.0] * 11, "x", "y"), (903, [math.inf] * 12, "x", "y"), (904, [], "x", "y"), (905, [1.0] * 5, "x", "y"), (906, [1e30] * 12, "x", "y")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, component string, n string")
    got = W.whitened_embeddings(table.repartition(4)).collect()
    x, n, sums, c, e, u = dense([r[1] for r in rows])
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
    projected, total = c @ u / np.sqrt(e), float((c**2).sum() / n)
    deviation = {}
    for r, row in zip(rows, x.tolist(), strict=True):
        deviation.setdefault(r[0], []).append(sum((n * v - int(s)) ** 2 for v, s in zip(row, sums, strict=True)))
    place = {r[0]: k for k, r in enumerate(rows)}
    signs = {}
    for r in got:
        want = projected[place[r.vec_id], r.component - 1]
        if abs(want) > 0.1:
            assert signs.setdefault(r.component, math.copysign(1, want * r.whitened)) == math.copysign(1, want * r.whitened)
        assert abs(abs(r.whitened) - abs(want)) < 1e-9
        assert r.deviation in deviation[r.vec_id]
        assert abs(r.explained - e[r.component - 1] / total) < 1e-12 and r.identity_error < 1e-10


def test_no_variance_and_empty(spark):
    same = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, W.whitened_embeddings(same).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()))
    assert got == [(i, k, 2, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    line = spark.createDataFrame([(i, [float(i), float(i), 0.0]) for i in range(9)], "vec_id long, embedding array<float>")
    got = W.whitened_embeddings(line).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and abs(got[0].explained - 1) < 1e-12
    for empty in (same.limit(0), spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")):
        assert W.whitened_embeddings(empty).collect() == []


def test_deviation_is_exact_or_null():
    x = np.array([[3, -4], [5, 6]])
    assert W.exact_deviation(x, 2, (8, 2)) == [(6 - 8) ** 2 + (-8 - 2) ** 2, (10 - 8) ** 2 + (12 - 2) ** 2]
    big = np.array([[2**40, 0], [0, 0]])
    sums = (2**40, 0)
    assert W.exact_deviation(big, 2, sums) == [None, None]  # 2^80
    n = 3_000_000_000
    near = np.array([[100_000 + 1, 100_000]])
    assert W.exact_deviation(near, n, (n * 100_000 + 7, n * 100_000)) == [(n - 7) ** 2 if (n - 7) ** 2 < 2**63 else None]
