"""Whitening against exact sums and eigenvectors of plain linear algebra."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from studytrace.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def residuals(a, values, vectors):
    a = a.astype(np.longdouble)
    size = float(np.abs(a).max()) or 1.0
    apart = float(np.abs(a @ vectors - vectors * values).max()) / size
    return apart, float(np.abs(vectors.T @ vectors - np.eye(len(a))).max())


@pytest.mark.parametrize("kind", ["spread", "near", "pairs", "equal", "zero"])
def test_refined_eigenvectors_are_exact_beyond_double(kind):
    rng = np.random.default_rng(5)
    for _ in range(8):
        d = int(rng.integers(2, 30))
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        values = {
            "spread": 10.0 ** rng.uniform(-14, 3, size=d),
            "near": 1 + 10.0 ** rng.uniform(-14, -3) * np.arange(d),
            "pairs": np.repeat(rng.uniform(size=d), 2)[:d] + 1e-9 * rng.uniform(size=d),
            "equal": np.repeat([2.0, 1.0], d)[d // 2 : d // 2 + d],
            "zero": np.zeros(d),
        }[kind]
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        found, vectors = W.refined_eigenvectors(a)
        assert max(residuals(a, found, vectors)) < 1e-17
        assert np.all(np.diff(found) <= 1e-18)
        assert np.allclose(found.astype(float), np.linalg.eigvalsh(a)[::-1], atol=1e-12 * (1 + abs(a).max()))


def test_clustered_eigenvalues_are_told_apart():
    """Double precision loses these vectors; the sub-solve keeps them."""
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(12) - q.T @ q) / 2
    values = np.concatenate([[1 + 3e-10, 1 + 2e-10, 1], np.linspace(0.9, 0.1, 9)]).astype(np.longdouble)
    a = (q * values) @ q.T
    _, vectors = W.refined_eigenvectors((a + a.T) / 2)
    assert float(np.abs(np.abs(q.T @ vectors) - np.eye(12)).max()) < 1e-8


def test_product_sums_are_exact():
    rng = np.random.default_rng(1)
    for top in (0, 3, 2**20, 2**28, 2**51):
        z = rng.integers(-top, top + 1, size=(37, 3))
        wide = z.astype(object)
        assert W.product_sums(z) == (wide.T @ wide).tolist()


def plain(rows):
    """Exact x, sums and covariance of the rows that take part."""
    used = [
        (i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    n, d = len(used), len(used[0][1])
    sums = [sum(x[j] for _, x in used) for j in range(d)]
    cov = [
        [sum(Fraction(n * x[i] - sums[i], n) * Fraction(n * x[j] - sums[j], n) for _, x in used) / n for j in range(d)]
        for i in range(d)
    ]
    return used, n, sums, cov


def test_query_equals_plain_linear_algebra(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.2 * (j + 1)) for j in range(10)]) for i in range(120)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, []), (902, [0.1] * 9 + [None])]
    rows += [(903, [0.1] * 9 + [float("nan")]), (904, [0.1] * 9 + [float("inf")])]
    spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = W.op11_mixed_precision_whitening(spark, str(tmp_path)).collect()
    used, n, sums, cov = plain(rows)
    assert len(got) == 8 * len(used)
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    trace = float(sum(cov[i][i] for i in range(10)))
    want = {}
    for i, x in used:
        w = (np.array(x) - np.array([s / n for s in sums])) @ vectors / np.sqrt(values)
        want.setdefault(i, []).append((sum((n * a - s) ** 2 for a, s in zip(x, sums)), w))
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    signs = np.ones(8)
    for r in by_id[0]:
        signs[r["component"] - 1] = np.sign(r["whitened"] * want[0][0][1][r["component"] - 1])
    for i, listed in want.items():
        assert len(by_id[i]) == 8 * len(listed)
        for r in by_id[i]:
            k = r["component"] - 1
            assert r["n"] == n and r["deviation"] == listed[0][0]
            assert abs(r["whitened"] - signs[k] * listed[0][1][k]) < 1e-9
            assert abs(r["explained"] - values[k] / trace) < 1e-12
            assert r["identity_error"] < 1e-10


def test_missing_variance_few_dimensions_and_other_lengths(spark, tmp_path):
    rows = [(i, [float(i), 2.0 * i, 1.0], 0) for i in range(6)] + [(50, [1.0], 0), (51, [3e38, 0.0, 0.0], 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = W.op11_mixed_precision_whitening(spark, str(tmp_path)).collect()
    assert sorted({r["vec_id"] for r in got}) == list(range(6))
    assert {r["component"] for r in got} == {1, 2, 3}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert all(r["identity_error"] < 1e-10 for r in got)


def test_one_vector_and_none(spark, tmp_path):
    one = spark.createDataFrame([(1, [0.5, 0.25], 0)], SCHEMA)
    one.write.parquet(f"{tmp_path}/a/embeddings.parquet")
    got = W.op11_mixed_precision_whitening(spark, f"{tmp_path}/a").collect()
    assert [(r["component"], r["whitened"], r["deviation"]) for r in got] == [(1, None, 0), (2, None, 0)]
    one.limit(0).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert W.op11_mixed_precision_whitening(spark, f"{tmp_path}/b").collect() == []


def test_other_columns_stay_and_sums_fit_no_long(spark):
    rows = spark.createDataFrame([(i, [1e9 * i, -1e9], "taken") for i in range(4)], "id long, v array<double>, deviation string")
    vectors = W.whole_vectors(rows, "v")
    fitted = W.fit_whitening(W.fit_moments(vectors, "v"))
    got = W.whitened(vectors, "v", fitted).collect()
    assert {r["deviation"] for r in got} == {"taken"}
    for r in got:
        exact = sum((4 * x - s) ** 2 for x, s in zip(r["v"], fitted.sums))
        assert r["whitened"]["deviation"] == (exact if exact < 2**63 else None)
