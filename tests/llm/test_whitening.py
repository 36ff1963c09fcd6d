"""Whitening against exact fractions and a plain covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest
from brute import SMALL

from editengine.llm import common, queries, whitening

DDL = "vec_id long, embedding array<double>"


def check(rows, out):
    """Everything that is fixed, for vectors of one length; the rest up to the sign of a component."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(d)]
    cov = [[Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n**3) for j in range(d)] for i in range(d)]
    plain = np.array([[float(c) for c in row] for row in cov])
    values, vectors = np.linalg.eigh(plain)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(sum(cov[k][k] for k in range(d)))
    assert len(out) == n * min(8, d)
    by = {(r["vec_id"], r["component"]): r for r in out}
    for (i, _), row in zip(kept, x, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))
        for k in range(min(8, d)):
            r = by[i, k + 1]
            assert r["n"] == n and r["deviation"] == (deviation if deviation < 2**63 else None)
            assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-4)
            assert r["identity_error"] <= 1e-4
            own = float(np.dot([float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)], vectors[:, k]) / math.sqrt(values[k]))
            assert abs(r["whitened"]) == pytest.approx(abs(own), rel=1e-6, abs=1e-8)


def vectors(n, d, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.linspace(3, 0.2, d)
    return [(k, (rng.normal(size=d) @ mix * scale).tolist()) for k in range(n)]


@pytest.mark.parametrize("n,d,scale", [(60, 12, 1.0), (40, 3, 5.0), (30, 9, 1e5), (200, 1, 0.5)])
def test_against_exact_fractions(spark, monkeypatch, n, d, scale):
    monkeypatch.setattr(whitening, "AT_ONCE", 17)
    rows = vectors(n, d, n, scale)
    rows += [(900, None), (901, [None] + [1.0] * (d - 1)), (902, [float("nan")] * d), (903, [float("inf")] * d), (904, [])]
    df = spark.createDataFrame(rows, DDL).repartition(4).selectExpr("*", "'clash' AS component", "'clash' AS v", "'clash' AS d")
    check(rows, whitening.whiten(df).collect())


def test_sums_of_squares_are_exact_however_large():
    rng = np.random.default_rng(1)
    for bits in (10, 28, 31, 39):
        z = rng.integers(-(2**bits), 2**bits, (50, 4))
        plain = [[int(v) for v in row] for row in z]
        i, j = whitening.triangle(4)
        assert whitening.squares(z).tolist() == [sum(r[a] ** 2 if a == b else (r[a] + r[b]) ** 2 for r in plain) for a, b in zip(i, j, strict=True)]


def test_odd_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([], DDL)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0])], DDL)).collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(None, k, 1, 0, None, 0.0, None) for k in (1, 2)]
    # A dimension that never varies, repeated ids, and vectors of two lengths.
    rows = [(k % 5, [float(k), 2.0 * k, 7.0]) for k in range(10)] + [(k, [float(k * k % 7)]) for k in range(6)]
    out = whitening.whiten(spark.createDataFrame(rows, DDL)).collect()
    assert len(out) == 10 * 3 + 6 and {r["n"] for r in out} == {10, 6}
    assert sum(r["whitened"] is None for r in out) == 20
    assert all(r["identity_error"] < 1e-9 for r in out)
    assert {r["explained"] for r in out if r["n"] == 6} == {1.0}


def test_op13_over_the_small_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in common.table(spark, SMALL, "embeddings").collect()]
    out = queries.op13_polarised_whitening(spark, SMALL).collect()
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    # The covariance over the whole table in whole numbers, by matrix products.
    x = np.floor(1024 * np.array([v for _, v in kept], dtype=np.float64)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    y = n * x - sums
    cov = (y.T @ y) / n**3
    values, vecs = np.linalg.eigh(cov)
    own = (y / n) @ vecs[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    by = {(r["vec_id"], r["component"]): r for r in out}
    assert len(out) == len(by) == 8 * n
    for k, (i, _) in enumerate(kept):
        for c in range(8):
            r = by[i, c + 1]
            assert r["deviation"] == int((y[k] ** 2).sum()) and abs(abs(r["whitened"]) - abs(own[k, c])) < 1e-6
            assert r["explained"] == pytest.approx(values[::-1][c] / np.trace(cov), rel=1e-6) and r["identity_error"] < 1e-9
