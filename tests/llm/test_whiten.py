import math
from fractions import Fraction

import numpy as np
import pytest
from helpers import with_clashes

from eventflow.llm import whiten

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, d):
    """n, S, deviations and covariance of the definition, in exact arithmetic."""
    x = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows
         if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted(set(v for _, v in x))
    n, total = len(fit), [sum(v[j] for v in fit) for j in range(d)]
    mean = [Fraction(t, n) for t in total]
    cov = np.array([[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(d)] for i in range(d)])
    deviation = [(i, sum((n * v[j] - total[j]) ** 2 for j in range(d))) for i, v in x]
    return n, mean, cov, deviation, x


def check(spark, rows, d, k):
    out = whiten.whiten(with_clashes(spark.createDataFrame(rows, SCHEMA))).collect()
    n, mean, cov, deviation, x = brute(rows, d)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(out) == k * len(x) and {r["n"] for r in out} == {n}
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["vec_id"], int(r["deviation"])) for r in out if r["component"] == 1], key=key) == sorted(deviation, key=key)
    assert {r["identity_error"] for r in out}.pop() <= 1e-8
    for c in range(k):
        mine = sorted([(r["vec_id"], r["whitened"]) for r in out if r["component"] == c + 1], key=key)
        live = values[c] > values[0] * d * 2.0 ** -52
        if not live:
            assert all(v is None for _, v in mine)
            continue
        want = sorted([(i, float(sum(float(a - m) * vectors[j, c] for j, (a, m) in enumerate(zip(v, mean)))) / math.sqrt(values[c])) for i, v in x], key=key)
        sign = 1 if sum(a[1] * b[1] for a, b in zip(mine, want)) >= 0 else -1
        assert [i for i, _ in mine] == [i for i, _ in want]
        assert np.allclose([v for _, v in mine], [sign * v for _, v in want], atol=1e-6)
        assert {r["explained"] for r in out if r["component"] == c + 1}.pop() == pytest.approx(values[c] / cov.trace(), rel=1e-9)


def test_against_exact_arithmetic(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [3, 2, 1, 0.7, 0.4]]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(50)] + [rows[3], (None, rows[9][1])]
    rows += [(1, None), (2, []), (3, [None] * 5), (4, [float("nan")] * 5), (5, [float("inf")] * 5), (6, [1.0, 2.0]), (7, [1e300] * 5)]
    rows_kept = [r for r in rows if r[1] != [1e300] * 5]
    monkeypatch.setattr(whiten, "BLOCK_ROWS", 100)
    monkeypatch.setattr(whiten, "OUT_ROWS", 17)
    out = whiten.whiten(spark.createDataFrame(rows, SCHEMA)).count()
    assert out == 5 * 352
    check(spark, rows_kept, 5, 5)


def test_flat_dimension_large_values_and_empty(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(rng.normal()), 2.5, float(rng.integers(-10 ** 12, 10 ** 12))]) for i in range(80)]
    n, mean, cov, deviation, x = brute(rows, 3)
    out = whiten.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"], int(r["deviation"])) for r in out if r["component"] == 1) == sorted(deviation)
    assert all(r["whitened"] is None for r in out if r["component"] == 3)
    assert whiten.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    one = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 2, SCHEMA)).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in one)


def test_planes_give_products():
    y = np.random.default_rng(5).integers(0, 1000, (333, 4))
    got = whiten.plane_products(y, 10)
    got = (np.triu(got) + np.triu(got, 1).T).reshape(4, 10, 4, 10)
    w = 1 << (np.arange(10)[:, None] + np.arange(10))
    assert np.array_equal(np.einsum("iajb,ab->ij", got, w), y.T @ y)
