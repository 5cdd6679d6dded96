"""Spectral divide and conquer against a dense solver, whitening against exact sums."""

from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from sheafline.llm import whitening as wh


def matrices():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    yield "graded", (q * 10.0 ** -np.arange(30)) @ q.T
    yield "multiple", (q * np.repeat([9.0, 4.0, 1.0], 10)) @ q.T
    yield "low rank", (q * np.r_[5.0, 2.0, np.zeros(28)]) @ q.T
    yield "indefinite", (q * np.linspace(-3, 3, 30)) @ q.T
    yield "close", (q * np.r_[1 + 1e-9, 1.0, np.full(28, 0.5)]) @ q.T
    yield "identity", np.eye(7)
    yield "zero", np.zeros((4, 4))
    yield "one", np.array([[3.0]])
    yield "diagonal", np.diag([1.0, 5.0, 5.0, 2.0])


@pytest.mark.parametrize("name", [n for n, _ in matrices()])
def test_spectrum(name):
    a = dict(matrices())[name]
    a = (a + a.T) / 2
    values, vectors = wh.spectrum(a)
    size = max(1e-300, np.linalg.norm(a))
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * size, rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(len(a)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * values, atol=2e-13 * size)


def test_polar_factor():
    a = np.random.default_rng(3).standard_normal((20, 20))
    a = a + a.T
    u = wh.polar_factor(a)
    assert np.allclose(u @ u, np.eye(20), atol=1e-12) and np.all(np.linalg.eigvalsh(u @ a) > 0)


def brute(rows):
    """{id: (deviation, x - mean)}, n and the covariance, from whole numbers."""
    usable = [(i, x) for i, x in rows if x and all(v is not None and np.isfinite(v) for v in x)]
    d = max(Counter(len(x) for _, x in usable).items(), key=lambda p: (p[1], p[0]))[0]
    whole = [(i, tuple(int(np.floor(256 * float(np.float32(v)))) for v in x)) for i, x in usable if len(x) == d]
    fit = sorted({x for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    gram = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n**3) for j in range(d)] for i in range(d)]
    each = [(i, sum((n * v - s) ** 2 for v, s in zip(x, sums)), [v - s / n for v, s in zip(x, sums)]) for i, x in whole]
    return each, n, np.array([[float(v) for v in row] for row in gram])


def check(spark, rows, **more):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, extra int")
    got = wh.whiten(vectors, **more).collect()
    each, n, v = brute([r[:2] for r in rows])
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    taken = min(4, len(values))
    assert Counter((r["id"], r["component"], r["deviation"]) for r in got) == Counter(
        (i, k, s) for i, s, _ in each for k in range(1, taken + 1)
    )
    assert {r["n"] for r in got} == {n}
    for k in range(1, taken + 1):
        rows_k = sorted((r["id"], r["deviation"], r["whitened"], r["explained"]) for r in got if r["component"] == k)
        assert all(abs(r[3] - values[k - 1] / values.sum()) <= 1e-9 for r in rows_k)
        want = sorted((i, s, float(np.dot(y, basis[:, k - 1]))) for i, s, y in each)
        want = np.array([w[2] for w in want]) / np.sqrt(values[k - 1])
        have = np.array([r[2] for r in rows_k])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-9
    assert all(r["identity_error"] < 1e-9 for r in got)
    return got


def test_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    scale = np.array([3.0, 2.0, 1.2, 0.7, 0.3, 0.1])
    rows = [(i, [float(v) for v in rng.standard_normal(6) * scale - 1.5], 0) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(400)]
    first = check(spark, rows)
    # Sums are exact, so another partitioning gives the same doubles.
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, extra int").repartition(7)
    assert sorted(r[:-1] for r in wh.whiten(vectors).collect()) == sorted(r[:-1] for r in first)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 4.0], 1), (2, [2.0, 0.0, 1.0], 1), (2, [2.0, 0.0, 1.0], 1), (4, [5.0, -0.0, 1.5], 1), (6, [0.5, 3.0, 1.0], 1)]
    bad = [(7, None, 1), (8, [], 1), (9, [nan, 1.0, 1.0], 1), (10, [inf, 1.0, 1.0], 1), (11, [None, 1.0, 1.0], 1), (12, [1.0, 1.0], 1)]
    check(spark, good + bad)
    nameless = spark.createDataFrame([(None, [1.0]), (2**60 + 1, [2.0])], "vec_id long, embedding array<double>")
    assert sorted((r["id"] or 0, r["component"]) for r in wh.whiten(nameless).collect()) == [(0, 1), (2**60 + 1, 1)]


def test_nothing_varies(spark):
    rows = [(i, [1.0, 2.0]) for i in range(3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in wh.whiten(vectors).collect()) == [
        (i, k, 1, 0, None, None, None) for i in range(3) for k in (1, 2)
    ]
    assert wh.whiten(vectors.limit(0)).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in wh.whiten(one).collect())
    assert [r[4] is None for r in got] == [False, True] * 2 and [r[5] for r in got] == [1.0, 0.0] * 2


def test_huge_values(spark):
    rows = [(1, [1e17, 1.0]), (2, [-1e17, 2.0]), (3, [0.0, 1e18])]
    got = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 6 and all(r["deviation"] is None and np.isfinite(r["whitened"]) for r in got)
