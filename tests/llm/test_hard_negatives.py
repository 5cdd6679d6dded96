"""Residue products against whole numbers, mined negatives against brute force."""

import numpy as np
import pytest

from sheafline.llm import hard_negatives as hn


@pytest.mark.parametrize(("d", "size"), [(1, 3), (64, 300), (3000, 900), (7, 2**40), (5, 2.0**80), (3, 2.0**600)])
def test_products_are_exact(d, size):
    rng = np.random.default_rng(d)
    left, right = (np.floor(rng.uniform(-size, size, (n, d))) for n in (5, 8))
    got = hn.exact_scores(hn.Side(left), hn.Side(right))
    want = [[sum(int(a) * int(b) for a, b in zip(p, q)) for q in right] for p in left]
    assert got.tolist() == [[max(-hn.MOST, min(hn.MOST, v)) for v in row] for row in want]


def test_zero_and_empty_vectors():
    assert hn.exact_scores(hn.Side(np.zeros((2, 3))), hn.Side(np.zeros((1, 3)))).tolist() == [[0], [0]]
    assert hn.exact_scores(hn.Side(np.zeros((2, 0))), hn.Side(np.zeros((1, 0)))).tolist() == [[0], [0]]


def brute(rows, is_anchor=lambda i: i % 50 == 0):
    rows = [
        (i, x, y, n) for n, (i, x, y) in enumerate(rows)
        if i is not None and x is not None and y is not None and all(v is not None and np.isfinite(v) for v in x)
    ]
    rows = [(i, [int(np.floor(256 * float(np.float32(v)))) for v in x], y, n) for i, x, y, n in rows]
    out = []
    for i, x, y, n in rows:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(x, c)), j, m, z) for j, c, z, m in rows if len(c) == len(x)]
        for score, j, _, _ in sorted(s for s in scored if s[3] == y and s[1] != i)[:5]:
            inside = sorted(s for s in scored if s[3] != y and 50 * -score <= 100 * -s[0] <= 95 * -score)
            out += [(i, j, rank, s[1], -score, -s[0]) for rank, s in enumerate(inside[:3], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted(tuple(r) for r in hn.mine_hard_negatives(vectors, **more).collect())


@pytest.mark.parametrize("tile", [3, 1024])
def test_equals_brute_force(spark, monkeypatch, tile):
    rng = np.random.default_rng(2)
    # Few different values, so that scores tie; one label holds most of the rows.
    rows = [(i, [float(v) for v in rng.integers(0, 4, 3) / 2], int(rng.choice([0, 0, 0, 1, 2]))) for i in range(160)]
    for name in ("TILE_ROWS", "TILE_ANCHORS"):
        monkeypatch.setattr(hn, name, tile)
    monkeypatch.setattr(hn, "SHARD_ROWS", 50)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 2)
    want = brute(rows)
    assert len(want) > 20 and mined(spark, rows) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (3, [1.0, 0.5], 1), (3, [1.0, 0.5], 1), (4, [0.5, 0.5], 2), (5, [0.5, 0.5], 2),
        (6, None, 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 2), (9, [None, 1.0], 2), (10, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (11, [1.0], 1), (12, [], 1), (50, [], 2), (13, [], 1), (100, [-1.0, -1.0], 2),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 0
    assert mined(spark, []) == []
    vectors = spark.createDataFrame([(0, [1.0], 1, 5, 7)], "id long, x array<double>, label long, mark int, score int")
    assert hn.mine_hard_negatives(vectors, "id", "x").collect() == []


def test_parameters(spark):
    rows = [(i, [float(i)], i % 2) for i in range(1, 12)]
    assert mined(spark, rows, anchors="id = 4") == brute(rows, lambda i: i == 4)
