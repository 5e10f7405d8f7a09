import math
from fractions import Fraction

import numpy as np
import pytest

from scoreline.llm import topk as X


def brute(rows, k):
    ok = []
    for i, v in rows:
        if i is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        ok.append((i, [math.floor(64 * Fraction(c)) for c in v]))
    out = []
    for at, (i, q) in enumerate(ok):
        if i % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, w)), j) for n, (j, w) in enumerate(ok) if n != at and len(w) == len(q))[:k]
            out += [(i, n + 1, j, max(-(2**63), min(2**63 - 1, -v))) for n, (v, j) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    return sorted(map(tuple, X.search(df, F.col("vec_id") % 20 == 0, k).collect()))


@pytest.mark.parametrize("n, dim, kind", [(300, 8, "normal"), (400, 3, "grid"), (30, 4, "normal"), (500, 2, "same")])
def test_against_brute_force(spark, monkeypatch, n, dim, kind):
    """Small shards, leaves and blocks, so that all rounds and ties are met."""
    monkeypatch.setattr(X, "LEAF", 8)
    monkeypatch.setattr(X, "QUERIES", 7)
    rng = np.random.default_rng(n)
    v = rng.normal(size=(n, dim)) if kind == "normal" else rng.integers(-2, 3, (n, dim)) / 64 if kind == "grid" else np.tile([0.5] * dim, (n, 1))
    rows = [(i, list(map(float, x))) for i, x in enumerate(v)]
    assert run(spark, rows) == brute(rows, 20)


def test_edge_cases(spark):
    assert run(spark, []) == []
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (None, [1.0, 1.0]), (20, [1.0]), (40, []), (5, [1.0, -1.0]), (5, [1.0, -1.0]), (6, [1.0, -1.0]), (60, [])]
    assert run(spark, rows) == brute(rows, 20)
    big = [(0, [1e10, 1.0]), (1, [1e4, 1.0]), (2, [-1e4, 1.0])]
    assert run(spark, big) == brute(big, 20)


def test_rows_of_one_id_are_candidates_of_each_other(spark):
    rows = [(20, [1.0, 2.0]), (20, [3.0, -1.0]), (20, [1.0, 2.0]), (3, [0.5, 0.5]), (40, [3.0, -1.0])]
    got = run(spark, rows)
    assert got == brute(rows, 20) and len(got) == 16


def test_huge_components_take_part(spark):
    """Products beyond doubles and longs, and components whose 64-fold is no double."""
    rows = [(20, [1e18, 1.0]), (1, [1.0, 1.0]), (2, [2.0**60, -(2.0**60)]), (3, [1e300, 0.25]), (40, [-1e308, 3e306]), (60, [0.5, 0.25]), (4, [-1e18, 5.0]), (5, [7.0, -3.0])]
    assert run(spark, rows) == brute(rows, 20)
    assert run(spark, rows, 3) == brute(rows, 3)


def tree(n, dim, k=20, seed=0):
    x = np.random.default_rng(seed).integers(-64, 64, (n, dim)).astype(float)
    return X.BallTree(X.build(np.arange(n), np.arange(n), x, k))


def test_tree_bounds_hold():
    t = tree(500, 6)
    q = np.random.default_rng(1).normal(size=(1, 6)) * 64
    inner = t.left >= 0
    assert inner.any() and sorted(t.rid) == list(range(500))
    for lo, hi, c, r in zip(t.lo, t.hi, t.centre, t.radius):
        assert (t.x[lo:hi] @ q[0]).max() <= q[0] @ c + np.linalg.norm(q) * r + 1e-6
    for k in np.flatnonzero(inner):
        a, b = t.left[k], t.left[k] + 1
        assert (t.lo[a], t.hi[b], t.hi[a]) == (t.lo[k], t.hi[k], t.lo[b])


def test_branches_are_cut():
    """Far fewer nodes are visited than there are, and no more when the k-th score comes from elsewhere."""
    rng = np.random.default_rng(0)
    x = np.repeat(rng.normal(size=(64, 4)) * 2000, 64, 0) + rng.normal(size=(4096, 4)) * 3
    t = X.BallTree(X.build(np.arange(4096), np.arange(4096), np.floor(x), 5))
    q = np.floor(x[:32])
    at, score = t.search(np.arange(4096, 4128), q, np.full(32, X.NONE), 5)
    assert (score == -np.sort(-(np.floor(x) @ q.T), axis=0)[:5].T).all()
    alone = t.visited
    assert alone < 0.3 * 32 * len(t.lo)
    t.visited = 0
    t.search(np.arange(4096, 4128), q, score[:, -1].copy(), 5)
    assert t.visited <= alone
    t.visited = 0
    t.search(np.arange(4096, 4128), q, np.sqrt((q**2).sum(1)) * t.far[0] + 2, 5)
    assert not t.visited
