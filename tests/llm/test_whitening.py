import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreline.llm import whitening as X

ROW = "vec_id long, embedding array<double>, component int, n int, part int, dim int, value int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in rows], ROW).repartition(6)


def plain(rows):
    """The contract in full: x, exact deviations, and the eigenvectors of the covariance."""
    kept = [(i, np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept])
    n, s = len(x), [sum(c) for c in x.T.tolist()]
    dev = [min(X.HIGH, sum((n * a - b) ** 2 for a, b in zip(r, s))) for r in x.tolist()]
    y = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x.tolist()])
    e, v = np.linalg.eigh(y.T @ y / n)
    return [i for i, _ in kept], n, dev, y, e[::-1], v[:, ::-1]


def check(spark, rows, most=32):
    df = frame(spark, rows)
    fits = X.fit(df, most)
    got = sorted(X.whiten(df, fits).collect(), key=lambda r: (str(r.vec_id), r.deviation, r.component))
    ids, n, dev, y, e, v = plain(rows)
    k = min(most, y.shape[1])
    order = sorted(range(n), key=lambda i: (str(ids[i]), dev[i]))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [(ids[i], c + 1, n, dev[i]) for i in order for c in range(k)]
    z = np.array([r.whitened for r in got]).reshape(n, k)
    want = (y @ v[:, :k] / np.sqrt(e[:k]))[order]
    assert np.abs(z * np.sign((z * want).sum(0)) - want).max() < 1e-8
    assert np.allclose([r.explained for r in got[:k]], (e / e.sum())[:k], rtol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(0)
    mix = rng.normal(size=(40, 40)) * np.geomspace(1, 0.2, 40)
    rows = [(i, v) for i, v in enumerate((rng.normal(size=(500, 40)) @ mix * 3).tolist())]
    check(spark, rows)
    odd = [(900, None), (901, [1.0] * 39 + [None]), (902, [math.nan] * 40), (903, [math.inf] * 40), (3, rows[3][1]), (None, rows[4][1])]
    df = frame(spark, rows + odd)
    got = X.whiten(df, X.fit(df)).collect()
    assert len(got) == 502 * 32 and {r.n for r in got} == {502}


def test_a_far_mean_and_unlike_scales_keep_their_digits(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) * [3e6, 300, 3] + [1e9, -1e9, 5]
    check(spark, list(enumerate(x.tolist())))


def test_a_hot_id_and_one_partition(spark):
    rng = np.random.default_rng(2)
    check(spark, [(1 if i % 3 else i, v) for i, v in enumerate(rng.normal(size=(60, 5)).tolist())], most=2)


def whitened(spark, rows):
    df = frame(spark, rows)
    return sorted(X.whiten(df, X.fit(df)).collect(), key=lambda r: (r.vec_id, r.component))


def test_no_variance(spark):
    one = whitened(spark, [(1, [0.5, 1.0])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, 0.0), (2, 1, 0, None, None, 0.0)]
    line = whitened(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)])
    assert [r.whitened is None for r in line[:3]] == [False, True, True] and abs(line[0].explained - 1) < 1e-12 and line[1].explained < 1e-12
    assert max(r.identity_error for r in line) < 1e-12


def test_vectors_of_several_dimensions_are_fitted_apart(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(50, 4)).tolist(), rng.normal(size=(40, 2)).tolist()
    got = whitened(spark, [(i, v) for i, v in enumerate(a)] + [(100 + i, v) for i, v in enumerate(b)] + [(300, [])])
    assert {r.n for r in got if r.vec_id < 100} == {50} and {r.n for r in got if r.vec_id >= 100} == {40} and len(got) == 280
    alone = whitened(spark, [(100 + i, v) for i, v in enumerate(b)])
    assert np.allclose(np.abs([r.whitened for r in got if r.vec_id >= 100]), np.abs([r.whitened for r in alone]))


def test_numbers_near_the_end_of_longs(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([6e16, -6e16, 1.0]), rng.uniform(-1, 1)]) for i in range(30)] + [(99, [1e300, 0.0])]
    got = whitened(spark, rows)
    assert {r.n for r in got} == {30} and max(r.deviation for r in got) == X.HIGH and max(r.identity_error for r in got) < 1e-6


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 9))
def test_jacobi(seed, d):
    rng = np.random.default_rng(seed)
    r = np.triu(rng.normal(size=(rng.integers(1, d + 1), d)) * np.geomspace(1, 10.0 ** -rng.integers(0, 8), d))
    length, v = X.jacobi(r)
    u, s, _ = np.linalg.svd(r, full_matrices=False)
    assert np.allclose(v.T @ v, np.eye(d), atol=1e-12) and np.allclose(length[: len(s)], s, rtol=1e-8, atol=1e-12 * s[0])
    a = r @ v
    assert np.abs(a.T @ a - np.diag(length**2)).max() <= 1e-12 * s[0] ** 2


def test_triangles_up_a_tree(spark, monkeypatch):
    monkeypatch.setattr(X, "FANIN", 2)
    monkeypatch.setattr(X, "BLOCK", 7)
    rng = np.random.default_rng(5)
    check(spark, list(enumerate(rng.normal(size=(200, 6)).tolist())))


def test_moments_join():
    z = np.random.default_rng(0).normal(size=(100, 3)) + 5
    n, mean, squares = X._joined(X._moments(z[:30]), X._moments(z[30:]))
    assert n == 100 and np.allclose(mean, z.mean(0)) and np.allclose(squares / n, np.cov(z.T, bias=True))
    again = X._unpack_moments(X._pack_moments((n, mean, squares)))
    assert again[0] == n and (again[1] == mean).all() and (again[2] == squares).all()


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_table(spark, table_dir, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = X.op13_whitening(spark, table_dir(embeddings=df))
    assert got.collect() == []
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
