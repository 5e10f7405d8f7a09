import hashlib
import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pandas as pd
import pytest

from scoreline.llm import centroids as X

ROW = "vec_id long, embedding array<double>, at int, id int, cluster int, sums string, wide int"


def plain(rows, dim, k, rounds):
    """The contract word by word, in whole numbers, every distance measured."""
    kept = [(i, [math.floor(Fraction(c) * 1024) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()))[:k]
    centres = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            if mine := [v for (_, v), a in zip(kept, of) if a == j]:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(i, nearest(v)[1], min(X.HIGH, nearest(v)[0])) for i, v in kept], centres


def run(spark, rows, dim, k, rounds):
    df = spark.createDataFrame([(i, v, 1, 2, 3, "x", 4) for i, v in rows], ROW)
    got, centres = X.cluster(df.repartition(5), dim, k, rounds)
    return sorted(map(tuple, got.collect()), key=str), centres


def check(spark, rows, dim, k=4, rounds=4):
    want, centres = plain(rows, dim, k, rounds)
    assert run(spark, rows, dim, k, rounds) == (sorted(want, key=str), centres)


@pytest.mark.parametrize("seed", range(3))
def test_against_every_distance(spark, seed):
    rng = random.Random(seed)
    at = [[rng.uniform(-1, 1) for _ in range(3)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(at)]) for i in range(300)]
    check(spark, rows, 3, k=6, rounds=5)


def test_ties_repeats_and_rows_without_part(spark):
    grid = [(i, [float(i % 3), float(i // 3 % 3)]) for i in range(54)]
    odd = [(100, None), (101, []), (102, [1.0]), (103, [1.0, None]), (104, [math.nan, 0.0]), (105, [0.0, -math.inf]), (None, [0.5, 0.5]), (7, [1.0, 1.0])]
    check(spark, grid + odd, 2, k=5)


def test_components_of_any_size(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([1e300, -1e300, 3e18, -2e9, 1e4, 0.001]), rng.uniform(-1, 1)]) for i in range(40)]
    check(spark, rows, 2, k=4, rounds=3)
    check(spark, [(i, [rng.uniform(-1, 1), 1e307 * (i == 5)]) for i in range(30)], 2, k=3, rounds=3)


def test_fewer_vectors_than_centroids_and_equal_ones(spark):
    check(spark, [(1, [0.0]), (2, [1.0])], 1, k=8)
    check(spark, [(i, [0.25, 0.5]) for i in range(20)], 2, k=8)


def test_scan_stops_early_and_only_strictly_beyond():
    rng = np.random.default_rng(0)
    centres = (np.arange(40)[:, None] * 1000 + np.zeros((1, 4))).astype(int).tolist()
    at = rng.integers(0, 40, 2000)
    x = np.array(centres)[at] + rng.integers(-50, 50, (2000, 4))
    means = X.SortMeans(centres)
    near, far = means.narrow(x, at)
    assert (near == at).all() and means.measured < 3 * len(x)
    # the other centroid lies at exactly twice the distance and is as near, with the smaller number
    means = X.SortMeans([[0], [10]])
    assert means.narrow(np.array([[5]]), np.array([1])) == ([0], [25]) and means.any_size([5], 1) == (0, 25)
    means = X.SortMeans([[0], [11]])
    assert means.narrow(np.array([[6]]), np.array([1]))[0] == [1] and means.measured == 1


def test_bound_of_narrow_components():
    for dim in (1, 64, 1000):
        m = X.narrow(dim)
        assert dim * (2 * m) ** 2 <= 1 << 53
    m = X.narrow(64)
    means = X.SortMeans([[m] * 64, [-m] * 64])
    x = np.array([[m - 1] * 64, [1] + [0] * 63])
    assert means.narrow(x, np.array([1, 1]))[1].tolist() == [64, (m - 1) ** 2 + 63 * m * m]


def test_digits():
    for n in (0, 5, -5, 1 << 60, -(1 << 200) - 7, 10**300):
        assert sum(s << (X.DIGIT * k) for k, s in X._digits(n)) == n


def sql(rows):
    con = duckdb.connect()
    frame = pd.DataFrame({"vec_id": [i for i, _ in rows], "embedding": [v for _, v in rows]})
    con.execute("create table embeddings (vec_id bigint, embedding float[])")
    con.executemany("insert into embeddings values (?, ?)", frame.values.tolist())
    return con.sql(X.SQL["op11_centroids"])


def test_query_and_sql(spark, table_dir):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 5, 0.4) for _ in range(64)]) for i in range(60)] + [(90, None), (91, [1.0] * 63)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, cluster int")
    got = X.op11_centroids(spark, table_dir(embeddings=df))
    want = sql(rows)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}
    by = {r.cluster: r.cluster_inertia for r in got.collect()}
    assert {r.inertia for r in got.collect()} == {sum(by.values())} and got.count() == 60


def test_empty_table(spark, table_dir):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert X.op11_centroids(spark, table_dir(embeddings=df)).collect() == []
