import zlib

import numpy as np
from pyspark.sql import functions as F

from scoreline.llm import toxicity as X


def test_held_out_rows(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), X.held_out().alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.collect())


def test_features_are_words_pairs_and_skips():
    a, b = set(X.indices(b"one two three")), set(X.indices(b"One, two THREE!"))
    assert a == b and len(a) == 6 and len(X.indices(b"")) == 0 and len(X.indices(b"x")) == 1
    assert len(X.indices(b"w " * 100_000)) == 3


def test_learns_a_word():
    m, rng = X.Ftrl(), np.random.default_rng(0)
    for _ in range(600):
        y = int(rng.random() < 0.4)
        w = [f"w{x}" for x in rng.integers(0, 300, 20)] + ["bad"] * y
        m.learn(X.indices(" ".join(w).encode()), y)
    at, w, bias = m.compact()
    full = dict(zip(at, w))
    assert len(at) < 2000 and sum(full.get(i, 0) for i in X.indices(b"w1 bad w2")) + bias > 0 > bias


def test_held_out_accuracy(spark):
    """On labelled rows it has not seen: ranks well, and almost never calls a clean document toxic."""
    d = "/root/testdata/sf0.1"
    got = X.op8_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out").collect()
    y, p = np.array([r.toxic for r in got]), np.array([r.score for r in got])
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]])
    hit = p >= 0.5
    assert auc > 0.95 and (y[hit] == 1).mean() > 0.95 and hit[y == 1].mean() > 0.6
    assert all(r.predicted == int(r.score >= 0.5) for r in got)


def test_labels_of_held_out_rows_do_not_matter(spark, docs):
    rows = [(i, f"text {'bad' if i % 3 == 0 else 'good'} number{i}") for i in range(200)]
    df = docs(*rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = X.fit(df, labels), X.fit(df, flipped)
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist() and a[2] == b[2]


def test_edge_cases(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    df = docs((1, None), (2, ""), (None, "a"), (1, None), clash=True)
    got = X.score(df, X.fit(df, none)).collect()
    assert [r.score for r in got] == [0.5] * 4 and all(r.predicted == 1 for r in got) and not [r for r in got if r.doc_id is None][0].held_out
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (9, 1)], "doc_id long, toxic int")
    assert X.score(docs(), X.fit(df, odd)).count() == 0


def test_ftrl_against_plain_loops():
    """The published update, coordinate by coordinate."""
    rng, dim, l1 = np.random.default_rng(2), 50, 0.3
    m = X.Ftrl(dim, l1)
    z, n = [0.0] * (dim + 1), [0.0] * (dim + 1)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((X.BETA + n[i] ** 0.5) / X.ALPHA + X.L2)

    for _ in range(300):
        x, y = sorted(rng.choice(dim, 6, replace=False).tolist()), int(rng.random() < 0.5)
        m.learn(np.array(x), y)
        old = {i: weight(i) for i in [*x, dim]}
        g = (1 / (1 + np.exp(-sum(old.values()))) - y) * (X.POSITIVE if y else 1.0)
        for i, w in old.items():
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / X.ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    at, w, bias = m.compact()
    want = [weight(i) for i in range(dim + 1)]
    assert at.tolist() == [i for i in range(dim) if want[i]] and np.allclose(w, [want[i] for i in at]) and abs(bias - want[dim]) < 1e-9


def test_features_learned_from_are_bounded(spark, docs):
    """As many rows, in the order of a hash, as their features have room; repeated documents count too."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40)) + (" bad" if i % 2 else "")) for i in range(60)]
    df = docs(*rows, *rows[:10])
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    seen = []
    plain = X.Ftrl.learn
    try:
        X.Ftrl.learn = lambda self, i, y: seen.append(len(i)) or plain(self, i, y)
        X.fit(df, labels, epochs=1, most_features=1000)
        bounded = list(seen)
        seen.clear()
        X.fit(df, labels, epochs=1, most=7)
    finally:
        X.Ftrl.learn = plain
    assert 0 < sum(bounded) <= 1000 and len(seen) == 7
