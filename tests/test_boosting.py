"""Histogram boosting against a plain one in memory."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from scoreline.ml import boosting as X


def data(n=700, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 40, n) / 4, rng.integers(0, 3, n)]).astype(float)
    z = 0.5 * (x[:, 0] > 6) + np.sin(x[:, 1]) + 0.3 * x[:, 2] * (x[:, 0] < 4) + rng.normal(0, 0.4, n)
    return x, z, (z > 0.4).astype(float)


def frame(spark, x, y):
    rows = [([float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "x array<double>, y double").select(array_to_vector("x").alias("features"), "y").repartition(5)


def plain(x, y, logistic, rounds, rate, depth, leaves, least, l2):
    """Every value of every feature tried, the best open leaf split until there are enough; the losses by round."""
    m = np.full(len(y), math.log(y.mean() / (1 - y.mean())) if logistic else y.mean())
    loss = [X.losses(y, m, logistic).mean()]
    for _ in range(rounds):
        g, h = X.gradients(y, m, logistic)

        def split(rows):
            best, s = None, lambda r: g[r].sum() ** 2 / (h[r].sum() + l2)
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    a, b = rows[x[rows, f] <= v], rows[x[rows, f] > v]
                    if min(len(a), len(b)) >= least and (gain := s(a) + s(b) - s(rows)) > 1e-12 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = gain, a, b
            return best

        open_ = [(split(np.arange(len(y))), np.arange(len(y)), 0)]
        while len(open_) < leaves and any(s and d < depth for s, _, d in open_):
            k = max((k for k, (s, _, d) in enumerate(open_) if s and d < depth), key=lambda k: open_[k][0][0])
            (_, a, b), _, d = open_.pop(k)
            open_ += [(split(a), a, d + 1), (split(b), b, d + 1)]
        for _, rows, _ in open_:
            m[rows] -= rate * g[rows].sum() / (h[rows].sum() + l2) if len(open_) > 1 else 0
        loss.append(X.losses(y, m, logistic).mean())
    return m, loss


@pytest.mark.parametrize("loss, depth, leaves, l2", [("logistic", 3, 5, 0.1), ("squared", 4, 63, 0.1), ("squared", 2, 4, 50.0)])
def test_against_a_plain_one(spark, monkeypatch, loss, depth, leaves, l2):
    monkeypatch.setattr(X, "PENDING", 2)
    x, z, y = data()
    t = y if loss == "logistic" else z
    m = X.HistogramBoosting("y", loss, 5, 0.3, depth, leaves, 25, l2).fit(frame(spark, x, t))
    want, losses = plain(x, t, loss == "logistic", 5, 0.3, depth, leaves, 25, l2)
    assert np.abs(m.margins(x) - want).max() < 1e-6
    assert abs(X.losses(t, m.margins(x), loss == "logistic").mean() - losses[-1]) < 1e-6 < losses[0] - losses[-1]
    assert all(1 <= sum(f >= 0 for f in tree.feature) < leaves for tree in m.trees)
    again = X.BoostedTrees.of(m.facts())
    assert (again.margins(x) == m.margins(x)).all()
    scored = again.transform(frame(spark, x, t)).select(vector_to_array("features").alias("x"), "prediction", *([vector_to_array("probability")[1].alias("p"), vector_to_array("rawPrediction")[1].alias("r")] if loss == "logistic" else []))
    for r in scored.limit(50).collect():
        margin = m.margins(np.array([r.x]))[0]
        if loss == "logistic":
            assert abs(r.p - 1 / (1 + math.exp(-margin))) < 1e-12 and abs(r.r - margin) < 1e-12 and r.prediction == float(margin > 0)
        else:
            assert abs(r.prediction - margin) < 1e-12


def test_penalty_and_least_rows(spark):
    """One split of one feature: the leaf weights are those of the penalised sums."""
    x, y = np.array([[0.0]] * 30 + [[1.0]] * 30), np.array([0.0] * 30 + [2.0] * 30)
    m = X.HistogramBoosting("y", "squared", 1, 1.0, 1, 2, 30, 10.0).fit(frame(spark, x, y))
    assert m.margins(np.array([[0.0], [1.0]])).tolist() == [1 - 30 / 40, 1 + 30 / 40]
    assert X.HistogramBoosting("y", "squared", 1, 1.0, 1, 2, 31, 0.0).fit(frame(spark, x, y)).trees == []


def test_rounds_end_when_the_held_out_loss_does_not_fall(spark):
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 50, (600, 2)).astype(float), rng.integers(0, 2, 600).astype(float)
    m = X.HistogramBoosting("y", rounds=60, rate=0.5, depth=3, least=5, stop_above=100, patience=3).fit(frame(spark, x, y))
    assert 1 <= len(m.trees) < 30


def test_many_values_become_quantile_bins(spark):
    x = np.arange(3000.0)[:, None]
    m = X.HistogramBoosting("y", "squared", 1, 1.0, 1, 2, 100, 0.0, bins=16).fit(frame(spark, x, (x[:, 0] > 1500).astype(float)))
    assert len(m.thresholds[0]) == 15 and abs(m.thresholds[0][7] - 1500) < 20
    with pytest.raises(ValueError):
        X.HistogramBoosting("y", bins=300)
    with pytest.raises(ValueError, match="no rows"):
        X.HistogramBoosting("y").fit(frame(spark, x, x[:, 0]).limit(0))


def test_best_split_takes_the_first_of_equal_ones():
    cells = np.zeros((3, 2, 3))
    cells[0, :] = [1, -1, 0]
    cells[1:, :] = [1, 1, 0]
    got = X.best_split(cells, 0.0, 1)
    assert (got.feature, got.bin) == (0, 0)
    assert X.best_split(np.zeros((3, 0, 3)), 0.0, 1) is None
