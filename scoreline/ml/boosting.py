"""Gradient-boosted trees over binned features, with second-order gains and an L2 penalty on leaf weights.

A level of a tree is one pass over the rows: each task adds up gradients and hessians by node, feature and bin, Spark
adds the tasks' sums, and the splits of all nodes of the level are chosen from these. What comes to the driver is
nodes times features times bins numbers, whatever the rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import let_workers_import

BINS = 255
#: Trees that rows have not taken up yet; their margins are written into the cached rows after so many.
PENDING = 16
LEAST_HESSIAN = 1e-3


@dataclass
class Tree:
    """By node: the feature asked for or -1, the last bin that goes left, the children, the weight."""

    feature: list[int]
    bin: list[int]
    left: list[int]
    right: list[int]
    weight: list[float]

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        feature, last, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = feature[at]
            go = bins[rows, np.maximum(f, 0)] > last[at]
            at = np.where(f < 0, at, np.where(go, right[at], left[at]))
        return at

    def add(self, bins: np.ndarray, depth: int) -> np.ndarray:
        return np.array(self.weight)[self.nodes(bins, depth)]


@dataclass
class Found:
    """The best split of a node: its gain, where, and the sums (gradient, hessian, rows) of both sides."""

    gain: float
    feature: int
    bin: int
    sides: tuple[tuple[float, float, float], tuple[float, float, float]]


def best_split(cells: np.ndarray, l2: float, least: int) -> Found | None:
    """Of one node's sums (3, features, bins). Among gains that differ by rounding alone the first place counts."""
    below = cells.cumsum(2)
    total = below[:, :, -1:]
    g, h, n = below
    gr, hr, nr = total - below
    score = lambda a, b: a * a / (b + l2)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(g, h) + score(gr, hr) - score(total[0], total[1])
    ok = (n >= least) & (nr >= least) & (h >= LEAST_HESSIAN) & (hr >= LEAST_HESSIAN)
    gain = np.where(ok, gain, -np.inf)
    top = gain.max(initial=-np.inf)
    if not top > 1e-12:
        return None
    f, b = divmod(int(np.flatnonzero(gain.ravel() >= top * (1 - 1e-9))[0]), gain.shape[1])
    return Found(float(gain[f, b]), f, b, (tuple(below[:, f, b].tolist()), tuple((total[:, f, 0] - below[:, f, b]).tolist())))


def grow(sums: Callable[[Tree, list[int]], np.ndarray], depth: int, leaves: int, least: int, l2: float, rate: float) -> Tree | None:
    """A tree, level by level; of its splits those of greatest gain stay, as if the best open leaf were split until
    there are ``leaves``: a node's split does not depend on the others', so that the choice can come afterwards."""
    full, found, open_ = Tree([-1], [0], [-1], [-1], [0.0]), {}, [0]
    for _ in range(depth):
        cells = sums(full, open_)
        new = []
        for node, c in zip(open_, cells):
            if (s := best_split(c, l2, least)) is None:
                continue
            found[node] = s
            full.feature[node], full.bin[node] = s.feature, s.bin
            full.left[node], full.right[node] = len(full.feature), len(full.feature) + 1
            for g, h, _ in s.sides:
                new.append(len(full.feature))
                for column, value in ((full.feature, -1), (full.bin, 0), (full.left, -1), (full.right, -1), (full.weight, -rate * g / (h + l2))):
                    column.append(value)
        open_ = new
        if not open_:
            break
    if 0 not in found:
        return None
    chosen, queue = set(), [(-found[0].gain, 0)]
    while queue and len(chosen) + 1 < leaves:
        _, node = heapq.heappop(queue)
        chosen.add(node)
        for child in (full.left[node], full.right[node]):
            if child in found:
                heapq.heappush(queue, (-found[child].gain, child))
    for node in set(found) - chosen:
        full.feature[node] = -1
    return full


def gradients(y: np.ndarray, margin: np.ndarray, logistic: bool) -> tuple[np.ndarray, np.ndarray]:
    if not logistic:
        return margin - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-margin))
    return p - y, p * (1 - p)


def losses(y: np.ndarray, margin: np.ndarray, logistic: bool) -> np.ndarray:
    return np.logaddexp(0, margin) - y * margin if logistic else 0.5 * (margin - y) ** 2


def to_bins(x: np.ndarray, thresholds: list[list[float]]) -> np.ndarray:
    """The number of thresholds below each value."""
    return np.stack([np.searchsorted(np.array(t, float), x[:, f], "left") for f, t in enumerate(thresholds)], 1).astype(np.uint8).reshape(len(x), len(thresholds))


def _matrix(col: pa.Array) -> np.ndarray:
    return np.array(col.to_pylist(), float).reshape(len(col), -1)


class HistogramBoosting(Estimator):
    """``loss``: logistic, for labels 0 and 1, or squared. With over ``stop_above`` rows a tenth of them, chosen by
    content, is held out, and rounds end when ``patience`` of them have not lowered its loss."""

    def __init__(self, label: str, loss: str = "logistic", rounds: int = 100, rate: float = 0.05, depth: int = 8, leaves: int = 63, least: int = 250, l2: float = 0.1, features: str = "features", bins: int = BINS, stop_above: int | None = 10_000, patience: int = 10):
        super().__init__()
        if loss not in ("logistic", "squared") or not 2 <= bins <= BINS:
            raise ValueError(f"no such loss or number of bins: {loss}, {bins}")
        self.label, self.logistic, self.rounds, self.rate, self.depth, self.leaves = label, loss == "logistic", rounds, rate, depth, leaves
        self.least, self.l2, self.features, self.bins, self.stop_above, self.patience = least, l2, features, bins, stop_above, patience

    def _thresholds(self, rows: DataFrame, width: int) -> list[list[float]]:
        """Values that part the bins: all but the largest of a feature of few, else its quantiles."""
        some = [k / self.bins for k in range(1, self.bins)]
        each = rows.select(F.posexplode("x").alias("f", "v"))
        few = each.groupBy("f").agg(F.count_distinct("v").alias("n"), F.percentile_approx("v", F.array(*map(F.lit, some)), 10_000).alias("q"), F.max("v").alias("top")).collect()
        got = {r.f: sorted({v for v in r.q if v < r.top}) for r in few}
        short = [r.f for r in few if r.n <= self.bins]
        for r in each.filter(F.col("f").isin(short)).groupBy("f").agg(F.sort_array(F.collect_set("v")).alias("v")).collect() if short else []:
            got[r.f] = r.v[:-1]
        return [got.get(f, []) for f in range(width)]

    def _fit(self, df: DataFrame) -> BoostedTrees:
        let_workers_import(df.sparkSession)
        rows = df.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y")).filter("y is not null").persist(StorageLevel.MEMORY_AND_DISK)
        n, mean, width = rows.agg(F.count("*"), F.avg("y"), F.max(F.size("x"))).first()
        if not n:
            raise ValueError("no rows to learn from")
        held = self.stop_above is not None and n > self.stop_above
        base = mean if not self.logistic else math.log(max(mean, 1e-9) / max(1 - mean, 1e-9))
        thresholds = self._thresholds(rows, width)
        tenth = F.pmod(F.xxhash64("x", "y"), F.lit(10)) == 0 if held else F.lit(False)
        data = self._binned(rows.withColumn("held", tenth), thresholds, base).persist(StorageLevel.MEMORY_AND_DISK)
        trees, kept, history = [], 0, []
        for _ in range(self.rounds):
            pending = trees[kept:]
            tree = grow(lambda t, open_, p=pending: self._sums(data, p, t, open_, width, history if len(open_) == 1 and open_[0] == 0 else None), self.depth, self.leaves, self.least, self.l2, self.rate)
            if held and len(history) > self.patience and min(history[-self.patience :]) > history[-self.patience - 1] - 1e-7:
                break
            if tree is None:
                break
            trees.append(tree)
            if len(trees) - kept >= PENDING:
                last, data = data, self._taken_up(data, trees[kept:]).persist(StorageLevel.MEMORY_AND_DISK)
                data.count()
                last.unpersist()
                kept = len(trees)
        data.unpersist()
        rows.unpersist()
        return BoostedTrees(trees, thresholds, base, self.depth, self.logistic, self.features)

    @staticmethod
    def _binned(rows: DataFrame, thresholds: list[list[float]], base: float) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    bins = to_bins(_matrix(b.column(0)), thresholds)
                    packed = pa.array([r.tobytes() for r in bins], pa.binary())
                    yield pa.record_batch([packed, b.column(1), b.column(2), pa.array(np.full(len(bins), base))], ["bins", "y", "held", "margin"])

        return rows.select("x", "y", "held").mapInArrow(run, "bins binary, y double, held boolean, margin double")

    @staticmethod
    def _columns(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        bins = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(b.num_rows, -1)
        return bins, *(b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))

    def _taken_up(self, data: DataFrame, trees: list[Tree]) -> DataFrame:
        depth, columns = self.depth, self._columns

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    bins, _, _, margin = columns(b)
                    yield pa.record_batch([*b.columns[:3], pa.array(margin + sum(t.add(bins, depth) for t in trees))], b.schema.names)

        return data.mapInArrow(run, data.schema)

    def _sums(self, data: DataFrame, pending: list[Tree], tree: Tree, open_: list[int], width: int, history: list[float] | None) -> np.ndarray:
        """(open nodes, 3, features, bins) sums of gradients, hessians and rows; the held-out loss goes to ``history``."""
        depth, logistic, columns, n_bins = self.depth, self.logistic, self._columns, self.bins
        slot = np.full(len(tree.feature), -1)
        slot[open_] = np.arange(len(open_))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells, out, count = np.zeros((3, len(open_) * width * n_bins)), 0.0, 0
            for b in batches:
                if not b.num_rows:
                    continue
                bins, y, held, margin = columns(b)
                margin = margin + sum(t.add(bins, depth) for t in pending)
                out, count = out + float(losses(y[held], margin[held], logistic).sum()), count + int(held.sum())
                g, h = gradients(y, margin, logistic)
                at = slot[tree.nodes(bins, depth)]
                mine = np.flatnonzero((at >= 0) & ~held)
                for f in range(width):
                    place = (at[mine] * width + f) * n_bins + bins[mine, f]
                    for k, w in enumerate((g[mine], h[mine], None)):
                        cells[k] += np.bincount(place, w, cells.shape[1])
            full = np.flatnonzero(cells[2])
            cols = [np.r_[full, -1], *(np.r_[c[full], x] for c, x in zip(cells, (out, float(count), 0.0)))]
            yield pa.record_batch([pa.array(c) for c in cols], ["cell", "g", "h", "n"])

        parts = data.mapInArrow(run, "cell long, g double, h double, n double")
        got = parts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toPandas()
        loss, got = got[got.cell < 0], got[got.cell >= 0]
        if history is not None and len(loss) and loss.h.iloc[0]:
            history.append(loss.g.iloc[0] / loss.h.iloc[0])
        cells = np.zeros((3, len(open_) * width * n_bins))
        cells[:, got.cell.to_numpy()] = got[["g", "h", "n"]].to_numpy().T
        return cells.reshape(3, len(open_), width, n_bins).transpose(1, 0, 2, 3)


class BoostedTrees(Model):
    def __init__(self, trees: list[Tree], thresholds: list[list[float]], base: float, depth: int, logistic: bool, features: str):
        super().__init__()
        self.trees, self.thresholds, self.base, self.depth, self.logistic, self.features = trees, thresholds, base, depth, logistic, features

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, self.thresholds)
        return self.base + sum((t.add(bins, self.depth) for t in self.trees), np.zeros(len(x)))

    def _transform(self, df: DataFrame) -> DataFrame:
        let_workers_import(df.sparkSession)
        margins = self.margins

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(margins(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

        scored = df.withColumn("_margin", margin(vector_to_array(self.features)))
        if not self.logistic:
            return scored.withColumnRenamed("_margin", "prediction")
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return scored.withColumns({"rawPrediction": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))), "probability": array_to_vector(F.array(1 - p, p)), "prediction": (F.col("_margin") > 0).cast("double")}).drop("_margin")

    def facts(self) -> dict:
        return {"trees": [asdict(t) for t in self.trees], "thresholds": self.thresholds, "base": self.base, "depth": self.depth, "logistic": self.logistic, "features": self.features}

    @classmethod
    def of(cls, facts: dict) -> BoostedTrees:
        return cls(**{**facts, "trees": [Tree(**t) for t in facts["trees"]]})
