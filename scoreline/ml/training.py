"""Baseline models on training snapshots: splits, feature quality, pipelines, calibration, backtests, gates."""

from __future__ import annotations

import json
import math
import statistics
from collections.abc import Callable, Iterable
from fractions import Fraction

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.mlops import gate
from .boosting import HistogramBoosting

OTHER, MISSING = "__OTHER__", "__MISSING__"
#: Rounds and depth of the models.
WIN_ROUNDS, IMPACT_ROUNDS, TILT_ROUNDS, DEPTH = 320, 350, 300, 8
FOLDS = (("fold_60_10", 0.6, 0.1), ("fold_70_10", 0.7, 0.1), ("fold_80_20", 0.8, 0.2))


def numbered(df: DataFrame) -> DataFrame:
    """``_at``: the place of each row by time, from 0. Rows are counted per day first and ranked within their day, so
    that no single task sorts everything."""
    day = F.to_date("match_time")
    before = df.groupBy(day.alias("_day")).agg(F.count("*").alias("_c")).selectExpr("_day", "sum(_c) over (order by _day) - _c as _before")
    w = Window.partitionBy("_day").orderBy("match_time", "logid", "steamid")
    return df.withColumn("_day", day).join(F.broadcast(before) if before.count() < 100_000 else before, "_day").withColumn("_at", F.col("_before") + F.row_number().over(w) - 1).drop("_day", "_before")


def part_of(n: int, ratio: float) -> int:
    """The whole rows in a part of n, by the ratio's decimal digits: as doubles, 0.7 of 10 * k rows can lose a row."""
    return int(n * Fraction(str(ratio)))


def split_time(df: DataFrame, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The first part by time and the rest; both hold a row at least."""
    n = df.count()
    cut = max(1, min(n - 1, part_of(n, ratio)))
    rows = numbered(df)
    return rows.filter(F.col("_at") < cut).drop("_at"), rows.filter(F.col("_at") >= cut).drop("_at")


def temporal_folds(df: DataFrame, min_train: int = 20_000, min_val: int = 5_000) -> list[tuple[str, DataFrame, DataFrame]]:
    n, rows, out = df.count(), numbered(df), []
    for name, a, b in FOLDS:
        end = part_of(n, a)
        last = min(n, end + part_of(n, b))
        if end >= min_train and last - end >= min_val:
            out.append((name, rows.filter(F.col("_at") < end).drop("_at"), rows.filter((F.col("_at") >= end) & (F.col("_at") < last)).drop("_at")))
    return out


def assert_no_leakage(task: str, used: Iterable[str], barred: Iterable[str]) -> None:
    if both := sorted(set(used) & set(barred)):
        raise RuntimeError(f"{task} uses features that leak what it predicts: {', '.join(both)}")


class FeatureQuality(Estimator):
    """Learns frequent maps and 1% and 99% quantiles; rare maps become one, numbers are clipped."""

    def __init__(self, numbers: list[str], map_col: str = "map", min_count: int = 100, low: float = 0.01, high: float = 0.99):
        super().__init__()
        self.numbers, self.map_col, self.min_count, self.low, self.high = numbers, map_col, min_count, low, high

    def _fit(self, df: DataFrame) -> FeatureQualityModel:
        maps = df.groupBy(F.coalesce(self.map_col, F.lit(MISSING)).alias("m")).count().filter(F.col("count") >= self.min_count)
        bounds = df.agg(*[F.percentile(c, F.array(F.lit(self.low), F.lit(self.high))).alias(c) for c in self.numbers]).first()
        return FeatureQualityModel(self.map_col, [r.m for r in maps.collect()], {c: tuple(bounds[c]) for c in self.numbers if bounds[c] is not None})


class FeatureQualityModel(Model):
    def __init__(self, map_col: str, maps: list[str], bounds: dict[str, tuple[float, float]]):
        super().__init__()
        self.map_col, self.maps, self.bounds = map_col, maps, bounds

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {c: F.when(F.col(c).isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), F.col(c).cast("double")))) for c, (lo, hi) in self.bounds.items()}
        if self.maps:
            m = F.coalesce(self.map_col, F.lit(MISSING))
            out[self.map_col] = F.when(m.isin(self.maps), m).otherwise(OTHER)
        return df.withColumns(out)


class Texts(Estimator):
    """Learns the values of text columns. A missing one becomes the most frequent; as ``ordinal`` each becomes its
    place in order of the values, one not seen before -1."""

    def __init__(self, columns: list[str], ordinal: bool):
        super().__init__()
        self.columns, self.ordinal = columns, ordinal

    def _fit(self, df: DataFrame) -> TextsModel:
        known = {}
        for c in self.columns:
            n = {r[0]: r[1] for r in df.filter(F.col(c).isNotNull()).groupBy(c).count().collect()}
            known[c] = (min(n, key=lambda v: (-n[v], v)) if n else None, sorted(n))
        return TextsModel(known, self.ordinal)


class TextsModel(Model):
    def __init__(self, known: dict[str, tuple[str | None, list[str]]], ordinal: bool):
        super().__init__()
        self.known, self.ordinal = known, ordinal

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (mode, values) in self.known.items():
            filled = F.coalesce(F.col(c), F.lit(mode).cast("string"))
            out[c] = filled
            if self.ordinal:
                place = F.array_position(F.lit(values).cast("array<string>"), filled).cast("double") - 1
                out[f"{c}_i"] = F.coalesce(place, F.lit(-1.0))
        return df.withColumns(out)


def preprocess(numbers: list[str], texts: list[str], linear: bool) -> list:
    """Median for missing numbers, the most frequent for missing texts. Trees get texts by place, -1 for one not seen
    before; linear models get scaled numbers and one column per text, none of them for one not seen before."""
    stages = [Imputer(strategy="median", inputCols=numbers, outputCols=[f"{c}_n" for c in numbers]), Texts(texts, not linear)]
    if not linear:
        return [*stages, VectorAssembler(inputCols=[f"{c}_n" for c in numbers] + [f"{c}_i" for c in texts], outputCol="features")]
    return [
        *stages,
        *(StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in texts),
        OneHotEncoder(inputCols=[f"{c}_i" for c in texts], outputCols=[f"{c}_o" for c in texts], dropLast=False),
        VectorAssembler(inputCols=[f"{c}_n" for c in numbers], outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True),
        VectorAssembler(inputCols=["_scaled"] + [f"{c}_o" for c in texts], outputCol="features"),
    ]


def win_model(numbers: list[str], texts: list[str], label: str = "label_win", iterations: int = WIN_ROUNDS, depth: int = DEPTH, l2: float | None = None) -> Pipeline:
    """With ``l2`` the trees are those of ``boosting``, which know such a penalty; else Spark's own, without one."""
    trees = GBTClassifier(labelCol=label, stepSize=0.05, maxIter=iterations, maxDepth=depth, minInstancesPerNode=250, maxBins=64, seed=42)
    if l2 is not None:
        trees = HistogramBoosting(label, "logistic", iterations, depth=depth, l2=l2)
    return Pipeline(stages=[FeatureQuality(numbers, min_count=120), *preprocess(numbers, texts, False), trees])


def impact_model(numbers: list[str], texts: list[str], label: str = "label_impact_percentile", iterations: int = IMPACT_ROUNDS, depth: int = DEPTH, l2: float | None = None) -> Pipeline:
    trees = GBTRegressor(labelCol=label, stepSize=0.05, maxIter=iterations, maxDepth=depth, minInstancesPerNode=250, maxBins=64, seed=42)
    if l2 is not None:
        trees = HistogramBoosting(label, "squared", iterations, depth=depth, l2=l2)
    return Pipeline(stages=[FeatureQuality(numbers, min_count=120), *preprocess(numbers, texts, False), trees])


def tilt_model(train: DataFrame, numbers: list[str], texts: list[str], label: str = "label_tilt", c: float = 0.15) -> tuple[Pipeline, DataFrame]:
    """Balanced logistic regression: the training frame comes back with the weights of its classes."""
    n, pos = train.agg(F.count("*"), F.sum(label)).first()
    pos = pos or 0
    weight = F.when(F.col(label) == 1, n / (2.0 * max(pos, 1))).otherwise(n / (2.0 * max(n - pos, 1)))
    lr = LogisticRegression(labelCol=label, weightCol="_weight", regParam=1.0 / (c * max(n, 1)), maxIter=TILT_ROUNDS)
    return Pipeline(stages=[FeatureQuality(numbers, min_count=120), *preprocess(numbers, texts, True), lr]), train.withColumn("_weight", weight)


def probability(scored: DataFrame, name: str = "p") -> DataFrame:
    return scored.withColumn(name, vector_to_array("probability")[1])


class Platt:
    """Logistic calibration of raw margins on held-back rows; the identity where there are too few or one class."""

    def __init__(self, model=None):
        self.model = model

    @classmethod
    def fit(cls, scored: DataFrame, label: str, min_rows: int = 300) -> Platt:
        n, kinds = scored.agg(F.count("*"), F.countDistinct(label)).first()
        if n < min_rows or kinds < 2:
            return cls()
        margin = cls._margin(scored)
        return cls(LogisticRegression(featuresCol="_m", labelCol=label).fit(margin.select("_m", label)))

    @staticmethod
    def _margin(scored: DataFrame) -> DataFrame:
        raw = scored.withColumn("_raw", vector_to_array("rawPrediction")[1])
        return VectorAssembler(inputCols=["_raw"], outputCol="_m").transform(raw)

    def apply(self, scored: DataFrame) -> DataFrame:
        if self.model is None:
            return probability(scored)
        drop = ["probability", "rawPrediction", "prediction"]
        return probability(self.model.transform(self._margin(scored).drop(*drop)))


def fit_calibrated(fit: Callable[[DataFrame], Model], train: DataFrame, label: str, fraction: float = 0.15, least: int = 2000) -> tuple[Model, Platt]:
    """The model on the first rows by time and its calibration on the last ``fraction`` of them."""
    n = train.count()
    if n < least:
        return fit(train), Platt()
    head, tail = split_time(train, 1 - fraction)
    model = fit(head)
    return model, Platt.fit(model.transform(tail), label)


def clip_percentile(scored: DataFrame) -> DataFrame:
    return scored.withColumn("p", F.greatest(F.lit(1.0), F.least(F.lit(100.0), F.col("prediction"))))


def permutation_importance(score: Callable[[DataFrame], float], rows: DataFrame, columns: list[str], sample: int = 5000, repeats: int = 2, seed: int = 42, top: int = 12) -> list[tuple[str, float]]:
    """How much the score falls when one column is shuffled, on at most ``sample`` rows by a seeded hash."""
    base = rows.orderBy(F.xxhash64("logid", "steamid", F.lit(seed))).limit(sample).withColumn("_i", F.row_number().over(Window.orderBy(F.xxhash64("logid", "steamid", F.lit(seed))))).persist()
    try:
        whole, out = score(base), []
        for c in columns:
            drops = []
            for r in range(repeats):
                mixed = base.select(F.col(c).alias("_v"), F.row_number().over(Window.orderBy(F.xxhash64("_i", F.lit(seed + r)))).alias("_i"))
                drops.append(whole - score(base.drop(c).join(mixed, "_i").withColumnRenamed("_v", c)))
            out.append((c, statistics.fmean(drops)))
        return sorted(out, key=lambda x: -x[1])[:top]
    finally:
        base.unpersist()


def fold_metric(values: list[float | None], how: str) -> float:
    """min, max or sample spread over folds; NaN without values, spread 0 of one."""
    got = [v for v in values if v is not None and not math.isnan(v)]
    if not got:
        return math.nan
    return min(got) if how == "min" else max(got) if how == "max" else statistics.stdev(got) if len(got) > 1 else 0.0


#: Gates on hold-out and backtest figures: (name, metric, fold statistic or None, comparison, target).
TRAINING_GATES = {
    "win_probability_baseline": (("f1", "f1", None, ">=", 0.66), ("brier", "brier", None, "<=", 0.20), ("min_fold_f1", "f1", "min", ">=", 0.60)),
    "impact_percentile_baseline": (("rmse", "rmse", None, "<=", 20.0), ("mae", "mae", None, "<=", 16.0), ("max_fold_rmse", "rmse", "max", "<=", 22.0)),
    "tilt_risk_baseline": (("f1", "f1", None, ">=", 0.85), ("brier", "brier", None, "<=", 0.02), ("recall", "recall", None, ">=", 0.95), ("fold_f1_stddev", "f1", "std", "<=", 0.03)),
}


def training_gates(model: str, holdout: dict[str, float], folds: list[dict[str, float]]) -> list[tuple[str, str, str, str]]:
    return [gate(name, fold_metric([f.get(m) for f in folds], how) if how else holdout.get(m), op, target) for name, m, how, op, target in TRAINING_GATES[model]]


def backtest(folds: list[tuple[str, DataFrame, DataFrame]], fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], evaluate: Callable[[DataFrame], DataFrame]) -> list[dict]:
    """A model per fold, scored on the fold's later rows. ``fit`` gives a function that scores a frame."""
    return [{"fold": name, **evaluate(fit(train)(val)).first().asDict()} for name, train, val in folds]


def metrics_json(values: dict[str, float | None]) -> str:
    """Figures as JSON; what is undefined is null, as NaN is no JSON."""
    return json.dumps({k: None if v is None or (isinstance(v, float) and math.isnan(v)) else v for k, v in values.items()})


def markdown_table(rows: list[dict], columns: list[str] | None = None) -> str:
    columns = columns or (list(rows[0]) if rows else [])
    show = lambda v: "-" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{v:.4f}" if isinstance(v, float) else str(v)
    return "\n".join(["| " + " | ".join(columns) + " |", "| " + " | ".join("---" for _ in columns) + " |", *["| " + " | ".join(show(r.get(c)) for c in columns) + " |" for r in rows]])


def report(title: str, sections: dict[str, list[dict]]) -> str:
    return "\n\n".join([f"# {title}", *[f"## {name}\n\n{markdown_table(rows)}" for name, rows in sections.items()]]) + "\n"
