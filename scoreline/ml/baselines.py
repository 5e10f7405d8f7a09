"""Trains the three baselines on a snapshot: models, thresholds, backtests, gates, registry rows and a report."""

from __future__ import annotations

import datetime
import json
import math
import os
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mlops
from ..plans.store import TableStore, retry_on_conflict
from ..schemas import MODEL_REGISTRY, VALIDATION_METRICS, conform
from . import metrics as M
from . import training as T
from .boosting import BoostedTrees

FORM = ["rolling_5_avg_kills", "rolling_10_avg_damage", "rolling_10_avg_impact", "rolling_10_kda_ratio", "rolling_10_win_rate", "rolling_10_negative_chat_ratio", "games_played_to_date"]
CAREER = ["career_avg_kills", "career_avg_damage", "career_avg_impact", "form_delta_kills", "form_delta_damage", "form_delta_impact"]
TEXTS = ["map", "team", "momentum_label"]
#: What is known only after a match, by task.
LEAKS = {
    "win": {"team_score", "opponent_score", "score_delta", "label_win", "label_tilt", "label_impact_percentile"},
    "impact": {"impact_index", "kill_share_of_team", "damage_share_of_team", "healing_share_of_team", "label_impact_percentile", "label_win", "label_tilt"},
    "tilt": {"label_tilt", "label_win", "label_impact_percentile"},
}
THRESHOLDS = [k / 20 for k in range(4, 17)]


@dataclass
class Trained:
    name: str
    task: str
    holdout: dict
    folds: list[dict]
    gates: list[tuple[str, str, str, str]]
    daily: DataFrame
    model: PipelineModel
    threshold: float | None = None
    tables: dict[str, list[dict]] = field(default_factory=dict)

    @property
    def ready(self) -> bool:
        return bool(self.gates) and all(g[1] == "PASS" for g in self.gates)


def _dicts(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def train_classifier(name: str, kind: str, rows: DataFrame, label: str, numbers: list[str], min_precision: float, min_recall: float, snapshot: str, version: str, iterations: int | None = None, min_fold: tuple[int, int] = (20_000, 5_000), depth: int = T.DEPTH) -> Trained:
    T.assert_no_leakage(kind, [*numbers, *TEXTS], LEAKS[kind])

    def fit(train: DataFrame):
        if kind == "tilt":
            pipe, weighted = T.tilt_model(train, numbers, TEXTS, label)
            return pipe.fit(weighted)
        return T.win_model(numbers, TEXTS, label, iterations or T.WIN_ROUNDS, depth).fit(train)

    train, test = T.split_time(rows)
    model, platt = T.fit_calibrated(fit, train, label)
    scored = platt.apply(model.transform(test)).withColumn("y", F.col(label).cast("int")).persist()
    best = _choose(scored, min_precision, min_recall)
    folds = T.backtest(T.temporal_folds(rows, *min_fold), lambda d: (lambda m: lambda v: T.probability(m.transform(v)).withColumn("y", F.col(label).cast("int")))(fit(d)), lambda s: M.binary_metrics(s, best.threshold))
    holdout = M.binary_metrics(scored, best.threshold).first().asDict()
    holdout["ece"] = M.expected_calibration_error(scored).first().ece
    got = Trained(name, "classification", holdout, folds, T.training_gates(name, holdout, folds), M.daily_metrics(scored, name, version, snapshot, "classification", best.threshold), model, best.threshold)
    got.tables = {"thresholds": _dicts(M.threshold_table(scored, THRESHOLDS)), "calibration": _dicts(M.calibration_table(scored)), "by map": _dicts(M.binary_metrics(scored, best.threshold, ["map"], 200))}
    return got


def _choose(scored: DataFrame, min_precision: float, min_recall: float):
    return M.choose_threshold(M.threshold_table(scored, THRESHOLDS), min_precision, min_recall)


def train_regressor(name: str, rows: DataFrame, label: str, numbers: list[str], snapshot: str, version: str, iterations: int | None = None, min_fold: tuple[int, int] = (20_000, 5_000), depth: int = T.DEPTH) -> Trained:
    T.assert_no_leakage("impact", [*numbers, *TEXTS], LEAKS["impact"])
    fit = lambda d: T.impact_model(numbers, TEXTS, label, iterations or T.IMPACT_ROUNDS, depth).fit(d)
    train, test = T.split_time(rows)
    model = fit(train)
    scored = T.clip_percentile(model.transform(test)).withColumn("y", F.col(label).cast("double"))
    folds = T.backtest(T.temporal_folds(rows, *min_fold), lambda d: (lambda m: lambda v: T.clip_percentile(m.transform(v)).withColumn("y", F.col(label).cast("double")))(fit(d)), M.regression_metrics)
    holdout = M.regression_metrics(scored).first().asDict()
    got = Trained(name, "regression", holdout, folds, T.training_gates(name, holdout, folds), M.daily_metrics(scored, name, version, snapshot, "regression"), model)
    got.tables = {"by map": _dicts(M.regression_metrics(scored, ["map"], 200))}
    return got


def train_all(rows: DataFrame, version: str, iterations: int | None = None, min_fold: tuple[int, int] = (20_000, 5_000), depth: int = T.DEPTH) -> list[Trained]:
    """``rows``: one training snapshot, as the snapshot table has it. ``iterations`` and ``depth`` replace
    the models' own, for a quick run."""
    first = rows.select("snapshot_id").first()
    if first is None:
        raise ValueError("the snapshot has no rows")
    sid = first[0]
    chat = ["chat_messages", "avg_message_length", "all_caps_messages", "intense_punctuation_messages", "deaths"]
    return [
        train_classifier("win_probability_baseline", "win", rows, "label_win", FORM + CAREER, 0.5, 0.5, sid, version, iterations, min_fold, depth),
        train_regressor("impact_percentile_baseline", rows, "label_impact_percentile", FORM + CAREER + ["duration_seconds", "classes_played_count"], sid, version, iterations, min_fold, depth),
        train_classifier("tilt_risk_baseline", "tilt", rows, "label_tilt", FORM + chat, 0.6, 0.7, sid, version, iterations, min_fold, depth),
    ]


def save_model(model: PipelineModel, path: str, facts: dict) -> None:
    """Stages one by one: what Spark can write as Spark writes it, the quality stage and the facts as JSON."""
    spark = SparkSession.active()
    stages = []
    for k, s in enumerate(model.stages):
        if isinstance(s, T.FeatureQualityModel):
            stages.append({"quality": {"map_col": s.map_col, "maps": s.maps, "bounds": s.bounds}})
        elif isinstance(s, T.TextsModel):
            stages.append({"texts": {"known": s.known, "ordinal": s.ordinal}})
        elif isinstance(s, BoostedTrees):
            stages.append({"boosted": s.facts()})
        else:
            s.write().overwrite().save(f"{path}/stage-{k}")
            stages.append({"path": f"stage-{k}"})
    spark.createDataFrame([(json.dumps({"stages": stages, "facts": facts}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(path: str) -> tuple[PipelineModel, dict]:
    spark = SparkSession.active()
    meta = json.loads(spark.read.text(f"{path}/metadata").first().value)
    stages = []
    for s in meta["stages"]:
        if "quality" in s:
            q = s["quality"]
            stages.append(T.FeatureQualityModel(q["map_col"], q["maps"], {k: tuple(v) for k, v in q["bounds"].items()}))
        elif "texts" in s:
            known = {c: (mode, values) for c, (mode, values) in s["texts"]["known"].items()}
            stages.append(T.TextsModel(known, s["texts"]["ordinal"]))
        elif "boosted" in s:
            stages.append(BoostedTrees.of(s["boosted"]))
        else:
            stages.append(DefaultParamsReader.loadParamsInstance(f"{path}/{s['path']}", spark))
    return PipelineModel(stages), meta["facts"]


def register(store: TableStore, trained: list[Trained], version: str, snapshot: str, now: datetime.datetime, artifacts: str, code: str = "1", sql: str = "1") -> str:
    """Saves the models, puts candidates into the registry and daily figures into the metrics table (a version's rows
    replace older ones of the same keys), and returns the report."""
    spark, rows = store.spark, []
    for t in trained:
        path = f"{artifacts}/{t.name}/{version}"
        save_model(t.model, path, {"model_name": t.name, "model_version": version, "threshold": t.threshold, "snapshot_id": snapshot})
        rows.append((t.name, version, t.task, "candidate", snapshot, code, sql, path, T.metrics_json({k: float(v) for k, v in t.holdout.items() if isinstance(v, (int, float))}), "platt" if t.task == "classification" else "none", now, None, False))
    new = spark.createDataFrame(rows, MODEL_REGISTRY)
    retry_on_conflict(lambda: store.replace_keys("ml_model_registry", new, ["model_name", "model_version"]))
    for t in trained:
        daily = conform(t.daily.withColumn("created_at", F.lit(now)), VALIDATION_METRICS)
        retry_on_conflict(lambda d=daily: store.replace_keys("ml_model_validation_metrics_daily", d, ["model_name", "model_version", "snapshot_id"]))
    return report(trained, version, snapshot)


def report(trained: list[Trained], version: str, snapshot: str) -> str:
    sections: dict[str, list[dict]] = {"Models": [{"model": t.name, "version": version, "snapshot": snapshot, "ready": t.ready} for t in trained]}
    for t in trained:
        sections[f"{t.name}: hold-out"] = [{k: v for k, v in t.holdout.items() if isinstance(v, (int, float)) and not (isinstance(v, float) and math.isnan(v))}]
        sections[f"{t.name}: gates"] = [dict(zip(("gate", "status", "actual", "target"), g)) for g in t.gates]
        if t.folds:
            sections[f"{t.name}: folds"] = t.folds
        for name, table in t.tables.items():
            if table:
                sections[f"{t.name}: {name}"] = table
    return T.report("Offline evaluation", sections)


def write_report(text: str, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def rollback(store: TableStore, name: str, by: str, reason: str, now: datetime.datetime, version: str | None = None, enforce: bool = True) -> str:
    """Makes an earlier version the production one again; the gates hold for it too, unless told otherwise."""
    base = store.versions("ml_model_registry")[-1]
    registry = store.read("ml_model_registry", base)
    version = version or mlops.rollback_target(registry, name)
    if version is None:
        raise ValueError(f"no version of {name} to go back to")
    gates = store.read("ml_model_validation_metrics_daily") if enforce else None
    done = mlops.change_stage(registry, name, version, "production", by, reason, now, gates)
    if done is None:
        done = mlops.change_stage(registry.withColumn("stage", F.when((F.col("model_name") == name) & (F.col("model_version") == version), "archived").otherwise(F.col("stage"))), name, version, "production", by, reason, now, gates)
    new, log = done
    store.overwrite("ml_model_registry", new, base=base)  # a conflict if another has written it meanwhile
    retry_on_conflict(lambda: store.append("ml_model_stage_history", log))
    return version
