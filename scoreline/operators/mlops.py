"""Training snapshots, model registry, stage changes, promotion gates and their serving tables."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.core import latest_by, rnd, times, union_all, zero
from ..schemas import STAGE_HISTORY
from .features import recent_form
from .serving import FORM

STAGES = ("candidate", "staging", "production", "archived")
METRICS = ("auc", "roc_auc", "f1", "precision", "recall", "rmse", "mae")
#: Gates on a model's own metrics, by model name.
GATES = {
    "win_probability_baseline": (("win_f1", "f1", ">=", 0.66), ("win_brier", "brier", "<=", 0.20)),
    "impact_percentile_baseline": (("impact_rmse", "rmse", "<=", 20.0), ("impact_mae", "mae", "<=", 16.0)),
    "tilt_risk_baseline": (("tilt_f1", "f1", ">=", 0.85), ("tilt_brier", "brier", "<=", 0.02), ("tilt_recall", "recall", ">=", 0.95)),
}
MIN_DAYS, MAX_F1_SPREAD = 7, 0.15


def snapshot_rows(features: DataFrame, form: DataFrame | None, logs: DataFrame, cutoff: datetime.datetime | None = None, columns: list[str] | None = None) -> DataFrame:
    """Training rows up to the cutoff, the newest match by default. The snapshot's id names the cutoff's epoch
    second. Percentiles of impact are by day, nulls first. With ``columns``, columns of ``features``, rows have
    these alone: as matches and form add columns and no rows, neither is planned. Without ``form`` it is made here, from
    the features in the same shuffle by player, and joined to nothing."""
    if cutoff is None:
        cutoff = newest_match(features)
    rows = features.filter(F.col("match_time") <= F.lit(cutoff))
    if columns is not None:
        return rows.select(*columns)
    game = logs.select("logid", "redscore", "bluescore")
    if form is None:
        return training_rows(with_form(features.join(game, "logid", "left")), cutoff, impact_percentile())
    return training_rows(rows.join(game, "logid", "left").join(form.select("steamid", "logid", *FORM_OF_TRAINING), ["steamid", "logid"], "left"), cutoff, impact_percentile())


#: What training rows take of the form.
FORM_OF_TRAINING = ("games_played_to_date", "career_avg_kills", "career_avg_damage", "career_avg_impact", *FORM)


def with_form(rows: DataFrame) -> DataFrame:
    """Player rows with their form, made of them in one shuffle by player."""
    return recent_form(rows, whole=True).select("_row.*", *FORM_OF_TRAINING)


def impact_percentile() -> Column:
    return F.ntile(100).over(Window.partitionBy("match_date").orderBy(F.asc_nulls_first("impact_index"), "logid", "steamid"))


def training_rows(met: DataFrame, cutoff: datetime.datetime, percentile: Column) -> DataFrame:
    """Training rows of player rows up to the cutoff that have scores and form already."""
    red, blue = zero("redscore"), zero("bluescore")
    side = lambda r, b: F.when(F.col("team") == "Red", r).when(F.col("team") == "Blue", b).otherwise(0).cast("long")
    drop = {"won_game", "possible_tilt_label", "classes_played_csv", "redscore", "bluescore", "label_impact_percentile"}
    return met.filter(F.col("match_time") <= F.lit(cutoff)).select(
        F.lit(f"train_{epoch_of(cutoff)}").alias("snapshot_id"),
        F.lit(cutoff).cast("timestamp_ntz").alias("snapshot_cutoff_time"),
        F.lit(cutoff.date()).alias("snapshot_cutoff_date"),
        *[c for c in met.columns if c not in drop],
        side(red, blue).alias("team_score"),
        side(blue, red).alias("opponent_score"),
        side(red - blue, blue - red).alias("score_delta"),
        F.col("won_game").alias("label_win"),
        percentile.alias("label_impact_percentile"),
        F.col("possible_tilt_label").alias("label_tilt"),
    )


def epoch_of(at: datetime.datetime) -> int:
    return int(at.replace(tzinfo=datetime.timezone.utc).timestamp())


def newest_match(features: DataFrame) -> datetime.datetime:
    """When the newest match was; 1970 without any."""
    return features.agg(F.max("match_time")).first()[0] or datetime.datetime(1970, 1, 1)


def snapshot_meta(snapshots: DataFrame) -> DataFrame:
    newest = latest_by(snapshots, ["snapshot_id"], [F.desc("created_at"), F.desc("training_rows")])
    return newest.select("snapshot_id", "snapshot_cutoff_time", "snapshot_cutoff_date", F.col("training_rows").alias("snapshot_training_rows"), F.col("created_at").alias("snapshot_recorded_at"))


def metric(name: str) -> Column:
    return F.get_json_object("metrics_json", f"$.{name}").try_cast("double")


def serving_registry(registry: DataFrame, snapshots: DataFrame, as_of: datetime.date) -> DataFrame:
    with_metrics = registry.withColumns({f"metric_{m}": metric(m) for m in METRICS})
    met = with_metrics.join(snapshot_meta(snapshots), "snapshot_id", "left")
    first = F.coalesce(*[F.when(F.col(f"metric_{m}").isNotNull(), F.lit(m)) for m in METRICS])
    age = lambda *c: F.datediff(F.lit(as_of), F.to_date(F.coalesce(*c)))
    return met.withColumns(
        {
            "is_active": F.coalesce("is_active", F.lit(False)),
            "primary_metric_name": first,
            "primary_metric_value": F.coalesce(*[F.col(f"metric_{m}") for m in METRICS]),
            "data_age_days": age("snapshot_cutoff_time", "created_at"),
            "model_age_days": age("promoted_at", "created_at"),
        }
    )


def pipeline_progress_daily(runs: DataFrame, snapshots: DataFrame, registry: DataFrame, history: DataFrame) -> DataFrame:
    """One row per day on which anything happened; the date spine is the union of all days."""
    mine = runs.filter((F.col("step_name") == "pipeline") | F.col("step_name").startswith("pipeline_")).withColumn("progress_date", F.to_date("started_at"))
    daily = mine.groupBy("progress_date").agg(
        times(F.col("status") == "success").alias("pipeline_success_runs"),
        times(F.col("status") == "failed").alias("pipeline_failed_runs"),
        rnd(F.avg("duration_seconds"), 3).alias("avg_pipeline_duration_seconds"),
        F.max(F.struct("started_at", "run_id", "status"))["status"].alias("latest_pipeline_status"),
    )
    snaps = snapshots.groupBy(F.col("snapshot_cutoff_date").alias("progress_date")).agg(
        F.count("*").alias("snapshots_created"),
        F.sum("training_rows").alias("training_rows_materialised"),
        F.max(F.struct("created_at", "snapshot_id"))["snapshot_id"].alias("latest_snapshot_id"),
        F.max("created_at").alias("latest_snapshot_created_at"),
    )
    at = lambda c, v: times(F.col(c) == v)
    models = registry.groupBy(F.to_date("created_at").alias("progress_date")).agg(F.count("*").alias("models_registered"), *[at("stage", s).alias(f"{s}_models_registered") for s in STAGES[:3]])
    moves = history.groupBy(F.to_date("changed_at").alias("progress_date")).agg(*[at("to_stage", s).alias(f"promotions_to_{s}") for s in ("staging", "production")])
    parts = [daily, snaps, models, moves]
    spine = union_all([p.select("progress_date") for p in parts]).distinct()
    active = registry.agg(times((F.col("stage") == "production") & F.coalesce("is_active", F.lit(False))).alias("active_production_models"))
    for p in parts:
        spine = spine.join(p, "progress_date", "left")
    counted = [c for p in parts for c in p.columns if c not in ("progress_date", "avg_pipeline_duration_seconds", "latest_pipeline_status", "latest_snapshot_id", "latest_snapshot_created_at")]
    return spine.crossJoin(F.broadcast(active)).withColumns(
        {**{c: zero(c) for c in counted}, "avg_pipeline_duration_seconds": F.coalesce("avg_pipeline_duration_seconds", F.lit(0.0)), "latest_pipeline_status": F.coalesce("latest_pipeline_status", F.lit("unknown"))}
    )


def prediction_quality_daily(metrics: DataFrame, registry: DataFrame, snapshots: DataFrame, as_of: datetime.date) -> DataFrame:
    """The registry is reduced to the newest row of each version first, so that metrics never multiply."""
    versions = latest_by(registry, ["model_name", "model_version"], [F.desc("created_at"), F.desc("snapshot_id")]).select("model_name", "model_version", "stage", "is_active")
    met = metrics.join(versions, ["model_name", "model_version"], "left").join(snapshot_meta(snapshots), "snapshot_id", "left")
    keep = [c for c in metrics.columns if c != "created_at"]
    return met.select(
        *keep, "stage", F.coalesce("is_active", F.lit(False)).alias("is_active"), "snapshot_cutoff_date", F.datediff(F.lit(as_of), F.to_date(F.coalesce("snapshot_cutoff_time", "created_at"))).alias("data_age_days")
    )


def f1_stability(metrics: DataFrame, name: str, version: str) -> DataFrame:
    mine = metrics.filter((F.col("model_name") == name) & (F.col("model_version") == version) & F.col("f1").isNotNull())
    return mine.agg(F.countDistinct("progress_date").alias("days"), rnd(F.coalesce(F.stddev_samp("f1"), F.lit(0.0)), 9).alias("f1_stddev"))


def promotion_gates(registry: DataFrame, metrics: DataFrame, name: str, version: str) -> list[tuple[str, str, str, str]]:
    """(gate, status, actual, target) for one model version: lineage, its metrics, and for the tilt model the
    stability of its daily F1. A missing figure fails."""
    mine = registry.filter((F.col("model_name") == name) & (F.col("model_version") == version))
    row = mine.orderBy(F.desc("created_at")).limit(1).select("*", *[metric(m).alias(f"_{m}") for m in ("f1", "brier", "recall", "rmse", "mae")]).first()
    if row is None:
        raise ValueError(f"no such model version: {name}:{version}")
    out = [(f"lineage_{c}", "PASS" if (row[c] or "").strip() else "FAIL", (row[c] or "").strip() or "missing", "required") for c in ("snapshot_id", "training_code_version", "feature_sql_version", "artifact_uri")]
    checks = [(g, row[f"_{m}"], op, t) for g, m, op, t in GATES.get(name, ())]
    if not checks:
        out.append(("unknown_model_gate", "FAIL", name, "unsupported model_name"))
    if name == "tilt_risk_baseline":
        s = f1_stability(metrics, name, version).first()
        checks += [("tilt_daily_days", s.days, ">=", MIN_DAYS), ("tilt_daily_f1_stddev", s.f1_stddev, "<=", MAX_F1_SPREAD)]
    return out + [gate(*c) for c in checks]


def gate_table(registry: DataFrame, metrics: DataFrame) -> DataFrame:
    """(model_name, model_version, gate, status) of all versions at once, each by its newest row: what
    ``promotion_gates`` says of one. Versions of unknown models have lineage gates alone."""
    keys = ["model_name", "model_version"]
    newest = latest_by(registry, keys, [F.desc("created_at"), F.desc("snapshot_id")])
    daily = metrics.filter("f1 is not null").groupBy(*keys).agg(F.countDistinct("progress_date").alias("_days"), F.coalesce(F.stddev_samp("f1"), F.lit(0.0)).alias("_spread"))
    met = newest.join(daily, keys, "left")
    passed = lambda ok: F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL")
    entry = lambda name, ok, on: F.when(on, F.struct(F.lit(name).alias("gate"), passed(ok).alias("status")))
    compare = lambda x, op, t: x >= t if op == ">=" else x <= t
    every = F.lit(True)
    all_ = [entry(f"lineage_{c}", F.nullif(F.trim(c), F.lit("")).isNotNull(), every) for c in ("snapshot_id", "training_code_version", "feature_sql_version", "artifact_uri")]
    for model, gates in GATES.items():
        all_ += [entry(g, compare(metric(m), op, t), F.col("model_name") == model) for g, m, op, t in gates]
    tilt = F.col("model_name") == "tilt_risk_baseline"
    all_ += [entry("tilt_daily_days", zero("_days") >= MIN_DAYS, tilt), entry("tilt_daily_f1_stddev", rnd(zero("_spread"), 9) <= MAX_F1_SPREAD, tilt)]
    gates = F.explode(F.filter(F.array(*all_), lambda g: g.isNotNull())).alias("g")
    return met.select(*keys, gates).select(*keys, "g.gate", "g.status")


def gate(name: str, actual: float | None, op: str, target: float) -> tuple[str, str, str, str]:
    missing = actual is None or math.isnan(actual)
    ok = not missing and (actual >= target if op == ">=" else actual <= target)
    return name, "PASS" if ok else "FAIL", "missing" if missing else str(actual), f"{op} {target}"


def with_stage(registry: DataFrame, name: str, version: str, to: str, now: datetime.datetime) -> DataFrame:
    """The registry with a version in a stage, whatever stage it had. One that goes to production becomes the only
    active one of its model."""
    mine = (F.col("model_name") == name) & (F.col("model_version") == version)
    stamp = F.lit(now).cast(registry.schema["promoted_at"].dataType)
    active = F.when(mine, F.lit(to == "production"))
    if to == "production":
        active = active.when((F.col("model_name") == name) & (F.col("stage") == "production"), F.lit(False))
    return registry.withColumns(
        {
            "promoted_at": F.when(mine & F.lit(to in ("staging", "production")), stamp).otherwise(F.col("promoted_at")),
            "is_active": active.otherwise(F.col("is_active")),
            "stage": F.when(mine, F.lit(to)).otherwise(F.col("stage")),
        }
    )


def change_stage(registry: DataFrame, name: str, version: str, to: str, by: str, reason: str, now: datetime.datetime, metrics: DataFrame | None = None) -> tuple[DataFrame, DataFrame] | None:
    """The registry after the change and the history row to append; None if the version has that stage already.

    A version that goes to production becomes the only active one of its model. With ``metrics`` given, changes
    to staging or production must pass the gates."""
    if to not in STAGES:
        raise ValueError(f"no such stage: {to}")
    mine = (F.col("model_name") == name) & (F.col("model_version") == version)
    row = registry.filter(mine).orderBy(F.desc("created_at")).select("stage").first()
    if row is None:
        raise ValueError(f"no such model version: {name}:{version}")
    if row.stage == to:
        return None
    if metrics is not None and to in ("staging", "production"):
        failed = [g for g in promotion_gates(registry, metrics, name, version) if g[1] == "FAIL"]
        if failed:
            raise ValueError(f"promotion gates failed: {failed}")
    log = registry.sparkSession.createDataFrame([(name, version, row.stage, to, by, reason, now)], STAGE_HISTORY)
    return with_stage(registry, name, version, to, now), log


def rollback_target(registry: DataFrame, name: str) -> str | None:
    """The version to go back to: the one promoted or made last of those that are not active."""
    row = (
        registry.filter((F.col("model_name") == name) & ~F.coalesce("is_active", F.lit(False)) & F.col("stage").isin("staging", "archived", "production"))
        .agg(F.max(F.struct(F.coalesce("promoted_at", "created_at").alias("at"), "model_version"))["model_version"])
        .first()
    )
    return row[0]


def rollback_targets(registry: DataFrame) -> DataFrame:
    """The version of each model to go back to."""
    back = registry.filter(~F.coalesce("is_active", F.lit(False)) & F.col("stage").isin("staging", "archived", "production"))
    return back.groupBy("model_name").agg(F.max(F.struct(F.coalesce("promoted_at", "created_at").alias("at"), "model_version"))["model_version"].alias("model_version"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the keys of ``new``, and ``new``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def recent_runs(runs: DataFrame, top: int = 50) -> DataFrame:
    return runs.select("run_id", "run_mode", "step_name", "status", "started_at", "duration_seconds").orderBy(F.desc("started_at"), "run_id").limit(top)


def log_run(spark: SparkSession, runs_schema: str, **row) -> DataFrame:
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(runs_schema).names
    return spark.createDataFrame([tuple(row.get(n) for n in names)], runs_schema)
