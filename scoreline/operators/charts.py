"""Chart queries over the serving tables, from a table of what each chart shows."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import ratio, rnd


@dataclass(frozen=True)
class Rows:
    """Plain rows: some columns, a limit, and an order that makes the limit deterministic."""

    table: str
    columns: tuple[str, ...]
    limit: int
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Count:
    """Rows per category."""

    table: str
    by: str


@dataclass(frozen=True)
class Trend:
    """Daily figures over the last ``days`` days; each measure is (name, kind, column), kind sum, avg or weighted."""

    table: str
    date: str
    days: int
    by: tuple[str, ...]
    measures: tuple[tuple[str, str, str], ...]
    limit: int = 5000


PLAYERS, MAPS, DEEP = "serving_player_profiles", "serving_map_overview_daily", "serving_player_match_deep_dive"
REGISTRY, PROGRESS, QUALITY = "serving_ml_model_registry", "serving_ml_pipeline_progress_daily", "serving_ml_prediction_quality_daily"
_MODEL = ("model_name", "model_version")

# Columns and limits that the charts show. Keys only put rows in order, so that a limit takes the same ones.
CHARTS: dict[str, Rows | Count | Trend] = {
    "momentum_snapshot": Rows(
        PLAYERS,
        ("steamid", "games_played", "career_win_rate", "career_avg_impact", "rolling_10_avg_impact", "form_delta_impact", "momentum_label", "tilt_risk_rate", "rolling_10_negative_chat_ratio", "updated_at"),
        100,
        ("steamid",),
    ),
    "momentum_cohorts": Count(PLAYERS, "momentum_label"),
    "impact_vs_tilt": Rows(PLAYERS, ("steamid", "momentum_label", "games_played", "career_avg_impact", "tilt_risk_rate"), 150, ("steamid",)),
    "map_snapshot": Rows(
        MAPS,
        ("match_date", "map", "games", "avg_duration_minutes", "avg_kills_per_minute", "close_game_rate", "blowout_rate", "active_players", "avg_negative_chat_ratio", "tilt_signal_rate"),
        200,
        ("match_date", "map"),
    ),
    "games_by_map": Trend(MAPS, "match_date", 180, ("map",), (("total_games", "sum", "games"),)),
    "match_quality": Trend(MAPS, "match_date", 180, (), (("close_game_rate", "weighted", "close_game_rate"), ("blowout_rate", "weighted", "blowout_rate"))),
    "tilt_snapshot": Rows(
        PLAYERS,
        ("steamid", "momentum_label", "rolling_10_negative_chat_ratio", "tilt_risk_rate", "recent_30_win_rate", "form_delta_impact"),
        120,
        ("steamid",),
    ),
    "chat_snapshot": Rows(MAPS, ("match_date", "map", "games", "avg_negative_chat_ratio", "tilt_signal_rate", "active_players"), 120, ("match_date", "map")),
    "tilt_by_map": Trend(MAPS, "match_date", 90, ("map",), (("avg_tilt_signal_rate", "avg", "tilt_signal_rate"),)),
    "hotspots": Rows(MAPS, ("match_date", "map", "games", "avg_negative_chat_ratio", "tilt_signal_rate"), 300, ("match_date", "map")),
    "deep_dive_rows": Rows(
        DEEP,
        ("match_date", "steamid", "logid", "map", "won_game", "kills", "damage_dealt", "impact_index", "kda_ratio", "negative_chat_ratio", "momentum_label", "behaviour_risk_tier", "impact_tier"),
        250,
        ("match_time", "logid", "steamid"),
    ),
    "impact_trend": Trend(DEEP, "match_date", 120, (), (("avg_impact_index", "avg", "impact_index"), ("avg_negative_chat_ratio", "avg", "negative_chat_ratio"))),
    "risk_split": Count(DEEP, "behaviour_risk_tier"),
    "impact_tiers": Count(DEEP, "impact_tier"),
    "progress_rows": Rows(
        PROGRESS,
        ("progress_date", "pipeline_success_runs", "pipeline_failed_runs", "avg_pipeline_duration_seconds", "latest_pipeline_status", "snapshots_created", "training_rows_materialised", "latest_snapshot_id", "models_registered", "promotions_to_production", "active_production_models"),
        200,
        ("progress_date",),
    ),
    "ml_activity": Trend(PROGRESS, "progress_date", 180, (), (("snapshots_created", "sum", "snapshots_created"), ("models_registered", "sum", "models_registered"), ("promotions_to_production", "sum", "promotions_to_production"))),
    "model_stages": Count(REGISTRY, "stage"),
    "registry_rows": Rows(
        REGISTRY,
        ("model_name", "model_version", "task_type", "stage", "is_active", "snapshot_id", "primary_metric_name", "primary_metric_value", "model_age_days", "data_age_days"),
        300,
        _MODEL,
    ),
    "quality_rows": Rows(
        QUALITY,
        ("progress_date", "model_name", "model_version", "task_type", "stage", "is_active", "rows_total", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier", "rmse", "mae", "data_age_days"),
        300,
        ("progress_date", "model_name", "model_version", "snapshot_id", "rows_total"),
    ),
    "classification_trend": Trend(QUALITY, "progress_date", 180, _MODEL, (("avg_f1", "avg", "f1"), ("avg_roc_auc", "avg", "roc_auc"))),
    "regression_trend": Trend(QUALITY, "progress_date", 180, _MODEL, (("avg_rmse", "avg", "rmse"), ("avg_mae", "avg", "mae"))),
}


def chart(df: DataFrame, spec: Rows | Count | Trend, as_of: datetime.date) -> DataFrame:
    if isinstance(spec, Rows):
        return df.select(*spec.columns).orderBy(*spec.keys).limit(spec.limit)
    if isinstance(spec, Count):
        return df.groupBy(spec.by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), spec.by)
    make = {"sum": F.sum, "avg": lambda c: rnd(F.avg(c), 6), "weighted": lambda c: rnd(ratio(F.sum(F.col(c) * F.col("games")), F.sum("games")), 6)}
    recent = df.filter(F.col(spec.date) >= F.lit(as_of - datetime.timedelta(days=spec.days)))
    return recent.groupBy(spec.date, *spec.by).agg(*[make[k](c).alias(n) for n, k, c in spec.measures]).orderBy(spec.date, *spec.by).limit(spec.limit)


def chart_sql(spec: Count | Trend, as_of: datetime.date, r) -> str:
    """The same in plain SQL; ``r`` gives the rounding expression of the dialect."""
    if isinstance(spec, Count):
        return f"select {spec.by}, count(*) as n from {spec.table} group by {spec.by}"
    make = {"sum": "cast(sum({c}) as bigint)", "avg": r("avg({c})", 6), "weighted": r("sum({c} * games) / nullif(sum(games), 0)", 6)}
    got = ", ".join(f"{make[k].format(c=c)} as {n}" for n, k, c in spec.measures)
    keys = ", ".join([spec.date, *spec.by])
    return f"select {keys}, {got} from {spec.table} where {spec.date} >= date '{as_of - datetime.timedelta(days=spec.days)}' group by {keys} order by {keys} limit {spec.limit}"
