"""The named queries, each a function of a session and a source folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..functions.chat import EXPLORATION_LEXICON, FEATURE_LEXICON
from ..operators import charts, dashboards, exploration, mlops, quality
from .slices import training_rows
from .tables import PUBLISHED, Tables

#: Words of the synthetic chat that stand for abuse, for entries whose chat signals are not all zero.
LEXICON = r"(?i)(^|[^a-z])(idiot|clown|trash|moron|scum|the|los|der|les)([^a-z]|$)"
ONE, TWO, MATCH = "1", "2", 7

Query = Callable[[Tables], DataFrame]

EXPLORATION: dict[str, Query] = {
    "q01_class_usage": lambda t: exploration.class_usage(t["summaries_base"]),
    "q02_game_pace": lambda t: exploration.game_pace(t["logs_base"], t["summaries_base"]),
    "q03_head_to_head": lambda t: exploration.head_to_head(t["summaries_base"], t["logs_base"], ONE, TWO),
    "q04_match_breakdown": lambda t: exploration.match_breakdown(t["logs_base"], t["summaries_base"], MATCH),
    "q05_map_specialists": lambda t: exploration.map_specialists(t["summaries_base"], t["logs_base"]),
    "q06_activity_baseline": lambda t: exploration.activity_baseline(t["summaries_base"], t["logs_base"]),
    "q07_coplay_network": lambda t: exploration.coplay_network(t["summaries_base"], t["logs_base"], ONE),
    "q08_form_and_momentum": lambda t: exploration.form_and_momentum(t["summaries_base"], ONE),
    "q09_pair_synergy": lambda t: exploration.pair_synergy(t["summaries_base"], t["logs_base"]),
    "q10_relative_impact": lambda t: exploration.relative_impact(t["summaries_base"], ONE),
    "q11_sentiment_export": lambda t: exploration.sentiment_export(t["summaries_base"], t["logs_base"], t["messages_base"], EXPLORATION_LEXICON),
}
DASHBOARDS: dict[str, Query] = {
    "q12_chat_cohorts": lambda t: dashboards.chat_cohorts(t["serving_player_profiles"]),
    "q13_tilt_hotspots": lambda t: dashboards.tilt_hotspots(t["serving_map_overview_daily"], t.as_of),
    "q14_map_competitiveness": lambda t: dashboards.map_competitiveness(t["serving_map_overview_daily"], t.as_of),
    "q15_tilt_anomalies": lambda t: dashboards.tilt_anomalies(t["serving_map_overview_daily"], t.as_of),
    "q16_quality_trend": lambda t: dashboards.prediction_quality_trend(t["serving_ml_prediction_quality_daily"], t.as_of),
    "q17_quality_latest": lambda t: dashboards.prediction_quality_latest(t["serving_ml_prediction_quality_daily"]),
    "q18_ml_progress": lambda t: dashboards.ml_progress(t["serving_ml_pipeline_progress_daily"], t.as_of),
    "q19_registry_snapshot": lambda t: dashboards.registry_snapshot(t["serving_ml_model_registry"]),
    "q20_player_deep_dive": lambda t: dashboards.player_deep_dive(t["serving_player_match_deep_dive"], t["serving_player_profiles"], t.as_of),
    "q21_profile_percentiles": lambda t: dashboards.profile_percentiles(t["serving_player_profiles"]),
    "q22_synergy_network": lambda t: dashboards.synergy_network(t["serving_player_match_deep_dive"], t["serving_player_profiles"], t.as_of),
}
PACKS: dict[str, Query] = {
    "q23_platform_checks": lambda t: quality.platform_checks(t, t.as_of, drift=True),
    "q24_serving_checks": lambda t: quality.platform_checks(t, t.as_of, serving_only=True),
    "q25_readiness_checks": lambda t: quality.readiness_checks(t["features_player_match"], t["features_player_recent_form"], t["ml_training_dataset_snapshots"], t.as_of),
    "q26_f1_stability": lambda t: mlops.f1_stability(t["ml_model_validation_metrics_daily"], "tilt_risk_baseline", "v2"),
    "q27_1_profile_lookup": lambda t: dashboards.profile_percentiles(t["serving_player_profiles"], ONE, [], ()),
    "q27_2_map_rollup": lambda t: dashboards.map_competitiveness(t["serving_map_overview_daily"], t.as_of),
    "q27_3_hotspot_rollup": lambda t: dashboards.tilt_hotspots(t["serving_map_overview_daily"], t.as_of),
    "q28_recent_runs": lambda t: mlops.recent_runs(t["ops_pipeline_runs"]),
}
TABLES: dict[str, Query] = {
    **{f"t_{n}": (lambda t, n=n: t[n]) for n in PUBLISHED if n not in ("logs_base", "summaries_base", "messages_base")},
    "t_ml_training_player_match": training_rows,
}
CHARTS: dict[str, Query] = {f"c_{n}": (lambda t, s=s: charts.chart(t[s.table], s, t.as_of)) for n, s in charts.CHARTS.items()}
ALL: dict[str, Query] = {**EXPLORATION, **DASHBOARDS, **PACKS, **TABLES, **CHARTS}
#: Queries that are also run with other words, windows or limits, under names with x_: on small synthetic tables the
#: ones above give few rows or zeros.
VARIED: dict[str, Query] = {
    "q09_pair_synergy": lambda t: exploration.pair_synergy(t["summaries_base"], t["logs_base"], min_together=5),
    "q11_sentiment_export": lambda t: exploration.sentiment_export(t["summaries_base"], t["logs_base"], t["messages_base"], LEXICON),
    "q20_player_deep_dive": lambda t: dashboards.player_deep_dive(t["serving_player_match_deep_dive"], t["serving_player_profiles"], t.as_of, days=365),
    "q22_synergy_network": lambda t: dashboards.synergy_network(t["serving_player_match_deep_dive"], t["serving_player_profiles"], t.as_of, days=3650, min_shared=2),
    **{n: ALL[n] for n in ("q12_chat_cohorts", "q13_tilt_hotspots", "q15_tilt_anomalies", "q21_profile_percentiles", "q23_platform_checks", "t_features_player_match", "t_features_player_recent_form", "t_serving_player_profiles", "t_serving_map_overview_daily", "t_serving_player_match_deep_dive")},
}


def run(spark: SparkSession, sf_dir: str, *, query: Query, lexicon: str = FEATURE_LEXICON) -> DataFrame:
    return query(Tables(spark, sf_dir, lexicon))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: partial(run, query=q) for name, q in ALL.items()}
    return out | {f"x_{name}": partial(run, query=q, lexicon=LEXICON) for name, q in VARIED.items()}
