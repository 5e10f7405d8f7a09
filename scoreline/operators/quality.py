"""Quality and readiness packs: lists of checks, each a row with PASS or FAIL.

Fixed values: the checks' names, thresholds and texts, which readers of the packs match on.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import rnd, times, union_all

COLUMNS = ["check_name", "status", "metric_value", "threshold", "details"]


def _row(df: DataFrame, name: str, ok: Column, value: Column, threshold: str, details: str) -> DataFrame:
    status = F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL")
    return df.select(F.lit(name).alias("check_name"), status.alias("status"), value.cast("double").alias("metric_value"), F.lit(threshold).alias("threshold"), F.lit(details).alias("details"))


def _stack(df: DataFrame, checks: list[tuple[str, Column, Column, str, str]]) -> DataFrame:
    """Several checks on one row of figures, turned into rows without reading the figures again."""
    made = F.array(*[F.struct(F.lit(n).alias("check_name"), F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"), v.cast("double").alias("metric_value"), F.lit(t).alias("threshold"), F.lit(d).alias("details")) for n, ok, v, t, d in checks])
    return df.select(F.explode(made).alias("c")).select("c.*")


def _table_checks(df: DataFrame, name: str, keys: list[str], rows: str | None, nulls: str | None, twice: str | None, fresh: tuple[str, str] | None = None, as_of: datetime.date | None = None) -> DataFrame:
    """Row count, null keys, duplicate keys and age of one table, in one pass: rows are counted by key first."""
    n, v = F.col("_n"), lambda c: F.col(c)
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    figures = [F.sum("_c").alias("_n"), F.sum(F.when(null, F.col("_c"))).alias("_null"), times(F.col("_c") > 1).alias("_twice")]
    if fresh:
        figures.append(F.max("_day").alias("_day"))
    day = [F.max(F.col("match_date")).alias("_day")] if fresh else []
    if twice:
        by_key = df.groupBy(*keys).agg(F.count("*").alias("_c"), *day)
    else:
        by_key = df.select(*[F.col(k) for k in keys], F.lit(1).alias("_c"), *([F.col("match_date").alias("_day")] if fresh else []))
    one = by_key.agg(*figures).withColumns({"_n": F.coalesce("_n", F.lit(0)), "_null": F.coalesce("_null", F.lit(0))})
    checks = []
    if rows:
        checks.append((f"{name}_non_empty", n > 0, n, "> 0 rows", rows))
    if nulls:
        checks.append((f"{name}_null_keys", v("_null") == 0, v("_null"), "= 0 rows", nulls))
    if twice:
        checks.append((f"{name}_duplicate_keys", v("_twice") == 0, v("_twice"), "= 0 rows", twice))
    if fresh:
        age = F.datediff(F.lit(as_of), F.col("_day"))
        checks.append((fresh[0], age <= 2, age, "<= 2 days", fresh[1]))
    return _stack(one, checks)


def platform_checks(t: Mapping[str, DataFrame], as_of: datetime.date, drift: bool = False, serving_only: bool = False) -> DataFrame:
    """The gate on core, feature, serving and model tables; ``drift`` adds the check that is off by default."""
    match, form, deep = t["features_player_match"], t["features_player_recent_form"], t["serving_player_match_deep_dive"]
    n = lambda df: df.agg(F.count("*").alias("_n"))
    rows = F.col("_n")
    out = []
    if not serving_only:
        out.append(_row(n(t["logs"]), "core_logs_non_empty", rows > 0, rows, "> 0 rows", "core logs table must not be empty"))
        out.append(_row(n(form), "features_player_recent_form_non_empty", rows > 0, rows, "> 0 rows", "rolling form table must contain rows"))
        orphans = n(form.select("logid", "steamid").join(match.select("logid", "steamid"), ["logid", "steamid"], "left_anti"))
        out.append(_row(orphans, "features_recent_form_orphans", rows == 0, rows, "= 0 rows", "recent-form rows must map to feature rows"))
        out.append(
            _table_checks(match, "features_player_match", ["logid", "steamid"], "feature table must contain match rows", "feature rows must have logid and steamid", "feature table must have one row per (logid, steamid)",
                          ("features_player_match_freshness_days", "features match table should be refreshed recently"), as_of)
        )
    out += [
        _table_checks(t["serving_player_profiles"], "serving_player_profiles", ["steamid"], "player profile serving table must contain rows", "serving player rows must have steamid", None),
        _table_checks(t["serving_map_overview_daily"], "serving_map_overview_daily", ["map", "match_date"], "map overview serving table must contain rows", "serving map rows must have map and match_date", None),
        _deep_checks(deep, as_of),
        _table_checks(t["serving_ml_model_registry"], "serving_ml_model_registry", ["model_name", "model_version"], None, "ml model registry serving rows must have model identifiers", None),
        _table_checks(t["serving_ml_pipeline_progress_daily"], "serving_ml_pipeline_progress", ["progress_date"], None, "ml pipeline progress rows must have progress_date", None),
        _table_checks(t["serving_ml_prediction_quality_daily"], "serving_ml_prediction_quality", ["model_name", "model_version", "progress_date"], None, "prediction quality rows must have model identifiers and progress_date", None),
    ]
    sizes = n(match).withColumnRenamed("_n", "f").crossJoin(n(deep).withColumnRenamed("_n", "s"))
    cover = F.when(F.col("f") == 0, 0.0).otherwise(F.col("s") / F.nullif(F.col("f"), F.lit(0)))
    out.append(_row(sizes, "serving_vs_features_row_coverage", cover >= 0.98, cover, ">= 0.98 ratio", "serving deep-dive coverage should stay close to feature row count"))
    if drift:
        out.append(_drift(match, as_of))
    return union_all(out).orderBy("check_name")


def _deep_checks(deep: DataFrame, as_of: datetime.date) -> DataFrame:
    by_key = deep.groupBy("logid", "steamid").agg(F.count("*").alias("_c"), F.max("match_date").alias("_day"), times(F.col("match_date").isNull() | F.col("logid").isNull() | F.col("steamid").isNull()).alias("_z"))
    one = by_key.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_n"), F.coalesce(F.sum("_z"), F.lit(0)).alias("_z"), times(F.col("_c") > 1).alias("_t"), F.max("_day").alias("_day"))
    age, n, z, t = F.datediff(F.lit(as_of), F.col("_day")), F.col("_n"), F.col("_z"), F.col("_t")
    name = "serving_player_match_deep_dive"
    return _stack(
        one,
        [
            (f"{name}_non_empty", n > 0, n, "> 0 rows", "player match deep-dive serving table must contain rows"),
            (f"{name}_null_keys", z == 0, z, "= 0 rows", "deep-dive serving rows must have logid, steamid, and match_date"),
            (f"{name}_duplicate_keys", t == 0, t, "= 0 rows", "deep-dive serving table must have one row per (logid, steamid)"),
            (f"{name}_freshness_days", age <= 2, age, "<= 2 days", "serving deep-dive table should be refreshed recently"),
        ],
    )


def _drift(match: DataFrame, as_of: datetime.date) -> DataFrame:
    day = lambda n: F.lit(as_of - datetime.timedelta(days=n))
    d = F.col("match_date")
    one = match.agg(F.avg(F.when(d >= day(7), F.col("possible_tilt_label"))).alias("new"), F.avg(F.when((d >= day(35)) & (d < day(7)), F.col("possible_tilt_label"))).alias("old"))
    gap = F.abs(F.col("new") - F.col("old"))
    return _row(one, "tilt_label_recent_drift_abs_delta", gap <= 0.05, rnd(gap, 9), "<= 0.05 absolute delta", "tilt signal drift should remain within expected bounds")


def readiness_checks(match: DataFrame, form: DataFrame, snapshots: DataFrame, as_of: datetime.date) -> DataFrame:
    part = lambda cond: rnd(F.avg(F.when(cond, 1.0).otherwise(0.0)), 6)
    c = F.col
    cover = match.agg(
        F.count("*").alias("rows"), F.countDistinct("steamid").alias("players"), F.countDistinct("match_date").alias("days"), F.countDistinct("map").alias("maps"),
        part(c("impact_index").isNull()).alias("impact"), part(c("kda_ratio").isNull()).alias("kda"), part(c("negative_lexicon_hits") > 0).alias("chat"), rnd(F.avg("possible_tilt_label"), 6).alias("tilt"),
    )
    joined = match.select("logid", "steamid").join(form.select("logid", "steamid", F.lit(1).alias("hit")), ["logid", "steamid"], "left").agg(part(c("hit").isNotNull()).alias("v"))
    veterans = match.groupBy("steamid").agg(F.count("*").alias("n")).agg(part(c("n") >= 20).alias("v"))
    snaps = snapshots.agg(F.count("*").alias("n"), F.datediff(F.lit(as_of), F.max("snapshot_cutoff_date")).alias("age"))
    return union_all(
        [
            _stack(
                cover,
                [
                    ("feature_rows_minimum", c("rows") >= 10000, c("rows"), ">= 10000 rows", "enough feature rows for baseline modelling"),
                    ("distinct_players_minimum", c("players") >= 1000, c("players"), ">= 1000 players", "enough unique players for generalisable training"),
                    ("distinct_days_minimum", c("days") >= 7, c("days"), ">= 7 match days", "minimum temporal coverage for time-aware validation"),
                    ("map_diversity_minimum", c("maps") >= 50, c("maps"), ">= 50 maps", "enough map diversity to reduce map-specific overfit"),
                    ("impact_null_rate", c("impact") <= 0.05, c("impact"), "<= 0.05", "impact feature missingness should stay low"),
                    ("kda_null_rate", c("kda") <= 0.05, c("kda"), "<= 0.05", "KDA missingness should stay low"),
                    ("negative_chat_signal_rate", c("chat") >= 0.005, c("chat"), ">= 0.005", "toxicity model needs non-zero negative-chat signal rows"),
                    ("tilt_label_rate_non_zero", c("tilt") >= 0.005, c("tilt"), ">= 0.005", "tilt label must have enough positive examples"),
                ],
            ),
            _row(joined, "recent_form_join_coverage", c("v") >= 0.995, c("v"), ">= 0.995", "recent-form features should exist for almost all match rows"),
            _row(veterans, "players_with_20_games_rate", c("v") >= 0.2, c("v"), ">= 0.20", "history-heavy models need enough players with stable history"),
            _stack(
                snaps,
                [
                    ("snapshot_exists", c("n") > 0, c("n"), "> 0 snapshots", "at least one immutable training snapshot should be materialised"),
                    ("snapshot_freshness_days", c("age") <= 2, c("age"), "<= 2 days", "latest training snapshot should stay reasonably fresh"),
                ],
            ),
        ]
    ).orderBy("check_name")


def assert_passed(checks: DataFrame) -> None:
    """Raises if any cell of any row says FAIL, whatever its case and blanks around it."""
    strings = [f.name for f in checks.schema if f.dataType.typeName() == "string"]
    bad = F.lit(False)
    for s in strings:
        bad = bad | F.coalesce(F.upper(F.trim(F.col(s))) == "FAIL", F.lit(False))
    failed = checks.filter(bad).limit(20).collect()
    if failed:
        raise AssertionError(f"checks failed: {[r[0] for r in failed]}")
