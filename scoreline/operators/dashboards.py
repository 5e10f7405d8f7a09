"""Dashboard queries over the serving tables. ``as_of`` stands for today."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import ratio, rnd, share, times


def _since(df: DataFrame, as_of: datetime.date, days: int, col: str = "match_date") -> DataFrame:
    """A literal bound, which is pushed down to the scan."""
    return df.filter(F.col(col) >= F.lit(as_of - datetime.timedelta(days=days)))


def resolve_player(profiles: DataFrame, player: str | None) -> DataFrame:
    """One row: the given player, else the one seen last (of several, the smallest id)."""
    if player is not None:
        return profiles.sparkSession.range(1).select(F.lit(player).alias("target_steamid"))
    return profiles.orderBy(F.desc("last_seen_at"), "steamid").limit(1).select(F.col("steamid").alias("target_steamid"))


def chat_cohorts(profiles: DataFrame, tilt: float = 0.12, negative: float = 0.08) -> DataFrame:
    risky = (F.col("tilt_risk_rate") >= tilt) | (F.col("rolling_10_negative_chat_ratio") >= negative)
    return (
        profiles.groupBy("momentum_label")
        .agg(
            F.count("*").alias("players"),
            times(risky).alias("high_risk_players"),
            rnd(ratio(times(risky), F.count("*")), 4).alias("high_risk_player_rate"),
            rnd(F.avg("tilt_risk_rate"), 4).alias("avg_tilt_risk_rate"),
            rnd(F.avg("rolling_10_negative_chat_ratio"), 4).alias("avg_rolling_negative_chat_ratio"),
        )
        .orderBy(F.desc("high_risk_player_rate"), F.desc("players"), "momentum_label")
    )


def tilt_hotspots(maps: DataFrame, as_of: datetime.date, days: int = 14, min_games: int = 10) -> DataFrame:
    return (
        _since(maps, as_of, days)
        .groupBy("map")
        .agg(
            F.count("*").alias("days_observed"),
            F.sum("games").alias("total_games"),
            rnd(F.avg("avg_negative_chat_ratio"), 4).alias("avg_negative_chat_ratio"),
            rnd(F.max("avg_negative_chat_ratio"), 4).alias("peak_negative_chat_ratio"),
            rnd(F.avg("tilt_signal_rate"), 4).alias("avg_tilt_signal_rate"),
            rnd(F.max("tilt_signal_rate"), 4).alias("peak_tilt_signal_rate"),
        )
        .filter(F.col("total_games") >= min_games)
        .orderBy(F.desc("avg_tilt_signal_rate"), F.desc("avg_negative_chat_ratio"), F.desc("total_games"), "map")
    )


def map_competitiveness(maps: DataFrame, as_of: datetime.date, days: int = 30, min_games: int = 10) -> DataFrame:
    """Rates are weighted by games, the other figures are means of days."""
    weighted = lambda c: ratio(F.sum(F.col(c) * F.col("games")), F.sum("games"))
    close, blow = weighted("close_game_rate"), weighted("blowout_rate")
    return (
        _since(maps, as_of, days)
        .groupBy("map")
        .agg(
            F.count("*").alias("days_observed"),
            F.sum("games").alias("total_games"),
            F.sum("active_players").alias("total_active_players"),
            rnd(F.avg("avg_duration_minutes"), 3).alias("avg_duration_minutes"),
            rnd(F.avg("avg_total_kills"), 3).alias("avg_total_kills"),
            rnd(F.avg("avg_kills_per_minute"), 3).alias("avg_kills_per_minute"),
            rnd(close, 4).alias("close_game_rate"),
            rnd(blow, 4).alias("blowout_rate"),
            rnd(close - blow, 4).alias("competitiveness_index"),
            rnd(F.avg("avg_player_impact_index"), 4).alias("avg_player_impact_index"),
            rnd(F.avg("avg_negative_chat_ratio"), 4).alias("avg_negative_chat_ratio"),
            rnd(F.avg("tilt_signal_rate"), 4).alias("tilt_signal_rate"),
        )
        .filter(F.col("total_games") >= min_games)
        .orderBy(F.desc("competitiveness_index"), F.desc_nulls_last("avg_kills_per_minute"), F.desc("total_games"), "map")
    )


def tilt_anomalies(maps: DataFrame, as_of: datetime.date, history: int = 90, recent: int = 14, min_games: int = 15) -> DataFrame:
    """Recent means against the baseline's mean and spread, in one pass over the history."""
    new = F.col("match_date") >= F.lit(as_of - datetime.timedelta(days=recent))
    n, t = "avg_negative_chat_ratio", "tilt_signal_rate"
    got = (
        _since(maps, as_of, history)
        .groupBy("map")
        .agg(
            F.sum(F.when(new, F.col("games"))).alias("recent_games"),
            F.avg(F.when(new, F.col(n))).alias("rn"),
            F.avg(F.when(new, F.col(t))).alias("rt"),
            F.avg(n).alias("bn"),
            F.avg(t).alias("bt"),
            rnd(F.stddev_pop(n), 12).alias("sn"),
            rnd(F.stddev_pop(t), 12).alias("st"),
        )
        .filter(F.col("recent_games") >= min_games)
    )
    return got.select(
        "map",
        "recent_games",
        rnd("rn", 4).alias("recent_negative_chat_ratio"),
        rnd("rt", 4).alias("recent_tilt_signal_rate"),
        rnd("bn", 4).alias("baseline_negative_chat_ratio"),
        rnd("bt", 4).alias("baseline_tilt_signal_rate"),
        rnd(ratio(F.col("rn") - F.col("bn"), "sn"), 4).alias("negative_chat_zscore"),
        rnd(ratio(F.col("rt") - F.col("bt"), "st"), 4).alias("tilt_signal_zscore"),
    ).orderBy(F.desc_nulls_last("tilt_signal_zscore"), F.desc_nulls_last("negative_chat_zscore"), F.desc("recent_games"), "map")


def prediction_quality_trend(quality: DataFrame, as_of: datetime.date, days: int = 90) -> DataFrame:
    drop = ("snapshot_id", "snapshot_cutoff_date")
    return _since(quality, as_of, days, "progress_date").drop(*drop).orderBy(F.desc("progress_date"), "model_name", "model_version")


def prediction_quality_latest(quality: DataFrame) -> DataFrame:
    """All rows of each version's last day; several snapshots of that day all stay."""
    top = quality.groupBy("model_name", "model_version").agg(F.max("progress_date").alias("progress_date"))
    keep = ["model_name", "model_version", "task_type", "stage", "is_active", "snapshot_id", "progress_date", "rows_total", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier", "rmse", "mae", "data_age_days", "updated_at"]
    return quality.join(top, ["model_name", "model_version", "progress_date"], "left_semi").select(*keep).orderBy("model_name", "model_version", "snapshot_id")


def ml_progress(progress: DataFrame, as_of: datetime.date, days: int = 90) -> DataFrame:
    return _since(progress, as_of, days, "progress_date").drop("latest_snapshot_created_at").orderBy(F.desc("progress_date"))


def registry_snapshot(registry: DataFrame) -> DataFrame:
    version = ["model_name", "model_version", "task_type", "stage", "is_active", "snapshot_id", "snapshot_cutoff_date", "snapshot_training_rows"]
    metrics = ["metric_auc", "metric_precision", "metric_recall", "metric_f1", "metric_rmse", "metric_mae"]
    ages = ["model_age_days", "data_age_days", "created_at", "promoted_at", "updated_at"]
    primary = rnd("primary_metric_value", 6).alias("primary_metric_value")
    return registry.select(*version, "primary_metric_name", primary, *metrics, *ages).orderBy(F.desc(F.coalesce("promoted_at", "created_at")), "model_name", "model_version")


def player_deep_dive(deep: DataFrame, profiles: DataFrame, as_of: datetime.date, player: str | None = None, days: int = 60, min_games: int = 5) -> DataFrame:
    who = F.broadcast(resolve_player(profiles, player))
    mine = _since(deep, as_of, days).join(who, F.col("steamid") == F.col("target_steamid"))
    part = lambda cond: rnd(ratio(times(cond), F.count("*")), 4)
    return (
        mine.groupBy("map")
        .agg(
            F.count("*").alias("games"),
            rnd(F.avg("won_game"), 4).alias("win_rate"),
            rnd(F.avg("kills"), 3).alias("avg_kills"),
            rnd(F.avg("damage_dealt"), 3).alias("avg_damage"),
            rnd(F.avg("impact_index"), 4).alias("avg_impact_index"),
            rnd(F.avg("kda_ratio"), 3).alias("avg_kda_ratio"),
            rnd(F.avg("negative_chat_ratio"), 4).alias("avg_negative_chat_ratio"),
            part(F.col("behaviour_risk_tier") == "high").alias("high_risk_game_rate"),
            part(F.col("impact_tier").isin("elite", "strong")).alias("strong_impact_game_rate"),
            part(F.col("momentum_label") == "hot").alias("hot_momentum_game_rate"),
        )
        .filter(F.col("games") >= min_games)
        .orderBy(F.desc_nulls_last("avg_impact_index"), F.desc("win_rate"), F.desc("games"), "map")
    )


def profile_percentiles(profiles: DataFrame, player: str | None = None, columns: list[str] | None = None, last: tuple[str, ...] = ("updated_at",)) -> DataFrame:
    """A player's profile with percentiles by counting who is below: one scan against one broadcast row. ``last``:
    columns after the percentiles."""
    keep = columns if columns is not None else ["games_played", "maps_played", "first_seen_at", "last_seen_at", "career_win_rate", "career_kd_ratio", "career_avg_damage", "career_avg_impact", "rolling_10_avg_impact", "form_delta_impact", "momentum_label", "rolling_10_negative_chat_ratio", "tilt_risk_rate"]
    ranked = {"impact_percentile": "career_avg_impact", "win_rate_percentile": "career_win_rate", "tilt_risk_percentile": "tilt_risk_rate"}
    who = resolve_player(profiles, player)
    target = profiles.join(F.broadcast(who), F.col("steamid") == F.col("target_steamid")).drop("target_steamid")
    one = F.broadcast(target.select(*[F.col(c).alias(f"t_{c}") for c in ranked.values()]))
    counts = profiles.crossJoin(one).agg(F.count("*").alias("_n"), *[times(F.col(c) < F.col(f"t_{c}")).alias(p) for p, c in ranked.items()])
    at = lambda p: rnd(F.when(F.col("_n") <= 1, 0.0).otherwise(ratio(F.col(p) * 100.0, F.col("_n") - 1)), 1).alias(p)
    return target.crossJoin(F.broadcast(counts)).select("steamid", *keep, *[at(p) for p in ranked], *last)


def synergy_network(deep: DataFrame, profiles: DataFrame, as_of: datetime.date, player: str | None = None, days: int = 90, min_shared: int = 5) -> DataFrame:
    who = F.broadcast(resolve_player(profiles, player))
    mine = _since(deep, as_of, days).join(who, F.col("steamid") == F.col("target_steamid")).select("logid", "target_steamid", F.col("team").alias("own"), F.col("won_game").alias("own_won"))
    rest = deep.select("logid", F.col("steamid").alias("other_steamid"), "team", "impact_index", "behaviour_risk_tier")
    met = rest.join(mine, "logid").filter(F.col("other_steamid") != F.col("target_steamid"))
    same = (F.col("team") == F.col("own")).cast("int")
    return (
        met.groupBy("target_steamid", "other_steamid")
        .agg(
            F.count("*").alias("shared_games"),
            F.sum(same).alias("games_as_teammates"),
            F.sum(1 - same).alias("games_as_opponents"),
            rnd(F.avg(same), 4).alias("same_team_rate"),
            rnd(F.avg(F.when(same == 1, (F.col("own_won") == 1).cast("int"))), 4).alias("win_rate_when_teammates"),
            rnd(F.avg("impact_index"), 4).alias("avg_other_impact_index"),
            rnd(share(F.col("behaviour_risk_tier") == "high"), 4).alias("high_risk_pair_rate"),
        )
        .filter(F.col("shared_games") >= min_shared)
        .orderBy(F.desc("shared_games"), F.desc("same_team_rate"), F.desc_nulls_last("win_rate_when_teammates"), "other_steamid")
    )
