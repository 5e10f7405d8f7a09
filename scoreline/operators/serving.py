"""Serving tables: player profiles, daily map overview, match deep dive."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import latest_by, ratio, rnd, share, zero
from . import features as player_features

FORM = ["rolling_5_avg_kills", "rolling_10_avg_damage", "rolling_10_avg_impact", "rolling_10_kda_ratio", "rolling_10_win_rate", "rolling_10_negative_chat_ratio", "form_delta_kills", "form_delta_damage", "form_delta_impact", "momentum_label"]


def player_profiles(features: DataFrame, form: DataFrame | None = None, players: DataFrame | None = None) -> DataFrame:
    """Career sums, latest form and the last 30 matches of each player: three aggregates by player, joined. Without the
    table of the form, its newest rows are made here."""
    if players is not None:
        features, form = (t and t.join(players.select("steamid").distinct(), "steamid", "left_semi") for t in (features, form))
    newest = Window.partitionBy("steamid").orderBy(F.desc("match_time"), F.desc("logid"))
    career = features.groupBy("steamid").agg(
        F.count("*").alias("games_played"),
        F.countDistinct("map").alias("maps_played"),
        F.min("match_time").alias("first_seen_at"),
        F.max("match_time").alias("last_seen_at"),
        rnd(F.avg("won_game"), 4).alias("career_win_rate"),
        rnd(ratio(F.sum("kills"), F.sum("deaths")), 4).alias("career_kd_ratio"),
        rnd(F.avg("kda_ratio"), 4).alias("career_avg_kda_ratio"),
        rnd(F.avg("kills"), 3).alias("career_avg_kills"),
        rnd(F.avg("damage_dealt"), 3).alias("career_avg_damage"),
        rnd(F.avg("damage_per_minute"), 3).alias("career_avg_damage_per_minute"),
        rnd(F.avg("impact_index"), 4).alias("career_avg_impact"),
        rnd(F.avg("possible_tilt_label"), 4).alias("tilt_risk_rate"),
    )
    form = player_features.latest_form(features) if form is None else latest_by(form, ["steamid"], [F.desc("match_time"), F.desc("logid")])
    latest = form.select("steamid", F.col("match_time").alias("latest_match_time"), *FORM)
    recent = (
        features.select("steamid", "kills", "damage_dealt", "impact_index", "won_game", F.row_number().over(newest).alias("_n"))
        .filter("_n <= 30")
        .groupBy("steamid")
        .agg(
            rnd(F.avg("kills"), 3).alias("recent_30_avg_kills"),
            rnd(F.avg("damage_dealt"), 3).alias("recent_30_avg_damage"),
            rnd(F.avg("impact_index"), 4).alias("recent_30_avg_impact"),
            rnd(F.avg("won_game"), 4).alias("recent_30_win_rate"),
        )
    )
    return career.join(latest, "steamid", "left").join(recent, "steamid", "left")


#: What the map overview takes of the player rows.
OVERVIEW_TAKES = ("steamid", "map", "match_date", "impact_index", "negative_chat_ratio", "possible_tilt_label")


def map_overview_daily(logs: DataFrame, summaries: DataFrame, features: DataFrame, since: datetime.date | None = None) -> DataFrame:
    """Per map and day. Kills come from the deduplicated player rows; active players are counted exactly."""
    games = logs.select("logid", "map", F.to_date("match_time").alias("match_date"), zero("durationseconds").alias("secs"), F.abs(zero("redscore") - zero("bluescore")).alias("gap"))
    seen = features
    if since is not None:
        games, seen = games.filter(F.col("match_date") >= F.lit(since)), features.filter(F.col("match_date") >= F.lit(since))
        summaries = summaries.join(games.select("logid"), "logid", "left_semi")
    kills = summaries.groupBy("logid").agg(F.sum(zero("kills")).alias("total_kills"))
    per_game = games.join(kills, "logid", "left")
    maps = per_game.groupBy("map", "match_date").agg(
        F.countDistinct("logid").alias("games"),
        rnd(F.avg("secs") / 60.0, 3).alias("avg_duration_minutes"),
        rnd(F.avg(zero("total_kills")), 3).alias("avg_total_kills"),
        rnd(F.avg(ratio(zero("total_kills"), F.col("secs") / 60.0)), 3).alias("avg_kills_per_minute"),
        rnd(share(F.col("gap") <= 1), 4).alias("close_game_rate"),
        rnd(share(F.col("gap") >= 4), 4).alias("blowout_rate"),
    )
    players = seen.groupBy("map", "match_date").agg(
        F.countDistinct("steamid").alias("_p"), F.avg("impact_index").alias("_i"), F.avg("negative_chat_ratio").alias("_n"), F.avg("possible_tilt_label").alias("_t")
    )
    zeroed = lambda c: rnd(F.coalesce(F.col(c), F.lit(0.0)), 4)
    return maps.join(players, ["map", "match_date"], "left").select(
        *maps.columns, zero("_p").alias("active_players"), zeroed("_i").alias("avg_player_impact_index"), zeroed("_n").alias("avg_negative_chat_ratio"), zeroed("_t").alias("tilt_signal_rate")
    )


def match_deep_dive(features: DataFrame, form: DataFrame, since: datetime.date | None = None, players: DataFrame | None = None) -> DataFrame:
    """One row per match and player with the form at that match and two tiers. ``players`` also refreshes all rows
    of players whose history changed, which a bound by date alone would leave stale."""
    rows = latest_by(features, ["logid", "steamid"], [F.desc("match_time")])
    if since is not None:
        fresh = F.col("match_date") >= F.lit(since)
        if players is None:
            rows = rows.filter(fresh)
        else:
            mark = players.select("steamid").distinct().withColumn("_changed", F.lit(True))
            rows = rows.join(mark, "steamid", "left").filter(fresh | F.col("_changed")).drop("_changed")
    state = latest_by(form, ["logid", "steamid"], [F.desc("match_time")]).select("logid", "steamid", "games_played_to_date", *FORM)
    return _tiers(rows.join(state, ["logid", "steamid"], "left"))


def deep_dive_at_once(features: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The same rows from the features alone, one a match and player: form and features take one shuffle by player and no
    join."""
    form = player_features.recent_form(features, hot=hot, whole=True)
    return _tiers(form.select("_row.*", "games_played_to_date", *FORM))


def _tiers(rows: DataFrame) -> DataFrame:
    chat, impact = F.coalesce("negative_chat_ratio", F.lit(0.0)), F.coalesce("impact_index", F.lit(0.0))
    risk = F.when((zero("possible_tilt_label") == 1) | (chat >= 0.18), "high").when(chat >= 0.08, "medium").otherwise("low")
    tier = F.when(impact >= 0.24, "elite").when(impact >= 0.18, "strong").when(impact >= 0.13, "average").otherwise("struggling")
    met = rows.drop("classes_played_csv").withColumns({"behaviour_risk_tier": risk, "impact_tier": tier})
    return met.withColumns({"negative_chat_ratio": rnd("negative_chat_ratio", 4), "momentum_label": F.coalesce("momentum_label", F.lit("unknown"))})
