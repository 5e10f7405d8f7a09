"""Exploration queries over the deduplicated bases. Thresholds and players are arguments; every order is total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chat import EXPLORATION_LEXICON, chat_counts, lexicon_scorer
from ..functions.core import ratio, rnd, share, times, won, zero
from .features import with_chat, with_shares

ZEROED = {"kills": "kills", "assists": "assists", "deaths": "deaths", "damagedealt": "damage_dealt", "healingdone": "healing_done", "ubersused": "ubers_used"}


def _measures(*names: str) -> list[F.Column]:
    return [zero(c).alias(ZEROED[c]) for c in names or ZEROED]


def class_usage(summaries: DataFrame, min_games: int = 25, top: int = 300) -> DataFrame:
    named = summaries.select("steamid", "logid", F.explode(F.split(F.coalesce("classesplayedcsv", F.lit("")), ",")).alias("c")).select("steamid", "logid", F.lower(F.trim("c")).alias("c")).filter("c <> ''")
    counts = named.groupBy("steamid", "c").agg(F.countDistinct("logid").alias("n"))
    profile = counts.groupBy("steamid").agg(F.count("*").alias("u"), F.max(F.struct("n", "c")).alias("top"))
    totals = summaries.groupBy("steamid").agg(F.count("*").alias("total_games")).filter(F.col("total_games") >= min_games)
    return (
        totals.join(profile, "steamid", "left")
        .select(
            "steamid",
            "total_games",
            zero("u").alias("unique_classes"),
            F.col("top.c").alias("primary_class"),
            F.col("top.n").alias("primary_class_games"),
            rnd(ratio(zero("u"), "total_games"), 3).alias("class_diversity_index"),
            rnd(ratio(F.coalesce("top.n", F.lit(0)), "total_games"), 3).alias("primary_class_share"),
        )
        .orderBy(F.desc("class_diversity_index"), F.desc("total_games"), "steamid")
        .limit(top)
    )


def game_pace(logs: DataFrame, summaries: DataFrame, min_games: int = 20) -> DataFrame:
    kills = summaries.groupBy("logid").agg(F.sum(zero("kills")).alias("k"))
    games = logs.select("logid", "map", zero("durationseconds").alias("secs"), F.abs(zero("redscore") - zero("bluescore")).alias("gap")).join(kills, "logid", "left").withColumn("k", zero("k"))
    return (
        games.groupBy("map")
        .agg(
            F.count("*").alias("games"),
            rnd(F.avg("secs") / 60.0, 2).alias("avg_duration_minutes"),
            rnd(F.avg("k"), 2).alias("avg_total_kills"),
            rnd(F.avg(ratio("k", F.col("secs") / 60.0)), 2).alias("avg_kills_per_minute"),
            rnd(F.avg("gap"), 2).alias("avg_score_delta"),
            rnd(share(F.col("gap") <= 1), 3).alias("close_game_rate"),
            rnd(share(F.col("gap") >= 4), 3).alias("blowout_rate"),
        )
        .filter(F.col("games") >= min_games)
        .orderBy(F.desc("close_game_rate"), F.desc("games"), "map")
    )


def head_to_head(summaries: DataFrame, logs: DataFrame, one: str, two: str) -> DataFrame:
    def side(p: str, who: str) -> DataFrame:
        return summaries.filter(F.col("steamid") == who).select("logid", F.col("team").alias(f"{p}_team"), *[zero(c).alias(f"{p}_{c}") for c in ("kills", "assists", "deaths", "damagedealt")])

    met = side("a", one).join(side("b", two), "logid").join(logs.select("logid", "redscore", "bluescore"), "logid", "left")
    per = lambda p, k: [
        F.coalesce(F.sum(won(f"{p}_team")), F.lit(0)).cast("long").alias(f"player_{k}_wins"),
        rnd(F.avg(f"{p}_kills"), 2).alias(f"player_{k}_avg_kills"),
        rnd(F.avg(f"{p}_damagedealt"), 2).alias(f"player_{k}_avg_damage"),
        rnd(ratio(F.sum(F.col(f"{p}_kills") + F.col(f"{p}_assists")), F.sum(f"{p}_deaths")), 3).alias(f"player_{k}_kda_ratio"),
    ]
    got = met.agg(F.count("*").alias("games_in_same_log"), times(F.col("a_team") == F.col("b_team")).alias("same_team_games"), times(F.col("a_team") != F.col("b_team")).alias("opposing_team_games"), *per("a", 1), *per("b", 2))
    return got.select(F.lit(one).alias("player_1_steam_id"), F.lit(two).alias("player_2_steam_id"), *got.columns)


def match_breakdown(logs: DataFrame, summaries: DataFrame, logid: int) -> DataFrame:
    """Filters by match first: the team sums are those of one match."""
    game = logs.filter(F.col("logid") == logid).select("logid", "title", "map", "match_time", "durationseconds", "redscore", "bluescore")
    rows = with_shares(summaries.filter(F.col("logid") == logid).drop("map", "match_time", "title"))
    return (
        game.join(rows, "logid")
        .select(*game.columns, "steamid", "team", *_measures(), "classesplayedcsv", rnd("_ks", 3).alias("kill_share_of_team"), rnd("_ds", 3).alias("damage_share_of_team"), rnd("_hs", 3).alias("healing_share_of_team"))
        .orderBy("team", F.desc("damage_dealt"), F.desc("kills"), "steamid")
    )


def map_specialists(summaries: DataFrame, logs: DataFrame, min_overall: int = 30, min_on_map: int = 8, top: int = 300) -> DataFrame:
    """Sums per player and map once; the overall figures are sums of those."""
    rows = summaries.join(logs.select("logid", "durationseconds"), "logid", "left")
    sums = rows.groupBy("steamid", "map").agg(F.count("*").alias("n"), F.sum(zero("damagedealt")).alias("d"), F.sum(zero("kills")).alias("k"), F.sum(zero("deaths")).alias("x"), F.sum(zero("durationseconds")).alias("s"))
    whole = sums.groupBy("steamid").agg(*[F.sum(c).alias(f"o{c}") for c in "ndkxs"]).filter(F.col("on") >= min_overall)
    minutes = lambda c: F.col(c) / F.lit(60.0)
    met = sums.filter(F.col("n") >= min_on_map).join(whole, "steamid")
    dpm, odpm, kd, okd = ratio("d", minutes("s")), ratio("od", minutes("os")), ratio("k", "x"), ratio("ok", "ox")
    return (
        met.select(
            "steamid",
            "map",
            F.col("n").alias("games_on_map"),
            F.col("on").alias("games_overall"),
            rnd(ratio("d", "n"), 2).alias("avg_damage_on_map"),
            rnd(ratio("od", "on"), 2).alias("avg_damage_overall"),
            rnd(ratio("k", "n"), 2).alias("avg_kills_on_map"),
            rnd(ratio("ok", "on"), 2).alias("avg_kills_overall"),
            rnd(kd, 3).alias("kd_on_map"),
            rnd(okd, 3).alias("kd_overall"),
            rnd(dpm, 2).alias("dpm_on_map"),
            rnd(odpm, 2).alias("dpm_overall"),
            rnd(dpm - odpm, 2).alias("dpm_uplift"),
            rnd(kd - okd, 3).alias("kd_uplift"),
            rnd((dpm - odpm) * F.ln(F.lit(1.0) + F.col("n")), 3).alias("specialist_score"),
        )
        .orderBy(F.desc_nulls_last("specialist_score"), "steamid", "map")
        .limit(top)
    )


def activity_baseline(summaries: DataFrame, logs: DataFrame, min_games: int = 20) -> DataFrame:
    rows = summaries.join(logs.select("logid", "durationseconds", "redscore", "bluescore"), "logid", "left")
    total = lambda c: F.sum(zero(c))
    return (
        rows.groupBy("steamid")
        .agg(
            F.count("*").alias("games_played"),
            F.countDistinct("map").alias("maps_played"),
            F.countDistinct(F.to_date("match_time")).alias("active_days"),
            F.min("match_time").alias("first_seen_at"),
            F.max("match_time").alias("last_seen_at"),
            *[total(c).alias(f"total_{n}") for c, n in ZEROED.items()],
            rnd(ratio(total("kills"), total("deaths")), 3).alias("kd_ratio"),
            rnd(ratio(total("kills") + total("assists"), total("deaths")), 3).alias("kda_ratio"),
            rnd(F.avg(zero("kills")), 2).alias("avg_kills_per_game"),
            rnd(F.avg(zero("damagedealt")), 2).alias("avg_damage_per_game"),
            rnd(ratio(total("damagedealt"), total("durationseconds") / 60.0), 2).alias("damage_per_minute"),
            rnd(F.avg(won()), 3).alias("win_rate"),
        )
        .filter(F.col("games_played") >= min_games)
        .orderBy(F.desc("games_played"), F.desc_nulls_last("kd_ratio"), "steamid")
    )


def coplay_network(summaries: DataFrame, logs: DataFrame, player: str, min_shared: int = 5, top: int = 300) -> DataFrame:
    """Ego network: the player's own matches join everybody else's rows of them."""
    mine = summaries.filter(F.col("steamid") == player).select("logid", F.col("team").alias("own"))
    met = summaries.filter(F.col("steamid") != player).select("logid", F.col("steamid").alias("other_steam_id"), "team").join(mine, "logid").join(logs.select("logid", "redscore", "bluescore"), "logid", "left")
    same = (F.col("team") == F.col("own")).cast("int")
    return (
        met.groupBy("other_steam_id")
        .agg(
            F.count("*").alias("shared_games"),
            F.sum(same).alias("games_as_teammates"),
            F.sum(1 - same).alias("games_as_opponents"),
            rnd(F.avg(same), 3).alias("same_team_rate"),
            rnd(F.avg(F.when(same == 1, won("own"))), 3).alias("win_rate_when_teammates"),
        )
        .filter(F.col("shared_games") >= min_shared)
        .select(F.lit(player).alias("target_steam_id"), "*")
        .orderBy(F.desc("shared_games"), F.desc("same_team_rate"), "other_steam_id")
        .limit(top)
    )


def form_and_momentum(summaries: DataFrame, player: str, rows: int = 12, top: int = 200) -> DataFrame:
    mine = summaries.filter(F.col("steamid") == player).select("steamid", "logid", "map", "match_time", *_measures("kills", "assists", "deaths", "damagedealt", "healingdone"))
    whole = Window.partitionBy("steamid")
    line = whole.orderBy("match_time", "logid")
    last = line.rowsBetween(1 - rows, 0)
    return (
        mine.withColumns(
            {
                "game_number": F.row_number().over(line),
                "rolling_avg_kills": rnd(F.avg("kills").over(last), 2),
                "rolling_avg_damage": rnd(F.avg("damage_dealt").over(last), 2),
                "rolling_kda_ratio": rnd(F.avg(ratio(F.col("kills") + F.col("assists"), "deaths")).over(last), 3),
                "kills_zscore_vs_career": rnd(ratio(F.col("kills") - F.avg("kills").over(whole), F.stddev_pop("kills").over(whole)), 3),
            }
        )
        .orderBy(F.desc("match_time"), F.desc("logid"))
        .limit(top)
    )


def pair_synergy(summaries: DataFrame, logs: DataFrame, anchor: str = "", min_together: int = 20, top: int = 200) -> DataFrame:
    """Unordered pairs within a team: a hash join on (match, team) with the order of ids left as its condition."""
    cols = ["kills", "deaths", "damagedealt"]
    half = lambda p: summaries.filter(F.col("team").isin("Red", "Blue")).select("logid", "team", F.col("steamid").alias(f"player_{p}"), *[zero(c).alias(f"{p}_{c}") for c in cols])
    pairs = half("a").join(half("b"), ["logid", "team"]).filter("player_a < player_b")
    if anchor:
        pairs = pairs.filter((F.col("player_a") == anchor) | (F.col("player_b") == anchor))
    both = lambda c: F.col(f"a_{c}") + F.col(f"b_{c}")
    return (
        pairs.join(logs.select("logid", "redscore", "bluescore"), "logid", "left")
        .groupBy("player_a", "player_b")
        .agg(
            F.count("*").alias("games_together"),
            rnd(F.avg(both("kills")), 2).alias("avg_combined_kills"),
            rnd(F.avg(both("damagedealt")), 2).alias("avg_combined_damage"),
            rnd(ratio(F.sum(both("kills")), F.sum(both("deaths"))), 3).alias("combined_kd_ratio"),
            rnd(F.avg(won()), 3).alias("win_rate_together"),
            rnd(F.avg(both("damagedealt")) * F.avg(won()) / 1000.0, 4).alias("synergy_score"),
        )
        .filter(F.col("games_together") >= min_together)
        .orderBy(F.desc("synergy_score"), F.desc("games_together"), "player_a", "player_b")
        .limit(top)
    )


def relative_impact(summaries: DataFrame, player: str, top: int = 200) -> DataFrame:
    """Only the player's matches are summed up by team."""
    games = summaries.filter(F.col("steamid") == player).select("logid")
    rows = with_shares(summaries.filter(F.col("team").isin("Red", "Blue")).join(games, "logid", "left_semi")).filter(F.col("steamid") == player)
    return (
        rows.select("steamid", "logid", "map", "team", "match_time", *_measures(), rnd("_ks", 3).alias("kill_share_of_team"), rnd("_ds", 3).alias("damage_share_of_team"), rnd("_hs", 3).alias("healing_share_of_team"), rnd("_impact", 4).alias("weighted_impact_index"))
        .orderBy(F.desc("match_time"), F.desc("logid"))
        .limit(top)
    )


def sentiment_export(summaries: DataFrame, logs: DataFrame, messages: DataFrame, lexicon: str = EXPLORATION_LEXICON) -> DataFrame:
    chat = chat_counts(messages, lexicon_scorer(lexicon), lower=True)
    rows = with_chat(summaries.join(logs.select("logid", "redscore", "bluescore"), "logid", "left"), chat)
    hits, n = zero("negative_lexicon_hits"), zero("chat_messages")
    return rows.select(
        "steamid", "logid", "match_time", "map", "team", *_measures(),
        F.coalesce("classesplayedcsv", F.lit("")).alias("classes_played_csv"),
        n.alias("chat_messages"),
        rnd(F.coalesce("avg_message_length", F.lit(0.0)), 2).alias("avg_message_length"),
        zero("all_caps_messages").alias("all_caps_messages"),
        zero("intense_punctuation_messages").alias("intense_punctuation_messages"),
        hits.alias("negative_lexicon_hits"),
        won().alias("won_game"),
        F.coalesce(ratio(hits, n), F.lit(0.0)).alias("negative_chat_ratio"),
        F.when((zero("deaths") >= 20) & (hits >= 2), 1).otherwise(0).alias("possible_tilt_label"),
    ).orderBy(F.desc("match_time"), "logid", "steamid")
