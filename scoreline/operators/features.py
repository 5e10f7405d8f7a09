"""Deduplicated bases and the two feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.chat import Scorer, chat_counts
from ..functions import rolling
from ..functions.core import checked_broadcast, latest_by, ratio, rnd, won, zero

SIDES = ("Red", "Blue")


def logs_base(logs: DataFrame) -> DataFrame:
    """One row per match: of each delivery's record the newest, then of each match. A record id names its match, so
    both ranks work on one partitioning by match, and what joins by match later finds it."""
    order = [F.desc("__ingest_ts"), F.desc("match_time"), F.desc("recordid")]
    return latest_by(latest_by(logs.repartition("logid"), ["logid", "recordid"], order), ["logid"], order)


def summaries_base(summaries: DataFrame) -> DataFrame:
    """One row per (match, player) of the two sides; ties broken by all measures. Both ranks work on rows that lie by
    match, as those of the source do; others are dealt out by each."""
    order = [F.desc("__ingest_ts"), *[F.desc(c) for c in ("steamid", "partkey", "damagedealt", "kills", "assists", "healingdone", "team") if c in summaries.columns]]
    by_record = latest_by(summaries, ["logid", "recordid"], order)
    return latest_by(by_record.filter(F.col("team").isin(*SIDES)), ["logid", "steamid"], [order[0], F.desc("recordid"), *order[1:]])


def messages_base(messages: DataFrame) -> DataFrame:
    return latest_by(messages.repartition("logid"), ["logid", "recordid"], [F.desc("__ingest_ts"), F.desc("steamid"), F.desc("message")])


def class_count(csv: str) -> F.Column:
    return F.size(F.filter(F.split(F.coalesce(F.col(csv), F.lit("")), ","), lambda c: F.trim(c) != ""))


def team_totals(base: DataFrame) -> DataFrame:
    return base.groupBy("logid", "team").agg(F.sum(zero("kills")).alias("team_kills"), F.sum(zero("damagedealt")).alias("team_damage"), F.sum(zero("healingdone")).alias("team_healing"))


def with_shares(rows: DataFrame) -> DataFrame:
    """Adds the team's sums and the player's unrounded shares; whole-team windows keep the match partitioning."""
    w = Window.partitionBy("logid", "team")
    sums = rows.withColumns({"team_kills": F.sum(zero("kills")).over(w), "team_damage": F.sum(zero("damagedealt")).over(w), "team_healing": F.sum(zero("healingdone")).over(w)})
    return sums.withColumns({"_ks": ratio(zero("kills"), "team_kills"), "_ds": ratio(zero("damagedealt"), "team_damage"), "_hs": ratio(zero("healingdone"), "team_healing")}).withColumn(
        "_impact", F.lit(0.45) * F.col("_ds") + F.lit(0.35) * F.col("_ks") + F.lit(0.2) * F.col("_hs")
    )


def with_chat(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds each player's chat counts. They come as a map by player for each match, no longer than its players: joined
    by match alone, they leave the player rows where they are."""
    each = F.struct("steamid", F.struct(*[c for c in counts.columns if c not in ("logid", "steamid")]).alias("v"))
    by_match = counts.groupBy("logid").agg(F.map_from_entries(F.collect_list(each)).alias("_chat"))
    return rows.join(by_match, "logid", "left").select("*", F.col("_chat")[F.col("steamid")].alias("_c")).select("*", "_c.*").drop("_chat", "_c")


def player_match(summaries: DataFrame, logs: DataFrame, messages: DataFrame, scorer: Scorer, changed: DataFrame | None = None) -> DataFrame:
    """One row per match and player, from deduplicated bases. ``changed`` limits it to some matches. The joins by match
    come first: the team windows find the rows where these have put them."""
    if changed is not None:
        summaries = summaries.join(changed.select("logid").distinct(), "logid", "left_semi")
        messages = messages.join(changed.select("logid").distinct(), "logid", "left_semi")
    game = logs.select("logid", "durationseconds", "redscore", "bluescore")
    rows = with_shares(with_chat(summaries.join(game, "logid", "left"), chat_counts(messages, scorer)))
    hits, chat = zero("negative_lexicon_hits"), zero("chat_messages")
    return rows.select(
        "logid",
        "steamid",
        "map",
        "team",
        "match_time",
        F.to_date("match_time").alias("match_date"),
        zero("durationseconds").alias("duration_seconds"),
        zero("kills").alias("kills"),
        zero("assists").alias("assists"),
        zero("deaths").alias("deaths"),
        zero("damagedealt").alias("damage_dealt"),
        zero("healingdone").alias("healing_done"),
        zero("ubersused").alias("ubers_used"),
        F.coalesce("classesplayedcsv", F.lit("")).alias("classes_played_csv"),
        class_count("classesplayedcsv").alias("classes_played_count"),
        won().alias("won_game"),
        rnd("_ks", 4).alias("kill_share_of_team"),
        rnd("_ds", 4).alias("damage_share_of_team"),
        rnd("_hs", 4).alias("healing_share_of_team"),
        rnd("_impact", 4).alias("impact_index"),
        rnd(ratio(zero("damagedealt"), zero("durationseconds") / F.lit(60.0)), 3).alias("damage_per_minute"),
        rnd(ratio(zero("kills") + zero("assists"), zero("deaths")), 3).alias("kda_ratio"),
        chat.alias("chat_messages"),
        rnd(F.coalesce("avg_message_length", F.lit(0.0)), 3).alias("avg_message_length"),
        zero("all_caps_messages").alias("all_caps_messages"),
        zero("intense_punctuation_messages").alias("intense_punctuation_messages"),
        hits.alias("negative_lexicon_hits"),
        F.coalesce(ratio(hits, chat), F.lit(0.0)).alias("negative_chat_ratio"),
        F.when((zero("deaths") >= 12) & (chat >= 2) & (hits >= 1), 1).otherwise(0).alias("possible_tilt_label"),
    )


#: The longest frame of the form, in rows.
FRAME = 10
#: What the form takes of the player rows.
FORM_TAKES = (
    "steamid", "logid", "map", "team", "match_time", "match_date", "kills", "assists", "deaths", "damage_dealt", "healing_done",
    "impact_index", "negative_chat_ratio", "won_game",
)


def recent_form(features: DataFrame, players: DataFrame | None = None, strict: bool = False, hot: DataFrame | None = None, chunk: int = rolling.CHUNK, whole: bool = False) -> DataFrame:
    """Rolling form of each player. Frames hold the current match, as the table's contract has it; ``strict``
    leaves it out, for features that must not see what they predict. The lines of the players of ``hot``
    (``rolling.hot_keys``) are cut into chunks of about ``chunk`` matches. ``whole`` adds ``_row``, the row of ``features``:
    what needs both has them from one shuffle by player."""
    row = [F.struct(*features.columns).alias("_row")] if whole else []
    if players is not None:
        features = features.join(players.select("steamid").distinct(), "steamid", "left_semi")
    line, career = Window.partitionBy("steamid"), _career()
    if hot is None:
        rows = features.withColumns({c: a.over(line) for c, a in career.items()})
        return _form(rows, line, F.lit(0), strict, *row)
    rest, long_ = rolling.split_off(features, "steamid", hot)
    sums = checked_broadcast(long_.groupBy("steamid").agg(*[a.alias(c) for c, a in career.items()]))
    cut = rolling.in_chunks(long_, "steamid", ["match_time", "logid"], FRAME, chunk).join(sums, "steamid", "left")
    parts = Window.partitionBy("steamid", "_chunk")
    before = F.col("_before") - F.sum(F.col("_halo").cast("int")).over(parts)
    done = _form(cut, parts, before, strict, F.col("_halo"), *row).filter("not _halo").drop("_halo")
    return recent_form(rest, strict=strict, whole=whole).unionByName(done)


def _career() -> dict[str, F.Column]:
    return {f"_{c[0]}": F.avg(c) for c in ("kills", "damage_dealt", "impact_index")}


def latest_form(features: DataFrame) -> DataFrame:
    """Each player's newest row of the form, but for ``games_played_to_date``. Their last matches and career averages
    tell it, so that only these move."""
    newest = Window.partitionBy("steamid").orderBy(F.desc("match_time"), F.desc("logid"))
    last = features.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= FRAME)
    career = features.groupBy("steamid").agg(*[a.alias(c) for c, a in _career().items()])
    rows = last.join(career, "steamid")
    return _form(rows, Window.partitionBy("steamid"), F.lit(0), False, F.col("_n")).filter("_n = 1").drop("_n", "games_played_to_date")


def _form(rows: DataFrame, parts: WindowSpec, before: F.Column, strict: bool, *keep: F.Column) -> DataFrame:
    """The form over lines that lie in ``parts``, with ``before`` rows of the line ahead of each part."""
    line = parts.orderBy("match_time", "logid")
    last = lambda n: line.rowsBetween(-n, -1) if strict else line.rowsBetween(1 - n, 0)
    avg = lambda c, w: F.avg(c).over(w)
    scored = rows.withColumns(
        {
            "games_played_to_date": (F.row_number().over(line) + before).cast("int"),
            "_k5": avg("kills", last(5)),
            "_d10": avg("damage_dealt", last(FRAME)),
            "_i10": avg("impact_index", last(FRAME)),
            "_a10": avg(ratio(F.col("kills") + F.col("assists"), "deaths"), last(FRAME)),
            "_w10": avg("won_game", last(FRAME)),
            "_n10": avg("negative_chat_ratio", last(FRAME)),
        }
    )
    delta = rnd(F.col("_i10") - F.col("_i"), 9)
    return scored.select(
        "steamid", "logid", "map", "team", "match_time", "match_date", "games_played_to_date", "kills", "assists", "deaths", "damage_dealt", "healing_done", "impact_index",
        rnd("negative_chat_ratio", 4).alias("negative_chat_ratio"),
        "won_game",
        rnd("_k5", 3).alias("rolling_5_avg_kills"),
        rnd("_d10", 3).alias("rolling_10_avg_damage"),
        rnd("_i10", 4).alias("rolling_10_avg_impact"),
        rnd("_a10", 4).alias("rolling_10_kda_ratio"),
        rnd("_w10", 4).alias("rolling_10_win_rate"),
        rnd("_n10", 4).alias("rolling_10_negative_chat_ratio"),
        rnd("_k", 3).alias("career_avg_kills"),
        rnd("_d", 3).alias("career_avg_damage"),
        rnd("_i", 4).alias("career_avg_impact"),
        rnd(F.col("_k5") - F.col("_k"), 3).alias("form_delta_kills"),
        rnd(F.col("_d10") - F.col("_d"), 3).alias("form_delta_damage"),
        rnd(F.col("_i10") - F.col("_i"), 4).alias("form_delta_impact"),
        F.when(delta >= 0.016, "hot").when(delta <= -0.020, "cold").otherwise("stable").alias("momentum_label"),
        *keep,
    )
