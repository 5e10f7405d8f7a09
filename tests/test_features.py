"""Hand-made rows for the rules that the tables' contracts fix."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scoreline.functions.chat import FEATURE_LEXICON, chat_counts, lexicon_scorer
from scoreline.functions.core import ratio, refresh_bound, rnd
from scoreline.operators import features, serving

T0 = dt.datetime(2024, 1, 1)
SUM = "recordid string, logid bigint, steamid string, team string, map string, match_time timestamp_ntz, kills bigint, assists bigint, deaths bigint, damagedealt bigint, healingdone bigint, ubersused bigint, classesplayedcsv string, __ingest_ts timestamp_ntz"
LOG = "recordid string, logid bigint, title string, map string, match_time timestamp_ntz, durationseconds bigint, redscore bigint, bluescore bigint, __ingest_ts timestamp_ntz"
MSG = "recordid string, logid bigint, steamid string, message string, messagelower string, __ingest_ts timestamp_ntz"


def row(logid, who, team="Red", kills=1, assists=0, deaths=1, dmg=100, heal=10, csv="scout", at=0, day=0, rid=None):
    return (rid or f"{logid}:{who}", logid, who, team, "m", T0 + dt.timedelta(days=day), kills, assists, deaths, dmg, heal, 0, csv, T0 + dt.timedelta(hours=at))


def build(spark, rows, logs=(), msgs=()):
    s = features.summaries_base(spark.createDataFrame(rows, SUM))
    lg = features.logs_base(spark.createDataFrame(list(logs), LOG))
    m = features.messages_base(spark.createDataFrame(list(msgs), MSG))
    return features.player_match(s, lg, m, lexicon_scorer())


def by_key(df):
    return {(r.logid, r.steamid): r for r in df.collect()}


def test_latest_delivery_wins_in_both_stages(spark):
    base = features.summaries_base(spark.createDataFrame([row(1, "a", kills=1, at=1), row(1, "a", kills=2, at=2), row(1, "a", kills=3, at=0, rid="1:other"), row(1, "b", team="Spectator"), row(1, "c", team=None)], SUM))
    assert [(r.steamid, r.kills) for r in base.collect()] == [("a", 2)]


def test_ratios_without_denominator_are_null(spark):
    got = by_key(build(spark, [row(1, "a", deaths=0, heal=0), row(1, "b", team="Blue", heal=5)], [("1", 1, "t", "m", T0, 0, 2, 1, T0)]))
    a = got[1, "a"]
    assert a.kda_ratio is None and a.damage_per_minute is None and a.healing_share_of_team is None and a.impact_index is None
    assert (a.won_game, got[1, "b"].won_game) == (1, 0)


@pytest.mark.parametrize("csv, n", [(None, 0), ("", 0), ("a, b,", 2)])
def test_class_count(spark, csv, n):
    assert by_key(build(spark, [row(1, "a", csv=csv)]))[1, "a"].classes_played_count == n


def test_tie_wins_for_nobody(spark):
    got = by_key(build(spark, [row(1, "a"), row(1, "b", team="Blue")], [("1", 1, "t", "m", T0, 60, 2, 2, T0)]))
    assert {r.won_game for r in got.values()} == {0}


def test_tilt_needs_all_three(spark):
    rows, msgs = [], []
    for i, (deaths, chat, hits) in enumerate([(12, 2, 1), (11, 2, 1), (12, 1, 1), (12, 2, 0)]):
        rows.append(row(i, "a", deaths=deaths))
        msgs += [(f"{i}:{k}", i, "a", "you noob" if k < hits else "gg", "x", T0) for k in range(chat)]
    got = by_key(build(spark, rows, msgs=msgs))
    assert [got[i, "a"].possible_tilt_label for i in range(4)] == [1, 0, 0, 0]


def test_chat_counts(spark):
    m = spark.createDataFrame([("1:0", 1, "a", "GG WP", "gg wp", T0), ("1:1", 1, "a", "what!!", "what!!", T0), ("1:2", 1, "a", "Trash", "trash", T0), ("1:3", 1, None, "x", "x", T0)], MSG)
    r = chat_counts(m, lexicon_scorer(FEATURE_LEXICON)).first()
    assert (r.chat_messages, r.all_caps_messages, r.intense_punctuation_messages, r.negative_lexicon_hits) == (3, 1, 1, 1)


def test_rolling_frames_and_momentum(spark):
    f = build(spark, [row(i, "a", kills=i, day=i) for i in range(1, 13)])
    got = {r.logid: r for r in features.recent_form(f).collect()}
    assert got[1].rolling_5_avg_kills == 1.0 and got[12].rolling_5_avg_kills == 10.0
    assert got[12].rolling_10_avg_damage == 100.0 and got[12].games_played_to_date == 12
    strict = {r.logid: r for r in features.recent_form(f, strict=True).collect()}
    assert strict[1].rolling_5_avg_kills is None and strict[12].rolling_5_avg_kills == 9.0


def test_momentum_boundaries(spark):
    base = build(spark, [row(1, "a")]).drop("impact_index")
    two = base.withColumn("impact_index", F.lit(0.5)).unionByName(base.withColumn("logid", F.lit(2).cast("long")).withColumn("match_time", F.lit(T0 - dt.timedelta(days=1)).cast("timestamp_ntz")).withColumn("impact_index", F.lit(0.5)))
    assert {r.momentum_label for r in features.recent_form(two).collect()} == {"stable"}


def test_recent_30_leaves_the_oldest_out(spark):
    f = build(spark, [row(i, "a", kills=100 if i == 1 else 1, day=i) for i in range(1, 32)])
    p = serving.player_profiles(f, features.recent_form(f)).first()
    assert p.games_played == 31 and p.recent_30_avg_kills == 1.0


def test_map_overview_counts_duplicates_once(spark):
    logs = features.logs_base(spark.createDataFrame([("1", 1, "t", "m", T0, 60, 3, 2, T0), ("2", 2, "t", "m", T0, 60, 6, 2, T0)], LOG))
    s = features.summaries_base(spark.createDataFrame([row(1, "a", kills=5, at=1), row(1, "a", kills=5, at=2), row(2, "a", kills=7)], SUM))
    f = features.player_match(s, logs, features.messages_base(spark.createDataFrame([], MSG)), lexicon_scorer())
    r = serving.map_overview_daily(logs, s, f).first()
    assert (r.games, r.avg_total_kills, r.close_game_rate, r.blowout_rate, r.active_players) == (2, 6.0, 0.5, 0.5, 1)


@pytest.mark.parametrize("chat, impact, risk, tier", [(0.18, 0.24, "high", "elite"), (0.08, 0.18, "medium", "strong"), (0.0799, 0.13, "low", "average"), (0.0, None, "low", "struggling")])
def test_tiers(spark, chat, impact, risk, tier):
    f = build(spark, [row(1, "a")]).withColumns({"negative_chat_ratio": F.lit(chat).cast("double"), "impact_index": F.lit(impact).cast("double")})
    r = serving.match_deep_dive(f, features.recent_form(f)).first()
    assert (r.behaviour_risk_tier, r.impact_tier) == (risk, tier)


def test_rounding(spark):
    df = spark.createDataFrame([(0.12345,), (-0.12345,), (2.5,), (None,), (-0.00001,)], "x double").select(rnd("x", 4).alias("x"))
    assert [r.x for r in df.collect()] == [0.1235, -0.1235, 2.5, None, 0.0]


def test_bound_and_ratio(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 10),)], "d date")
    assert refresh_bound(d, "d", 7) == dt.date(2024, 1, 3)
    assert refresh_bound(d.filter("false"), "d", 7) == dt.date(1970, 1, 1)
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0)).alias("x")).first().x is None


def test_model_scorer_and_fallbacks(spark, tmp_path):
    from scoreline.functions import chat

    def predict():
        return lambda texts: ["NEGATIVE" if "bad" in t else "Positive" for t in texts]

    def absent():
        raise ImportError("no such library")

    m = spark.createDataFrame([(1, "a", "so bad", "so bad"), (1, "a", "fine", "fine"), (1, "a", None, None)], "logid long, steamid string, message string, messagelower string")
    scorer = chat.first_that_works(absent, lambda: chat.model_scorer(predict))
    r = chat.chat_counts(m, scorer).first()
    assert (r.chat_messages, r.negative_lexicon_hits) == (3, 1)
    assert chat.chat_counts(m, chat.first_that_works(absent)).first().negative_lexicon_hits == 0
    (tmp_path / "cpu").write_text("processor: 0\nflags\t\t: fpu sse avx\n")
    assert chat.cpu_has("avx", str(tmp_path / "cpu")) and not chat.cpu_has("amx", str(tmp_path / "cpu")) and chat.cpu_has("amx", str(tmp_path / "none"))
    assert chat.first_that_works(chat.needs_cpu(absent, "no such feature"), otherwise=scorer) is scorer


def test_rounding_is_that_of_the_engine(spark):
    """Half away from zero, as ROUND has it, on ties and on values of the tables' kinds; they differ only within 1e-7 units
    of a tie, where the order of a sum of doubles decides."""
    values = [0.5, 1.5, 2.5, -0.5, -2.5, 0.125, 0.375, 2.0005, 1 / 3, 2 / 3, -1 / 7, 12345.6789, 0.1 + 0.2, 0.0, -0.0, 1e-9, 99999.99995, 1e12 + 0.25]
    df = spark.createDataFrame([(v,) for v in values] + [(k / 997.0,) for k in range(-3000, 3000, 7)] + [(None,)], "x double")
    for n in (0, 1, 3, 4):
        exact = F.round(F.col("x").cast("decimal(38,18)"), n).cast("double")
        assert df.filter(~rnd("x", n).eqNullSafe(exact)).count() == 0
