"""Lines of hot keys, cut into chunks, give the frames of uncut ones."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import canonical
from scoreline.functions import rolling
from scoreline.operators import features

FIELDS = "logid long, steamid string, map string, team string, match_time timestamp_ntz, match_date date, kills long, assists long, deaths long, damage_dealt long, healing_done long, impact_index double, negative_chat_ratio double, won_game int"


def history(spark, n, players=1, ties=1):
    """``n`` matches of each player, ``ties`` of them at one time."""
    day = F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (id div {ties}) * 600)")
    rows = spark.range(n).crossJoin(spark.range(players).select(F.concat(F.lit("p"), "id").alias("steamid")))
    h = lambda k, m: F.pmod(F.xxhash64("id", "steamid", F.lit(k)), F.lit(m))
    return rows.select(
        F.col("id").alias("logid"), "steamid", F.lit("m").alias("map"), F.lit("Red").alias("team"), day.alias("match_time"), F.to_date(day).alias("match_date"),
        h(1, 30).alias("kills"), h(2, 9).alias("assists"), h(3, 9).alias("deaths"), h(4, 5000).alias("damage_dealt"), h(5, 100).alias("healing_done"),
        (h(6, 400) / 1000.0).alias("impact_index"), (h(7, 10) / 10.0).alias("negative_chat_ratio"), h(8, 2).cast("int").alias("won_game"),
    )


@pytest.mark.parametrize("chunk, ties, strict", [(3, 1, False), (40, 7, False), (40, 500, True), (10_000, 1, False)])
def test_form_of_hot_players(spark, chunk, ties, strict):
    rows = history(spark, 500, 3, ties).unionByName(history(spark, 6).withColumn("steamid", F.lit("rare"))).unionByName(history(spark, 4).withColumn("steamid", F.lit(None).cast("string")))
    hot = rolling.hot_keys(rows, "steamid", 100)
    assert {r[0] for r in hot.collect()} == {"p0", "p1", "p2"}
    got = features.recent_form(rows, strict=strict, hot=hot, chunk=chunk)
    want = features.recent_form(rows, strict=strict)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert canonical(got.toPandas()) == canonical(want.toPandas())


def test_no_hot_players(spark):
    assert rolling.hot_keys(history(spark, 50), "steamid", 50) is None
    assert rolling.hot_keys(history(spark, 50).limit(0), "steamid", 50) is None


def test_chunks_of_one_player_are_alike_in_size(spark):
    """A million matches of one player, many at one time: no chunk above twice the median, each with a whole halo."""
    rows = history(spark, 1_000_000, ties=50_000).select("steamid", "match_time", "logid")
    cut = rolling.in_chunks(rows, "steamid", ["match_time", "logid"], 10, 50_000)
    sizes = [(r.own, r.halo) for r in cut.groupBy("_chunk").agg(F.sum((~F.col("_halo")).cast("int")).alias("own"), F.sum(F.col("_halo").cast("int")).alias("halo")).orderBy("_chunk").collect()]
    own = sorted(n for n, _ in sizes)
    assert sum(own) == 1_000_000 and 15 <= len(own) <= 25 and own[-1] <= 2 * own[len(own) // 2]
    assert [h for _, h in sizes] == [0] + [10] * (len(sizes) - 1)


def test_chunks_smaller_than_the_halo(spark):
    rows = history(spark, 60).select("steamid", "match_time", "logid", "kills")
    cut = rolling.in_chunks(rows, "steamid", ["match_time", "logid"], 9, 2)
    line = Window.partitionBy("steamid", "_chunk").orderBy("match_time", "logid").rowsBetween(-9, 0)
    got = cut.withColumn("s", F.sum("kills").over(line)).filter("not _halo").select("logid", "s")
    whole = Window.partitionBy("steamid").orderBy("match_time", "logid").rowsBetween(-9, 0)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.select("logid", F.sum("kills").over(whole).alias("s")).collect()))
