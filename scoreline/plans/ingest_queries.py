"""Queries over match documents, splits, thresholds and refreshes, with plain SQL of the same results.

The documents are made from the star schema: an order is a match, its line items are players, conversation turns
are chat. Their fields come in all the forms that a source has: absent, of several types, of no use.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import partial

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rolling
from ..functions.core import rnd, times
from ..ml import boosting, metrics, sentiment, training
from ..operators import features, mlops, serving
from ..sources import documents
from ..streaming import ingest
from . import catalogue, ml_queries, oracle
from .runner import FULL, INCREMENTAL, SERVING_SLICE, Runner, tidy_shuffles
from .store import TableStore, work_folder
from .tables import Tables

#: The moment of ingest: 2001-08-01T00:00:00Z.
NOW = 996_624_000
NOW_MS = NOW * 1000


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(summary, detail): the list's entry and the detail's JSON text. Every 50th match is refused by the source,
    every 50th after it is no object."""
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    player = F.struct(
        F.concat(F.lit("p"), "l_linenumber").alias("key"),
        F.struct(
            F.when(F.col("l_linestatus") == "O", "Red").when(F.col("l_linenumber") != 3, "Blue").alias("team"),
            F.floor("l_quantity").cast("long").alias("kills"),
            F.when(F.col("l_linenumber") % 2 == 0, F.floor("l_extendedprice").cast("long")).alias("dmg"),
            F.when(F.col("l_linenumber") != 2, F.array(*[F.struct(c.alias("type")) for c in (F.lit("scout"), F.lit(""), F.col("l_linestatus"), F.lit("scout"))])).alias("class_stats"),
        ).alias("value"),
    )
    teams = F.map_from_entries(F.array(*[F.struct(F.lit(t), F.struct(F.count(F.when(F.col("l_linestatus") == s, 1)).alias("score"))) for t, s in (("Red", "O"), ("Blue", "F"))]))
    one = F.min(F.struct("l_quantity", "l_extendedprice", "l_linestatus")).alias("x")
    lines = read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(one).select("l_orderkey", "l_linenumber", "x.*").groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(player)).alias("players"), teams.alias("teams"), F.count("*").alias("n"))
    entry = F.struct(F.when(F.col("turn") != 1, F.concat(F.lit("p"), "turn")).alias("steamid"), F.col("role").alias("name"), F.when(F.col("turn") % 3 == 2, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("text"), F.lit(" "))).alias("msg"))
    chat = read("conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", entry.alias("e")))), lambda x: x["e"]).alias("chat"))
    key = F.col("o_orderkey")
    kind = F.when(key % 3 == 0, F.col("o_custkey").cast("string")).when(key % 3 == 1, F.concat(F.lit('"u'), "o_custkey", F.lit('"'))).otherwise(F.concat(F.lit('{"id":"o'), "o_custkey", F.lit('"}')))
    met = read("orders").join(lines, key == F.col("l_orderkey"), "left").join(chat, key == F.col("conv_id"), "left")
    summary = F.struct(key.alias("id"), F.concat(F.lit("list "), key).alias("title"), F.col("o_orderpriority").alias("map"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("date"), F.col("o_custkey").alias("views"), F.coalesce("n", F.lit(0)).alias("players"))
    info = F.struct(F.when(key % 4 == 0, F.concat(F.lit("match "), key)).alias("title"), F.when(key % 5 == 0, F.lit("cp_own")).alias("map"), F.when(key % 2 == 1, F.lit(1800)).alias("total_length"), F.lit("@").alias("uploader"))
    detail = F.to_json(F.struct((key % 50 != 0).alias("success"), F.lit(3).alias("version"), F.when(key % 2 == 0, F.pmod(key, F.lit(3600))).alias("length"), info.alias("info"), "teams", "players", "chat"))
    text = F.replace(detail, F.lit('"uploader":"@"'), F.concat(F.lit('"uploader":'), kind))
    return met.select(summary.alias("summary"), F.when(key % 50 == 1, F.lit("[]")).otherwise(text).alias("detail"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.parse_details(match_documents(spark, sf_dir), strict=False)


def records(spark: SparkSession, sf_dir: str, *, kind: str) -> DataFrame:
    good = parsed(spark, sf_dir).filter("error is null")
    return documents.RECORDS[kind](good, F.timestamp_seconds(F.lit(NOW))).drop("__ingest_ts")


def failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).filter("error is not null").select("summary.id", "error")


def strict_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages, ten matches each, parsed strictly."""
    rows = match_documents(spark, sf_dir).select("summary", F.expr("summary.id div 10").alias("offset"))
    pages = rows.groupBy("offset").agg(F.sort_array(F.collect_list("summary")).alias("logs"))
    page = F.to_json(F.struct(F.lit(True).alias("success"), F.size("logs").alias("results"), F.lit(1000).alias("total"), "logs"))
    return documents.parse_list(pages.select("offset", page.alias("value"))).select("offset", "position", "summary.*")


def retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each match's next attempt is due, and the 40 longest overdue."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 18).cast("int").alias("attempts"), F.col("o_custkey"))
    at = o.withColumn("next_attempt_ms", F.lit(NOW_MS - 600_000) + F.col("o_custkey") * 1000 + ingest.retry_delay_ms(F.col("attempts")))
    return ingest.due_retries(at, NOW_MS, 40).select("id", "attempts", "next_attempt_ms")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New list entries win over retries of the same match."""
    s = match_documents(spark, sf_dir).select("summary")
    again = s.filter("summary.id % 3 != 1").withColumn("summary", F.col("summary").withField("title", F.lit("again")))
    return documents.merge_candidates(s.filter("summary.id % 2 = 0"), again).select("id", "summary.title")


def training_rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return mlops.snapshot_rows(t["features_player_match"], t["features_player_recent_form"], t["logs_base"], columns=list(columns))


def _summed(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    out = None
    for name, df in parts:
        one = df.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.min("match_time").alias("first_at"), F.max("match_time").alias("last_at"), F.sum("logid").alias("logids"), F.sum("kills").alias("kills"))
        out = one if out is None else out.unionAll(one)
    return out


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = training.split_time(training_rows(spark, sf_dir, "match_time", "logid", "steamid", "kills"), 0.8)
    return _summed([("train", a), ("test", b)])


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir, "match_time", "logid", "steamid", "kills")
    return _summed([p for name, a, b in training.temporal_folds(rows, 100, 20) for p in ((f"{name}_train", a), (f"{name}_val", b))])


def clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers clipped to their 1% and 99% quantiles, rare maps as one, summed by map."""
    rows = training_rows(spark, sf_dir, "map", "kills", "damage_dealt").select("map", F.col("kills").cast("double"), F.col("damage_dealt").cast("double"))
    got = training.FeatureQuality(["kills", "damage_dealt"], min_count=60).fit(rows).transform(rows)
    return got.groupBy("map").agg(F.count("*").alias("n"), rnd(F.sum("kills"), 4).alias("kills"), rnd(F.sum("damage_dealt"), 2).alias("damage_dealt"))


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = metrics.choose_threshold(metrics.threshold_table(ml_queries.scored(spark, sf_dir), ml_queries.THRESHOLDS), 0.3, 0.6)
    return spark.createDataFrame([(r.threshold, bool(r.selected_by_constraints))], "threshold double, met boolean")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    return read("documents").join(read("labels"), "doc_id").select("text", "toxic")


def telling_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 40 words that tell most about the label of the texts that have one."""
    got = sentiment.word_counts(_labelled(spark, sf_dir), "text", "toxic").withColumn("mi", rnd("mi", 9))
    return got.orderBy(F.desc("mi"), "word").limit(40)


def model_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative messages by speaker, as the model of the labelled texts scores them. Without a model there is no result: a
    lexicon's numbers would look like the model's."""
    scorer = sentiment.fit(_labelled(spark, sf_dir), "text", "toxic").scorer()
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select("role", scorer(F.col("text")).alias("label")).groupBy("role").agg(F.count("*").alias("messages"), times(F.col("label") == "negative").alias("negative"))


STUMP = ("kills", "deaths", "assists")


def boosted_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chances of winning after one round of boosting at depth one, with an L2 penalty, and how many rows have each."""
    rows = Tables(spark, sf_dir, catalogue.LEXICON)["features_player_match"].select(*[F.col(c).cast("double") for c in STUMP], "won_game")
    made = VectorAssembler(inputCols=list(STUMP), outputCol="features").transform(rows)
    model = boosting.HistogramBoosting("won_game", rounds=1, depth=1, stop_above=None).fit(made)
    return model.transform(made).groupBy(rnd(vector_to_array("probability")[1], 6).alias("p")).agg(F.count("*").alias("n"))


REFRESHED = ("features_player_match", "features_player_recent_form", "serving_player_profiles", "serving_map_overview_daily", "serving_player_match_deep_dive")


def refreshed_store(spark: SparkSession, sf_dir: str, steps: str | list[str]) -> TableStore:
    """A store of its own after a full run on early deliveries and an incremental one on all. Where the map overview
    alone follows the player rows, these are written with what it takes."""
    takes = serving.OVERVIEW_TAKES if steps == Runner.steps_for("serving_map_overview_daily") else None
    cut = F.lit(datetime.datetime(2001, 6, 1))
    store, every, early = TableStore(spark, work_folder(spark)), Tables(spark, sf_dir, catalogue.LEXICON), Tables(spark, sf_dir, catalogue.LEXICON)
    for n in ("logs", "summaries"):
        early.replace(n, every[n].filter(F.col("match_time") < cut))
    Runner(early, store, FULL, buckets=4, keep=1, takes=takes).run(steps)
    Runner(every, store, INCREMENTAL, refresh_days=90, keep=1, takes=takes).run(steps)
    return store


def refreshed(spark: SparkSession, sf_dir: str, *, table: str) -> DataFrame:
    """A published table after both runs, of the steps that it needs: it is as if built at once."""
    steps = Runner.steps_for(table)
    return refreshed_store(spark, sf_dir, steps).read(table).drop("updated_at")


def maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map overview after its files have been merged and all older versions dropped. The tables that it was made of
    go before the merge, as nothing reads them any more."""
    name = "serving_map_overview_daily"
    store = refreshed_store(spark, sf_dir, Runner.steps_for(name))
    for n in ("logs_base", "summaries_base", "messages_base", "features_player_match", "refresh_players_before"):
        store.drop(n)
    with tidy_shuffles(spark):
        store.compact(name)
    store.expire(name)
    return store.read(name).drop("updated_at")


def form_in_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling form with every player's line cut into chunks of about 100 matches. What it takes of the player rows is
    written first, as chunks are counted and cut in several passes."""
    name, store = "features_player_match", TableStore(spark, work_folder(spark))
    with tidy_shuffles(spark):
        store.overwrite(name, Tables(spark, sf_dir, catalogue.LEXICON)[name].select(*features.FORM_TAKES))
        rows = store.read(name)
        return features.recent_form(rows, hot=rolling.hot_keys(rows, "steamid", 100), chunk=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "r_recent_form_in_chunks": form_in_chunks,
    "r_maintained_map_overview": maintained,
    **{f"i_{k[:-1] if k != 'summaries' else 'summary'}_records": partial(records, kind=k) for k in documents.RECORDS},
    "i_failed_documents": failed,
    "i_list_entries": strict_list,
    "i_due_retries": retries,
    "i_merged_candidates": candidates,
    "m_split": split,
    "m_folds": folds,
    "m_feature_quality": clipped,
    "m_threshold": best_threshold,
    "m_boosted_stump": boosted_stump,
    "m_telling_words": telling_words,
    "s_model_chat": model_chat,
    **{f"r_{n}": partial(refreshed, table=n) for n in REFRESHED},
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


#: Of line items with one number in one order the first by value is the player.
_LINES = "(select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_quantity, l_extendedprice, l_linestatus) = 1)"
_GOOD = "o_orderkey % 50 not in (0, 1)"
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.000Z')"
_META = f"""o_orderkey as logid, case when o_orderkey % 4 = 0 then 'match ' || o_orderkey else 'list ' || o_orderkey end as title,
  case when o_orderkey % 5 = 0 then 'cp_own' else o_orderpriority end as map, cast(epoch(o_orderdate) as bigint) as sourcedateepochseconds,
  {_ISO.format('o_orderdate')} as sourcedateiso, '2001-08-01T00:00:00.000Z' as ingestedat"""
_ROWS = oracle.compose("select match_time, logid, steamid, map, kills, damage_dealt from features_player_match m", "features_player_match")
_NUMBERED = f"with t as ({_ROWS}), a as (select *, row_number() over (order by match_time, logid, steamid) - 1 as place, count(*) over () as n from t)"
_SUMS = "count(*) as n, min(match_time) as first_at, max(match_time) as last_at, cast(sum(logid) as bigint) as logids, cast(sum(kills) as bigint) as kills"
_DUE = f"cast({NOW_MS - 600_000} + o_custkey * 1000 + cast(least(10000.0 * pow(2.0, greatest(o_orderkey % 18 - 1, 0)), 21600000.0) as bigint) as bigint)"
_CHOICE = ", ".join(f"({t})" for t in ml_queries.THRESHOLDS)

SQL: dict[str, str] = {
    "r_recent_form_in_chunks": oracle.SQL["x_t_features_player_recent_form"],
    "r_maintained_map_overview": f"select * exclude (updated_at) from ({oracle.SQL['x_t_serving_map_overview_daily']}) x",
    "i_log_records": f"""select cast(o_orderkey as varchar) as recordid, {_META}, coalesce(n, 0) as sourceplayercount, o_custkey as sourceviewcount,
  case when o_orderkey % 2 = 0 then o_orderkey % 3600 else 1800 end as durationseconds, red as redscore, blue as bluescore,
  case o_orderkey % 3 when 0 then '' when 1 then 'u' else 'o' end || o_custkey as uploadersteamid, cast(3 as bigint) as payloadschemaversion
  from orders left join (select l_orderkey, count(*) as n, count(*) filter (l_linestatus = 'O') as red, count(*) filter (l_linestatus = 'F') as blue from {_LINES} x group by 1) l on o_orderkey = l_orderkey where {_GOOD}""",
    "i_message_records": f"""select o_orderkey || ':' || i as recordid, {_META}, i as messageindex, case when turn <> 1 then 'p' || turn end as steamid, role as playername,
  trim(text, ' ') as message, lower(trim(text, ' ')) as messagelower from orders join (select *, row_number() over (partition by conv_id order by turn) - 1 as i from conversations) c on o_orderkey = conv_id
  where {_GOOD} and turn % 3 <> 2 and trim(text, ' ') <> ''""",
    "i_summary_records": f"""select o_orderkey || ':p' || l_linenumber as recordid, {_META}, 'p' || l_linenumber as steamid, case when l_linestatus = 'O' then 'Red' when l_linenumber <> 3 then 'Blue' end as team,
  cast(floor(l_quantity) as bigint) as kills, cast(null as bigint) as assists, cast(null as bigint) as deaths, case when l_linenumber % 2 = 0 then cast(floor(l_extendedprice) as bigint) end as damagedealt,
  cast(null as bigint) as damagetaken, cast(null as bigint) as healingdone, cast(null as bigint) as ubersused, case when l_linenumber <> 2 then 'scout,' || l_linestatus end as classesplayedcsv
  from orders join {_LINES} x on o_orderkey = l_orderkey where {_GOOD}""",
    "i_failed_documents": "select o_orderkey as id, case o_orderkey % 50 when 0 then 'the source returned success=false for a match' else 'no match document' end as error from orders where o_orderkey % 50 in (0, 1)",
    "i_list_entries": f"""select o_orderkey // 10 as "offset", cast(row_number() over (partition by o_orderkey // 10 order by o_orderkey) - 1 as integer) as position, o_orderkey as id, 'list ' || o_orderkey as title,
  o_orderpriority as map, cast(epoch(o_orderdate) as bigint) as date, o_custkey as views, coalesce(n, 0) as players from orders left join (select l_orderkey, count(*) as n from {_LINES} x group by 1) l on o_orderkey = l_orderkey""",
    "i_due_retries": f"select o_orderkey as id, cast(o_orderkey % 18 as integer) as attempts, {_DUE} as next_attempt_ms from orders where {_DUE} <= {NOW_MS} order by next_attempt_ms, id limit 40",
    "i_merged_candidates": "select o_orderkey as id, case when o_orderkey % 2 = 0 then 'list ' || o_orderkey else 'again' end as title from orders where o_orderkey % 2 = 0 or o_orderkey % 3 <> 1",
    "m_split": f"{_NUMBERED} select case when place < floor(n * 0.8) then 'train' else 'test' end as part, {_SUMS} from a group by 1",
    "m_folds": _NUMBERED + " " + " union all ".join(
        f"select '{name}_{part}' as part, {_SUMS} from a where place >= {lo} and place < {hi}"
        for name, end, more in training.FOLDS
        for part, lo, hi in (("train", "0", f"floor(n * {end})"), ("val", f"floor(n * {end})", f"least(n, floor(n * {end}) + floor(n * {more}))"))
    ),
    "m_feature_quality": f"""with t as ({_ROWS}), q as (select quantile_cont(kills::double, 0.01) as k1, quantile_cont(kills::double, 0.99) as k2, quantile_cont(damage_dealt::double, 0.01) as d1, quantile_cont(damage_dealt::double, 0.99) as d2 from t),
  f as (select map from t group by map having count(*) >= 60) select case when t.map in (select map from f) then t.map else '__OTHER__' end as map, count(*) as n,
  {oracle.r('sum(least(greatest(kills::double, k1), k2))', 4)} as kills, {oracle.r('sum(least(greatest(damage_dealt::double, d1), d2))', 2)} as damage_dealt from t, q group by 1""",
    "m_boosted_stump": oracle.compose(f"""select {oracle.r('1 / (1 + exp(-(base + w)))', 6)} as p, count(*) as n from (
  with t as (select *, row_number() over () as id from (select {', '.join(f'{c}::double as f{k}' for k, c in enumerate(STUMP))}, won_game::double as y from features_player_match) x),
  b as (select avg(y) as m, ln(avg(y) / (1 - avg(y))) as base from t),
  v as ({' union all '.join(f'select {k} as f, f{k} as v, y from t' for k in range(len(STUMP)))}),
  c as (select f, v, sum(m - y) as g, sum(m * (1 - m)) as h, count(*) as n from v, b group by f, v),
  s as (select f, v, sum(g) over l as gl, sum(h) over l as hl, sum(n) over l as nl, sum(g) over w as g, sum(h) over w as h, sum(n) over w as n from c
    window l as (partition by f order by v rows unbounded preceding), w as (partition by f)),
  k as (select *, gl * gl / (hl + 0.1) + (g - gl) * (g - gl) / (h - hl + 0.1) - g * g / (h + 0.1) as gain from s where nl >= 250 and n - nl >= 250),
  best as (select * from k where gain >= (select max(gain) from k) * (1 - 1e-9) and gain > 1e-12 order by f, v limit 1)
  select base, coalesce(case when case best.f {' '.join(f'when {k} then f{k}' for k in range(len(STUMP)))} end <= best.v then -0.05 * gl / (hl + 0.1) else -0.05 * (g - gl) / (h - hl + 0.1) end, 0.0) as w
  from t cross join b left join best on true) q group by 1""", "features_player_match"),
    "m_telling_words": f"""with t as (select row_number() over () as id, toxic::int as y, regexp_extract_all(replace(lower(coalesce(text, '')), chr(39), ''), '{sentiment.PIECE}') as p
   from documents join labels using (doc_id) where toxic is not null),
  u as (select id, y, p, unnest(range(1, len(p) + 1)) as i from t),
  w as (select distinct id, y, case when list_has_any(string_split(regexp_replace(array_to_string(p[greatest(i - {sentiment.REACH}, 1) : i - 1], ' '), '^.*[.,;:!?]', ''), ' '), {list(sentiment.NEGATORS)}) then 'not_' else '' end || p[i] as word
   from u where regexp_matches(p[i], '^[a-z]')),
  n as (select count(*)::double as n, sum(y)::double as n1 from t),
  c as (select word, sum(y)::double as a, count(*) - sum(y)::double as b, n, n1, n - n1 as n0 from w, n group by word, n, n1),
  m as (select word, a, b, {' + '.join(f"case when {x} > 0 then ({x}) / n * ln(({x}) * n / (({r}) * {k})) else 0 end" for x, r, k in (('a', 'a + b', 'n1'), ('b', 'a + b', 'n0'), ('n1 - a', 'n - a - b', 'n1'), ('n0 - b', 'n - a - b', 'n0')))} as mi from c)
  select word, cast(a as bigint) as pos, cast(b as bigint) as neg, {oracle.r('mi', 9)} as mi from m order by mi desc, word limit 40""",
    "m_threshold": f"""with s as (select cast({ml_queries._SCORE} as double) as p, cast(toxic as integer) as y from labels), c(t) as (values {_CHOICE}),
  h as (select t, count(*) filter (p >= t) as hit, coalesce(sum(y) filter (p >= t), 0) as tp, sum(y) as pos from s, c group by t),
  m as (select t, coalesce({oracle.ratio('tp', 'hit')}, 0) as pr, coalesce({oracle.ratio('tp', 'pos')}, 0) as re, coalesce({oracle.ratio('2 * tp', 'hit + pos')}, 0) as f1 from h)
  select cast(t as double) as threshold, pr >= 0.3 and re >= 0.6 as met from m order by met desc, f1 desc, pr desc, re desc, t limit 1""",
    **{f"r_{n}": f"select * exclude (updated_at) from ({oracle.SQL['x_t_' + n]}) x" for n in REFRESHED if n.startswith("serving")},
    **{f"r_{n}": oracle.SQL["x_t_" + n] for n in REFRESHED if n.startswith("features")},
}
