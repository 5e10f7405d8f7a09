"""Nested match documents: parsing, validation and normalisation into the three record streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LOGS, MESSAGES, SUMMARIES, conform

SUMMARY = "struct<id:bigint,title:string,map:string,date:bigint,views:bigint,players:bigint>"
LIST = f"success boolean, results bigint, total bigint, parameters map<string,string>, logs array<{SUMMARY}>"
DETAIL = (
    "success boolean, version bigint, length bigint, info struct<map:string,date:bigint,title:string,total_length:bigint,uploader:string>, "
    "teams map<string,struct<score:bigint,kills:bigint,deaths:bigint,dmg:bigint,charges:bigint,drops:bigint,firstcaps:bigint,caps:bigint>>, "
    "players map<string,struct<team:string,kills:bigint,assists:bigint,deaths:bigint,dmg:bigint,dt:bigint,heal:bigint,ubers:bigint,class_stats:array<struct<type:string>>>>, "
    "chat array<struct<steamid:string,name:string,msg:string>>"
)


def parse_list(pages: DataFrame, col: str = "value") -> DataFrame:
    """Rows (offset, summary, ...) of list pages, in page order. Strict: a missing or mistyped required field
    raises an error that names it."""
    page = pages.withColumn("_p", F.from_json(col, LIST, {"mode": "PERMISSIVE"}))
    need = lambda ok, path: F.when(~F.coalesce(ok, F.lit(False)), F.raise_error(F.lit(f"wrong or missing value at {path}")))
    for path, c in (("success", "_p.success"), ("results", "_p.results"), ("total", "_p.total"), ("logs", "_p.logs")):
        page = page.withColumn("_p", F.coalesce(need(F.col(c).isNotNull(), path).cast(page.schema["_p"].dataType), F.col("_p")))
    rows = page.select(*[c for c in pages.columns if c != col], F.posexplode("_p.logs").alias("position", "summary"))
    for f in ("id", "title", "map", "date", "views", "players"):
        rows = rows.withColumn("summary", F.coalesce(need(F.col(f"summary.{f}").isNotNull(), f"logs[].{f}").cast(rows.schema["summary"].dataType), F.col("summary")))
    return rows


def parse_details(docs: DataFrame, col: str = "detail", strict: bool = True) -> DataFrame:
    """Adds ``d``, the parsed detail, and ``error``. Optional fields are lenient; a document that is no object or
    has no success is an error, which raises if ``strict``."""
    got = docs.withColumn("d", F.from_json(col, DETAIL, {"mode": "PERMISSIVE"}))
    ok = F.coalesce(F.col("d.success"), F.lit(False))
    said = F.when(F.col("d").isNull() | F.col("d.success").isNull(), F.lit("no match document")).when(~ok, F.lit("the source returned success=false for a match"))
    if "error" in docs.columns:
        said = F.coalesce(F.col("error"), said)
    got = got.withColumn("error", said)
    if strict:
        got = got.withColumn("d", F.when(F.col("error").isNull(), F.col("d")).otherwise(F.raise_error(F.col("error")).cast(got.schema["d"].dataType)))
    return got


def iso(epoch: Column) -> Column:
    """The epoch second in UTC, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(epoch), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def uploader(c: str) -> Column:
    """A number, a text or an object with an id; all as the id's text."""
    return F.when(F.col(c).startswith("{"), F.get_json_object(c, "$.id")).otherwise(F.col(c))


def _meta() -> dict[str, Column]:
    date = F.coalesce("d.info.date", "summary.date")
    return {
        "logid": F.col("summary.id"),
        "title": F.coalesce("d.info.title", "summary.title"),
        "map": F.coalesce("d.info.map", "summary.map"),
        "sourcedateepochseconds": date,
        "sourcedateiso": iso(date),
    }


def _stamped(df: DataFrame, ddl: str, now: Column) -> DataFrame:
    return conform(df.withColumns({"ingestedat": F.date_format(F.to_utc_timestamp(now, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), "__ingest_ts": now}), ddl)


def log_records(parsed: DataFrame, now: Column) -> DataFrame:
    got = parsed.select(
        F.col("summary.id").cast("string").alias("recordid"),
        *[c.alias(n) for n, c in _meta().items()],
        F.col("summary.players").alias("sourceplayercount"),
        F.col("summary.views").alias("sourceviewcount"),
        F.coalesce("d.length", "d.info.total_length").alias("durationseconds"),
        F.col("d.teams")["Red"]["score"].alias("redscore"),
        F.col("d.teams")["Blue"]["score"].alias("bluescore"),
        uploader("d.info.uploader").alias("uploadersteamid"),
        F.col("d.version").alias("payloadschemaversion"),
    )
    return _stamped(got, LOGS, now)


def message_records(parsed: DataFrame, now: Column) -> DataFrame:
    """A row for each message that is not blank; its index is the place among all entries."""
    rows = parsed.select("*", F.posexplode("d.chat").alias("messageindex", "entry")).withColumn("message", F.trim(F.col("entry.msg"))).filter("message <> ''")
    got = rows.select(
        F.concat_ws(":", "summary.id", "messageindex").alias("recordid"),
        *[c.alias(n) for n, c in _meta().items()],
        "messageindex",
        F.col("entry.steamid").alias("steamid"),
        F.col("entry.name").alias("playername"),
        "message",
        F.lower("message").alias("messagelower"),
    )
    return _stamped(got, MESSAGES, now)


def classes_csv(stats: Column) -> Column:
    """Distinct class names in order; null without any."""
    names = F.array_distinct(F.filter(F.transform(stats, lambda s: s["type"]), lambda t: t.isNotNull() & (t != "")))
    return F.when(F.size(names) > 0, F.array_join(names, ","))


def summary_records(parsed: DataFrame, now: Column) -> DataFrame:
    rows = parsed.select("*", F.explode("d.players").alias("steamid", "p")).filter(F.col("p").isNotNull())
    got = rows.select(
        F.concat_ws(":", "summary.id", "steamid").alias("recordid"),
        *[c.alias(n) for n, c in _meta().items()],
        "steamid",
        F.col("p.team").alias("team"),
        *[F.col(f"p.{a}").alias(b) for a, b in (("kills", "kills"), ("assists", "assists"), ("deaths", "deaths"), ("dmg", "damagedealt"), ("dt", "damagetaken"), ("heal", "healingdone"), ("ubers", "ubersused"))],
        classes_csv(F.col("p.class_stats")).alias("classesplayedcsv"),
    )
    return _stamped(got, SUMMARIES, now)


RECORDS = {"logs": log_records, "messages": message_records, "summaries": summary_records}


def merge_candidates(new: DataFrame, retries: DataFrame) -> DataFrame:
    """Summaries by ascending id, one per id; a new one wins over a retry."""
    both = retries.select("summary", F.lit(0).alias("_new")).unionByName(new.select("summary", F.lit(1).alias("_new")))
    return both.groupBy(F.col("summary.id").alias("id")).agg(F.max_by("summary", "_new").alias("summary")).orderBy("id")
