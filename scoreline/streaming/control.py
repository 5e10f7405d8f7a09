"""Ways to start an ingest: one tick, a dry run, a full history in chained steps; and a command line for them."""

from __future__ import annotations

import argparse
import datetime
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.lineage import Lineage
from ..plans.store import TableStore, retry_on_conflict
from ..sources.documents import SUMMARY
from ..sources.paging import Collected, Fetch, collect, plan_oldest, read_page, read_stretch, with_retries
from ..sources.sink import MOST, record_sink
from .ingest import BatchIngest, Result


def pages_of(path: str, attempts: int = 3) -> Fetch:
    """Pages of a folder or URL template; a page that is not there is an empty one."""
    return lambda offset: with_retries(lambda: json.loads(read_page(path, offset) or '{"logs": []}'), attempts)


def details_of(spark: SparkSession, path: str):
    """Details from files ``<id>.json`` of a folder that Spark can read; an id without a file is an error of its own."""

    def fetch(ids: DataFrame) -> DataFrame:
        files = spark.read.option("wholetext", True).text(f"{path}/*.json").select(F.regexp_extract("_metadata.file_name", r"^(\d+)\.json$", 1).try_cast("long").alias("id"), F.col("value").alias("detail"))
        return ids.join(files, "id", "left").select("id", "detail", F.when(F.col("detail").isNull(), "no detail found").alias("error"))

    return fetch


def _frame(spark: SparkSession, got: Collected) -> DataFrame:
    return spark.createDataFrame([(s,) for s in got.summaries], f"summary {SUMMARY}")


def tick(ingest: BatchIngest, fetch: Fetch, page_size: int, now: datetime.datetime, max_pages: int = 10, dry_run: bool = False) -> Result:
    """What is new since the last run, and due retries. A backlog is worked off from its old end, ``max_pages`` pages a
    step, so that no more than these are held, and the last known id never passes an entry that is yet to be read."""
    done, at = None, ingest.state(now).last_id
    while done is None or parts:
        parts = plan_oldest(fetch, page_size, at, max_pages)
        if done is not None and not parts:
            break
        entries = [s for p in parts for s in read_stretch(fetch, page_size, p)]
        got = ingest.run(_frame(ingest.spark, Collected(entries, None)), now, dry_run)
        done = got if done is None else _sum(done, got, dry_run)
        at = parts[-1].high if parts else at
    return done


def _sum(a: Result, b: Result, dry_run: bool) -> Result:
    retried = a.retried if dry_run else a.retried + b.retried  # a dry run leaves retries due
    return Result(a.new + b.new, retried, {k: a.emitted[k] + b.emitted[k] for k in a.emitted}, b.failed, b.last_id)


def full_history(ingest: BatchIngest, fetch: Fetch, page_size: int, now: datetime.datetime, start: int = 0, max_pages: int = 10) -> list[Result]:
    """Steps of ``max_pages`` pages, each handing its next offset to the following one, until the list ends."""
    out, offset = [], max(0, start)
    while offset is not None:
        got = collect(fetch, page_size, offset, max_pages)
        out.append(ingest.run(_frame(ingest.spark, got), now, full_history=True))
        offset = got.next_offset
    return out


QUEUE = "backfill_queue"


def offset_of(message) -> int | None:
    """The offset that a message of the queue asks for; None if it is no such message."""
    if not isinstance(message, dict) or message.get("mode") != "full-history":
        return None
    at = message.get("offset")
    return at if isinstance(at, int) and not isinstance(at, bool) and at >= 0 else None


def enqueue(store: TableStore, offset: int) -> None:
    message = json.dumps({"mode": "full-history", "offset": offset})
    retry_on_conflict(lambda: store.append(QUEUE, store.spark.createDataFrame([(message,)], "message string")))


def work_queue(ingest: BatchIngest, fetch: Fetch, page_size: int, now: datetime.datetime, max_pages: int = 10, steps: int = 1) -> list[Result]:
    """Takes up to ``steps`` messages off the queue, one ingest each; a step that does not reach the list's end puts the
    next offset on the queue, for whichever run comes next. A message stays until its step is done; one that is no
    message is dropped; messages that others queue meanwhile stay."""
    store, out = ingest.store, []
    for _ in range(steps):
        first = store.read(QUEUE).limit(1).collect() if store.exists(QUEUE) else []
        if not first:
            break
        try:
            offset = offset_of(json.loads(first[0].message))
        except ValueError:
            offset = None
        more = None
        if offset is not None:
            got = collect(fetch, page_size, offset, max_pages)
            out.append(ingest.run(_frame(ingest.spark, got), now, full_history=True))
            more = got.next_offset
        retry_on_conflict(lambda: _replace_message(store, first[0].message, more))
    return out


def _replace_message(store: TableStore, message: str, more: int | None) -> int:
    """One message of this text goes, the next offset comes, upon the queue as it is now; a writer that is faster makes
    this a conflict."""
    base = store.versions(QUEUE)[-1]
    rows = store.read(QUEUE, base)
    one = Window.partitionBy("message").orderBy(F.lit(0))
    rest = rows.withColumn("_n", F.row_number().over(one)).filter((F.col("message") != message) | (F.col("_n") > 1)).select("message")
    new = [(json.dumps({"mode": "full-history", "offset": more}),)] if more is not None else []
    return store.overwrite(QUEUE, rest.union(store.spark.createDataFrame(new, "message string")), base=base)


def health(store: TableStore, now: datetime.datetime) -> dict:
    ingest = BatchIngest(store, lambda ids: ids)
    state = ingest.state(now)
    return {"ok": True, "last_id": state.last_id, "updated_at": state.updated_at, "failed": ingest.failures().count()}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Ingest match documents")
    p.add_argument("mode", choices=("health", "dry-run", "ingest", "full-history", "enqueue", "work"))
    p.add_argument("store")
    p.add_argument("--pages", help="folder of list pages or URL template with {offset}")
    p.add_argument("--details", help="folder of details <id>.json")
    p.add_argument("--page-size", type=int, default=100)
    p.add_argument("--max-pages", type=int, default=10)
    p.add_argument("--start", type=int, default=0)
    p.add_argument("--events", help="file that gets run events, a line each")
    p.add_argument("--sink", help="folder or URL that records are sent to, below it by dataset; without it they go to the store")
    p.add_argument("--most", type=int, default=MOST, help="records of one send")
    a = p.parse_args(argv)
    from ..session import build_session

    spark, now = build_session("ingest"), datetime.datetime.now(datetime.timezone.utc)
    store = TableStore(spark, a.store)
    if a.mode == "health":
        print(json.dumps(health(store, now)))
        return

    if a.mode == "enqueue":
        enqueue(store, max(0, a.start))
        return

    def send(event: dict) -> None:
        with open(a.events, "a", encoding="utf-8") as f:
            f.write(json.dumps(event) + "\n")

    sink = record_sink(a.sink, a.most) if a.sink else None
    ingest = BatchIngest(store, details_of(spark, a.details), sink, on_event=Lineage(send) if a.events else lambda kind, facts: None)
    if a.mode == "full-history":
        got = full_history(ingest, pages_of(a.pages), a.page_size, now, a.start, a.max_pages)
    elif a.mode == "work":
        got = work_queue(ingest, pages_of(a.pages), a.page_size, now, a.max_pages)
    else:
        got = [tick(ingest, pages_of(a.pages), a.page_size, now, a.max_pages, a.mode == "dry-run")]
    print(json.dumps([r.__dict__ for r in got]))


if __name__ == "__main__":
    main()
