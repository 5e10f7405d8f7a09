"""Ingest of match documents: a scheduled batch with retry state, and a structured stream.

Both fan a document out into the three record streams. Delivery is at least once per dataset; a record's id
makes later deduplication exact. Documents that fail go to a failure table and come back when due; none is
ever dropped from it.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.store import TableStore
from ..sources.documents import RECORDS, SUMMARY, merge_candidates, parse_details

DATASETS = tuple(RECORDS)
FAILURES = f"id bigint, summary {SUMMARY}, attempts int, next_attempt_ms bigint, last_error string, " + ", ".join(f"delivered_{d} boolean" for d in DATASETS)


def retry_delay_ms(attempts: Column) -> Column:
    """Ten seconds, doubled with each attempt, six hours at most."""
    return F.least(F.lit(10_000.0) * F.pow(F.lit(2.0), F.greatest(attempts - 1, F.lit(0))), F.lit(21_600_000.0)).cast("long")


def due_retries(failures: DataFrame, now_ms: int, most: int) -> DataFrame:
    """Failures whose time has come, the longest waiting first; ``most`` of them, the rest stay for later runs."""
    return failures.filter(F.col("next_attempt_ms") <= now_ms).orderBy("next_attempt_ms", "id").limit(most)


@dataclass
class State:
    last_id: int = 0
    updated_at: str = ""

    @classmethod
    def parse(cls, raw: str | None, now: str) -> State:
        """Anything that is no valid state counts as the first run."""
        try:
            got = json.loads(raw or "")
            return cls(int(float(got["last_id"])), got["updated_at"] if isinstance(got.get("updated_at"), str) else now)
        except (ValueError, TypeError, KeyError):
            return cls(0, now)


@dataclass
class Result:
    new: int
    retried: int
    emitted: dict[str, int]
    failed: int
    last_id: int


class BatchIngest:
    """One run takes new summaries and due retries, fetches their details and appends records.

    ``fetch`` gives (id, detail, error) for a frame of ids, in whatever way and with its own retries; ``sink``
    appends a frame to a dataset and may raise. A dataset that was delivered before a failure is not sent again.
    """

    def __init__(self, store: TableStore, fetch: Callable[[DataFrame], DataFrame], sink: Callable[[str, DataFrame], int] | None = None, most_retries: int = 50, on_event: Callable[[str, dict], None] = lambda kind, facts: None):
        self.store, self.spark, self.fetch = store, store.spark, fetch
        self.sink = sink or self._append
        self.most_retries, self.on_event = most_retries, on_event

    def _append(self, name: str, rows: DataFrame) -> int:
        return self.store.written(name, self.store.append(name, rows))

    def failures(self) -> DataFrame:
        return self.store.read("ingest_failures") if self.store.exists("ingest_failures") else self.spark.createDataFrame([], FAILURES)

    def state(self, now: datetime.datetime) -> State:
        raw = self.store.read("ingest_state").orderBy(F.desc("version")).first().value if self.store.exists("ingest_state") else None
        return State.parse(raw, now.isoformat())

    def run(self, listed: DataFrame, now: datetime.datetime, dry_run: bool = False, full_history: bool = False) -> Result:
        """``listed``: rows (summary). A dry run reads and parses but changes nothing."""
        facts = {"mode": "full-history" if full_history else "incremental", "dry_run": dry_run}
        self.on_event("START", facts)
        try:
            got = self._run(listed, now, dry_run, full_history)
        except Exception as e:
            self.on_event("FAIL", {**facts, "error": str(e)[:500]})
            raise
        self.on_event("COMPLETE", {**facts, **got.__dict__})
        return got

    def _run(self, listed: DataFrame, now: datetime.datetime, dry_run: bool, full_history: bool) -> Result:
        state, failures = self.state(now), self.failures()
        now_ms = int(now.replace(tzinfo=now.tzinfo or datetime.timezone.utc).timestamp() * 1000)
        ids = failures.select("id")
        fresh = listed.select("summary").withColumn("id", F.col("summary.id"))
        if not full_history:
            fresh = fresh.filter(F.col("id") > state.last_id).join(ids, "id", "left_anti")
        retries = failures.limit(0) if full_history else due_retries(failures, now_ms, self.most_retries)
        candidates = merge_candidates(fresh, retries).join(failures.drop("summary"), "id", "left")
        parsed = parse_details(candidates.join(self.fetch(candidates.select("id")), "id", "left"), strict=False).persist()
        try:
            new, retried = fresh.select("id").distinct().count(), retries.count()
            if dry_run:
                return Result(new, retried, dict.fromkeys(DATASETS, 0), failures.count(), state.last_id)
            good, emitted, undelivered = parsed.filter("error is null"), {}, {}
            for name, make in RECORDS.items():
                rows = make(good.filter(~F.coalesce(f"delivered_{name}", F.lit(False))), F.lit(now).cast("timestamp"))
                try:
                    emitted[name] = self.sink(name, rows)
                except Exception as e:  # the other datasets of this run still go out; this one is sent again
                    emitted[name], undelivered[name] = 0, str(e)[:500]
            failed = parsed.withColumns({f"delivered_{d}": F.coalesce(f"delivered_{d}", F.lit(False)) | (F.col("error").isNull() & F.lit(d not in undelivered)) for d in DATASETS})
            if undelivered:
                failed = failed.withColumn("error", F.coalesce("error", F.lit("; ".join(f"{k}: {v}" for k, v in undelivered.items()))))
            attempts = F.coalesce("attempts", F.lit(0)) + 1
            again = failed.filter("error is not null").select("id", "summary", attempts.cast("int").alias("attempts"), (F.lit(now_ms) + retry_delay_ms(attempts)).alias("next_attempt_ms"), F.col("error").alias("last_error"), *[f"delivered_{d}" for d in DATASETS])
            if not self.store.exists("ingest_failures"):
                self.store.overwrite("ingest_failures", failures)
            self.store.replace_keys("ingest_failures", again, ["id"], candidates.select("id"))
            top = (failed.filter("error is null").agg(F.max("id")).first()[0] or 0) if not undelivered else 0
            state = State(max(state.last_id, top), now.isoformat())
            version = (self.store.versions("ingest_state") or [0])[-1] + 1
            self.store.overwrite("ingest_state", self.spark.createDataFrame([(version, json.dumps(state.__dict__))], "version long, value string"))
            return Result(new, retried, emitted, self.failures().count(), state.last_id)
        finally:
            parsed.unpersist()


def stream_documents(spark: SparkSession, landing: str, max_files: int = 100) -> DataFrame:
    """A stream of landed files of lines {"summary": {...}, "detail": {...}}; the detail stays text until parsed."""
    rows = spark.readStream.schema("value string").option("maxFilesPerTrigger", max_files).text(landing)
    return rows.select(F.from_json("value", f"summary {SUMMARY}, detail string").alias("r")).select("r.*")


def fan_out(out: str, now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: three projections of one parsed batch and its failures. A batch's folder is named by
    its id and overwritten, so a batch that runs twice is written once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_details(batch, strict=False).persist()
        try:
            stamp = now if now is not None else F.current_timestamp()
            good = parsed.filter("error is null")
            for name, make in RECORDS.items():
                make(good, stamp).write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")
            parsed.filter("error is not null").select("summary", "detail", "error").write.mode("overwrite").parquet(f"{out}/failures/batch={batch_id}")
        finally:
            parsed.unpersist()

    return write


def start_ingest(spark: SparkSession, landing: str, out: str, checkpoint: str, every: str | None = None):
    """Runs over all that has landed and stops, or goes on at the given interval."""
    w = stream_documents(spark, landing).writeStream.foreachBatch(fan_out(out)).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def deduplicated(stream: DataFrame, key: str = "recordid", time: str = "__ingest_ts", late: str = "7 days") -> DataFrame:
    """First delivery of each record within the watermark; state older than that is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def daily_activity(stream: DataFrame, time: str = "__ingest_ts", late: str = "7 days") -> DataFrame:
    """Records per map and day of a stream, each day final once the watermark has passed it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 day"), "map").agg(F.count("*").alias("records"))
