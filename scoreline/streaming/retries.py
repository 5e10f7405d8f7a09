"""Delivery of listed matches as a stream that keeps what has failed in its own state.

The state holds, for each match that is not delivered yet, its summary, the attempts so far, when it is due and
which datasets have it. A match comes out of the stateful step when it is first listed and whenever its timer says
that it is due; ``foreachBatch`` fetches, parses and sends it, and what came of that goes to a folder of outcomes,
which the stream reads beside the list. So a restart finds attempts, times and flags where they were, and nothing is
dropped until all datasets have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..session import let_workers_import
from ..sources.documents import RECORDS, SUMMARY, parse_details

DATASETS = tuple(RECORDS)
#: What goes into the stateful step: list entries, and outcomes of attempts. ``delivered``: names, joined by commas.
EVENT = "id long, kind string, summary string, error string, delivered string"
LISTED, DONE, FAILED, LATER = "listed", "done", "failed", "later"
#: What comes out: a match to be fetched now.
DUE = "id long, summary string, attempts int, delivered string, due_ms long"
WAITING = "summary string, attempts int, due_ms long, error string, delivered string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Waiting(StatefulProcessor):
    """Attempts, due times and delivery flags of the matches that are not delivered yet."""

    def __init__(self, first_delay_ms: int = 10_000, longest_delay_ms: int = 21_600_000):
        self.first, self.longest = first_delay_ms, longest_delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("waiting", WAITING)

    def delay(self, attempts: int) -> int:
        """The first delay, doubled with each attempt, the longest at most."""
        return min(self.longest, self.first * 2 ** min(max(attempts - 1, 0), 40))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = [r for frame in rows for r in frame.to_dict("records")]
        now, out = timerValues.getCurrentProcessingTimeInMs(), []
        for r in sorted(every, key=lambda r: r["kind"] == LISTED):  # what came of an attempt before new entries
            was = self.state.get() if self.state.exists() else None
            if r["kind"] == LISTED:
                if was is None:
                    self.state.update((r["summary"], 0, now, None, ""))
                    out.append((key[0], r["summary"], 0, "", now))
                else:  # it waits already; the newest entry counts
                    self.state.update((r["summary"], *was[1:]))
            elif was is not None and r["kind"] == DONE:
                self.state.clear()
            elif was is not None:
                attempts = was[1] + (r["kind"] == FAILED)
                due = now + (self.delay(attempts) if r["kind"] == FAILED else 1)
                delivered = r["delivered"] if r["kind"] == FAILED else was[4]
                self.state.update((was[0], attempts, due, r["error"], delivered or ""))
                self.handle.registerTimer(due)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        was = self.state.get() if self.state.exists() else None
        due = was is not None and was[2] == expiredTimerInfo.getExpiryTimeInMs()
        yield self._frame([(key[0], was[0], was[1], was[4], was[2])] if due else [])

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[c.split()[0] for c in DUE.split(", ")])

    def close(self) -> None:
        pass


def listed(stream: DataFrame) -> DataFrame:
    """Events of list entries (id, entry as JSON), as ``paged_list`` gives them in a stream."""
    none = F.lit(None).cast("string")
    return stream.select(F.col("page_offset").alias("id"), F.lit(LISTED).alias("kind"), F.col("value").alias("summary"), none.alias("error"), none.alias("delivered"))


def attempt(fetch: Callable[[DataFrame], DataFrame], sink: Callable[[str, DataFrame, int], object], outcomes: str, most_retries: int = 50) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: fetches and sends what is due. ``fetch`` gives (id, detail, error) of a frame of ids;
    ``sink`` takes a dataset, its records and the batch's number, which is the same when a batch runs again. A
    dataset that has a match is not sent it again. Of the retries the ``most_retries`` longest due are taken, the rest come
    with the next batch."""

    def run(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            spark = batch.sparkSession
            late = batch.filter("attempts > 0").orderBy("due_ms", "id").limit(most_retries)
            todo = batch.filter("attempts = 0").unionByName(late)
            later = batch.join(todo.select("id"), "id", "left_anti")
            parsed = parse_details(todo.join(fetch(todo.select("id")), "id", "left").withColumn("summary_json", F.col("summary")).withColumn("summary", F.from_json("summary", SUMMARY)), strict=False).persist()
            has = lambda d: F.array_contains(F.split("delivered", ","), d)
            good, failed = parsed.filter("error is null"), {}
            for name, make in RECORDS.items():
                try:
                    sink(name, make(good.filter(~has(name)), F.current_timestamp()), number)
                except Exception as e:  # the others still go out; this one is sent again
                    failed[name] = str(e)[:500]
            sent = F.array_join(F.filter(F.array(*[F.when(has(d) | F.lit(d not in failed) & F.col("error").isNull(), d) for d in DATASETS]), lambda d: d.isNotNull()), ",")
            said = F.coalesce("error", F.lit("; ".join(f"{k}: {v}" for k, v in failed.items()) or None).cast("string"))
            all_ = F.size(F.filter(F.split(sent, ","), lambda d: d != "")) == len(DATASETS)
            done = parsed.select("id", F.when(all_, DONE).otherwise(FAILED).alias("kind"), F.col("summary_json").alias("summary"), F.when(~all_, said).alias("error"), sent.alias("delivered"))
            wait = later.select("id", F.lit(LATER).alias("kind"), "summary", F.lit(None).cast("string").alias("error"), "delivered")
            done.unionByName(wait).coalesce(1).write.mode("overwrite").json(f"{outcomes}/batch-{number}")
            parsed.unpersist()
        finally:
            batch.unpersist()

    return run


def start_delivery(entries: DataFrame, fetch, sink, outcomes: str, checkpoint: str, every: str = "10 seconds", most_retries: int = 50, processor: Waiting | None = None):
    """Starts the stream over list entries. ``outcomes`` is a folder of the stream's own, beside its checkpoint."""
    spark: SparkSession = entries.sparkSession
    let_workers_import(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)  # what state with timers needs
    _make(spark, outcomes)
    back = spark.readStream.schema(EVENT).option("recursiveFileLookup", "true").json(outcomes)
    due = listed(entries).unionByName(back).groupBy("id").transformWithStateInPandas(processor or Waiting(), DUE, "Update", "ProcessingTime")
    return due.writeStream.outputMode("update").foreachBatch(attempt(fetch, sink, outcomes, most_retries)).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def _make(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
