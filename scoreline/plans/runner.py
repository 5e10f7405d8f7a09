"""The processing pipeline: full or incremental refresh of all published tables, with a run log and gates."""

from __future__ import annotations

import argparse
import datetime
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rolling
from ..functions.core import refresh_bound
from ..operators import features, mlops, quality, serving
from ..schemas import PIPELINE_RUNS
from . import layout
from .lineage import TableLineage
from .store import TableStore, retry_on_conflict
from .tables import PUBLISHED, STAMPED, Tables, stamped

FULL, INCREMENTAL = "full", "incremental"
SERVING_SLICE, ML_SLICE, ALL = "feature-serving", "ml", "all"


def _days_since(day: datetime.date) -> F.Column:
    return F.col("match_date") >= F.lit(day)


#: Tables are kept by month: what a window does not touch is neither read nor written.
MONTH, TIME_MONTH = "date_format(match_date, 'yyyy-MM')", "date_format(match_time, 'yyyy-MM')"
#: Whether a query's shuffle files go when it is done. Steps write each frame once, so none is read again.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries within leave no shuffle files behind."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before) if before else spark.conf.unset(CLEAN_UP)


def _from(day: datetime.date) -> Callable[[str], bool]:
    """Months that hold the day or later ones; rows without a date are always looked at."""
    return lambda month: month == "none" or month >= f"{day:%Y-%m}"


#: What each step waits for; the others run beside it.
STEPS: dict[str, tuple[str, ...]] = {
    "bases": (),
    "features_player_match": ("bases",),
    "features_player_recent_form": ("features_player_match",),
    "serving_map_overview_daily": ("features_player_match",),
    "serving_player_profiles": ("features_player_match",),
    "serving_player_match_deep_dive": ("features_player_match",),
    "ml_snapshot": ("features_player_recent_form",),
    "ml_progress": (),
}


def run_graph(spark: SparkSession, waits: dict[str, tuple[str, ...]], work: Callable[[str], None], at_once: int = 4) -> dict[str, Exception]:
    """Runs ``work`` of every step whose steps before it are done, up to ``at_once`` side by side, each in a scheduler
    pool of its own. A step that fails stops those that wait for it, and no others; gives the errors by step."""
    done: set[str] = set()
    failed: dict[str, Exception] = {}
    running: dict[Future, str] = {}

    def one(step: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", step)
        try:
            work(step)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(at_once) as threads:
        left = dict(waits)
        while left or running:
            ready = [k for k, before in left.items() if all(b in done or b not in waits for b in before)]
            for step in ready:
                del left[step]
                running[threads.submit(inheritable_thread_target(spark)(one), step)] = step
            if not running:
                break  # what is left waits for a step that has failed
            for f in wait(running, return_when=FIRST_COMPLETED).done:
                step = running.pop(f)
                if (e := f.exception()) is not None:
                    failed[step] = e
                else:
                    done.add(step)
    return failed


class Runner:
    """Publishes tables of ``tables`` into ``store``. Each step reads what earlier steps have published.

    Player tables lie in parts by month and player bucket (``layout``): an incremental run reads and rewrites the
    buckets of the players who have changed. ``buckets`` is their number for tables that a run makes anew; without it
    the number of player rows decides. ``send`` gets the run's lineage events. With ``keep``, versions of a table before
    its last ``keep`` go as soon as a step has published it; else they stay for ``maintain``. ``takes`` names the columns
    that the later steps of a run take of ``features_player_match``, whose rows are then written with these alone (and
    the match).
    """

    def __init__(self, tables: Tables, store: TableStore, mode: str = INCREMENTAL, refresh_days: int = 7, now: Callable[[], datetime.datetime] = datetime.datetime.now, buckets: int | None = None, send: Callable[[dict], None] | None = None, keep: int | None = None, takes: tuple[str, ...] | None = None):
        if mode not in (FULL, INCREMENTAL):
            raise ValueError(f"no such mode: {mode}")
        self.t, self.store, self.mode, self.days, self.now = tables, store, mode, refresh_days, now
        self.run_id = uuid.uuid4().hex
        self.t.refreshed_at = now()
        self._new_buckets, self._gone, self._who, self.keep = buckets, None, None, keep
        self._takes = takes and tuple(dict.fromkeys(("logid", *takes)))
        self._logging = threading.Lock()
        self.lineage = TableLineage(send, store.root, str(uuid.UUID(self.run_id))) if send else None
        if self.lineage:
            store.on_write = self.lineage.written

    def _full(self, name: str) -> bool:
        return self.mode == FULL or not self.store.exists(name)

    def _publish(self, name: str, write: Callable[[], int]) -> int:
        """How many rows the write has written: all of a table that is made anew, else those of the parts it touches."""
        version = retry_on_conflict(write)
        self.t.replace(name, self.store.read(name))
        if self.keep:
            self.store.expire(name, self.keep)
        return self.store.written(name, version)

    def _bound(self, df: DataFrame, col: str) -> datetime.date:
        """Where the window of an incremental run begins."""
        top = refresh_bound(df, col, self.days)
        return top.date() if isinstance(top, datetime.datetime) else top

    def bases(self) -> int:
        """Deduplicated bases, written once a run as several steps read them. An incremental run deduplicates only
        deliveries of matches within the window, and rewrites only the months that it touches."""
        names = ("logs_base", "summaries_base", "messages_base")
        if any(self._full(n) for n in names):
            by = {"messages_base": None}
            rows: dict[str, int] = {}

            def write(n: str) -> None:
                part, at = by.get(n, TIME_MONTH), f"refresh_{n}"
                if self.keep and part:  # the shuffle files of the ranks go before those of the months are made
                    self.store.overwrite(at, self.t[n])
                    self.t.replace(n, self.store.read(at))
                rows[n] = self._publish(n, lambda: self.store.overwrite(n, self.t[n], part))
                self.store.drop(at)

            # one after another: the shuffle files of one go before the next makes its own
            if failed := run_graph(self.store.spark, dict.fromkeys(names, ()), write, at_once=1):
                raise next(iter(failed.values()))
            return sum(rows.values())
        day = self._bound(self.t["logs"], "match_time")
        fresh = F.to_date("match_time") >= F.lit(day)
        made = {"logs_base": features.logs_base(self.t["logs"].filter(fresh)), "summaries_base": features.summaries_base(self.t["summaries"].filter(fresh))}
        n = sum(self._publish(k, lambda k=k: self.store.replace_where(k, made[k], fresh, TIME_MONTH, _from(day))) for k in made)
        matches = self.t["logs_base"].filter(fresh).select("logid")
        chat = features.messages_base(self.t["messages"].join(matches, "logid", "left_semi"))
        return n + self._publish("messages_base", lambda: self.store.replace_keys("messages_base", chat, ["logid"], matches))

    def _buckets(self) -> int:
        if self._new_buckets is None:
            known = self.store.exists("summaries_base")
            self._new_buckets = layout.buckets_for(self.store.read("summaries_base").count() if known else 0)
        return self._new_buckets

    def _parts(self, name: str, players: DataFrame, month: Callable[[str], bool] | None = None) -> Callable[[str], bool]:
        """The parts of a table where rows of these players can be."""
        n = layout.buckets_of(self.store.layout(name))
        return layout.parts_of(layout.touched(players, n) if n else None, month)

    def features_player_match(self) -> int:
        name = "features_player_match"
        s, logs, m = (self.t[n] for n in ("summaries_base", "logs_base", "messages_base"))
        taken = lambda rows: rows.select(*self._takes) if self._takes else rows
        if self._full(name):
            by = layout.by_month_and_player(self._buckets())
            return self._publish(name, lambda: self.store.overwrite(name, taken(features.player_match(s, logs, m, self.t.scorer)), by))
        day = self._bound(s, "match_time")
        fresh = F.to_date("match_time") >= F.lit(day)
        changed = s.filter(fresh).select("logid").distinct()
        new = taken(features.player_match(s.filter(fresh), logs.filter(fresh), m.join(changed, "logid", "left_semi"), self.t.scorer))
        old = self.store.read(name, parts=layout.parts_of(month=_from(day)))
        self._gone = old.join(changed, "logid", "left_semi").select("steamid").distinct()
        if self.keep:  # the version that tells them goes
            self.store.overwrite("refresh_players_before", self._gone)
            self._gone = self.store.read("refresh_players_before")
        players = s.filter(fresh).select("steamid").union(self._gone)
        parts = self._parts(name, players, _from(day))
        return self._publish(name, lambda: self.store.replace_keys(name, new, ["logid"], changed, parts=parts))

    def _players(self) -> DataFrame:
        """Players of the window's matches, and those whom a new delivery has taken out of one."""
        if self._who is None:
            rows = self.t["features_player_match"]
            who = rows.filter(_days_since(refresh_bound(rows, "match_date", self.days))).select("steamid")
            self._who = (who if self._gone is None else who.union(self._gone)).distinct()
        return self._who

    def _of(self, name: str, players: DataFrame | None) -> DataFrame:
        """A published table as far as these players can be in it: the parts of their buckets are read."""
        if players is None or not self.store.exists(name):
            return self.t[name]
        return self.store.read(name, parts=self._parts(name, players))

    def _by_player(self, name: str, plan: Callable[[DataFrame | None], DataFrame], by: Callable[[int], str]) -> int:
        make = (lambda who: stamped(plan(who), self.t.refreshed_at)) if name in STAMPED else plan
        if self._full(name):
            return self._publish(name, lambda: self.store.overwrite(name, make(None), by(self._buckets())))
        who = self._players()
        parts = self._parts(name, who)
        return self._publish(name, lambda: self.store.replace_keys(name, make(who), ["steamid"], who, parts=parts))

    def features_player_recent_form(self) -> int:
        name = "features_player_recent_form"

        def plan(who: DataFrame | None) -> DataFrame:
            rows = self._of("features_player_match", who)
            return features.recent_form(rows, who, hot=rolling.hot_keys(rows, "steamid"))

        return self._by_player(name, plan, layout.by_month_and_player)

    def serving_player_profiles(self) -> int:
        name = "serving_player_profiles"
        return self._by_player(name, lambda who: serving.player_profiles(self._of("features_player_match", who), players=who), layout.by_player)

    def serving_map_overview_daily(self) -> int:
        name = "serving_map_overview_daily"
        logs, s, f = (self.t[n] for n in ("logs_base", "summaries_base", "features_player_match"))
        if self._full(name):
            return self._publish(name, lambda: self.store.overwrite(name, stamped(serving.map_overview_daily(logs, s, f), self.t.refreshed_at), MONTH))
        day = refresh_bound(logs.select(F.to_date("match_time").alias("d")), "d", self.days)
        return self._publish(name, lambda: self.store.replace_where(name, stamped(serving.map_overview_daily(logs, s, f, day), self.t.refreshed_at), _days_since(day), MONTH, _from(day)))

    def serving_player_match_deep_dive(self) -> int:
        """Rows of changed players are all refreshed: their career averages have moved."""
        return self._by_player("serving_player_match_deep_dive", self._deep, layout.by_month_and_player)

    def _deep(self, who: DataFrame | None) -> DataFrame:
        rows = self._of("features_player_match", who)
        if who is not None:
            rows = rows.join(who, "steamid", "left_semi")
        return serving.deep_dive_at_once(rows, rolling.hot_keys(rows, "steamid"))

    def ml_snapshot(self) -> int:
        """Appends the snapshot of the newest match unless it is there already."""
        name = "ml_training_player_match"
        rows = mlops.snapshot_rows(self.t["features_player_match"], self.t["features_player_recent_form"], self.t["logs_base"])
        sid = rows.select("snapshot_id").first()
        if sid is None:
            return 0
        if self.store.exists(name) and not self.store.read(name).filter(F.col("snapshot_id") == sid[0]).isEmpty():
            return 0
        return self.store.written(name, retry_on_conflict(lambda: self.store.append(name, rows)))

    def ml_progress(self) -> int:
        names = ("serving_ml_model_registry", "serving_ml_pipeline_progress_daily", "serving_ml_prediction_quality_daily")
        return sum(self._publish(n, lambda n=n: self.store.overwrite(n, self.t[n])) for n in names)

    def steps(self, part: str = ALL) -> list[str]:
        """Names of a part's steps, each after those that it waits for."""
        ml = ("ml_snapshot", "ml_progress")
        wanted = {SERVING_SLICE: [k for k in STEPS if k not in ml], ML_SLICE: [*list(STEPS)[:3], *ml], ALL: list(STEPS)}
        return wanted[part]

    def _log(self, step: str, status: str, began: datetime.datetime, rows: int | None, error: str | None) -> None:
        end = self.now()
        row = mlops.log_run(self.store.spark, PIPELINE_RUNS, run_id=self.run_id, run_mode=self.mode, step_name=step, status=status, started_at=began, finished_at=end, duration_seconds=(end - began).total_seconds(), row_count=rows, error_text=error, created_at=end)
        with self._logging:
            retry_on_conflict(lambda: self.store.append("ops_pipeline_runs", row))

    @staticmethod
    def steps_for(step: str) -> list[str]:
        """A step and all that it waits for, in order."""
        return [k for before in STEPS[step] for k in Runner.steps_for(before)] + [step]

    def run(self, part: str | list[str] = ALL, check: bool = False) -> dict[str, int]:
        """Runs the steps, side by side where none waits for another. A failed step is logged and stops those that wait
        for it; the run then fails, as it does on a failed check."""
        out: dict[str, int] = {}
        conf, before = self.store.spark.conf, self.store.spark.conf.get(CLEAN_UP, None)
        conf.set(CLEAN_UP, "true")
        began, status, error = self.now(), "failed", None

        def step(name: str) -> None:
            at = self.now()
            try:
                if self.lineage:
                    self.lineage.started(name)
                out[name] = getattr(self, name)()
            except Exception as e:
                if self.lineage:
                    self.lineage.failed(name, str(e)[:500])
                self._log(name, "failed", at, None, str(e)[:1000])
                raise
            self._log(name, "success", at, out[name], None)

        try:
            steps = self.steps(part) if isinstance(part, str) else part
            failed = run_graph(self.store.spark, {k: STEPS[k] for k in steps}, step)
            if failed:
                raise next(failed[k] for k in steps if k in failed)
            if check:
                quality.assert_passed(quality.platform_checks(self.t, self.t.as_of))
            status = "success"
        except Exception as e:
            error = str(e)[:1000]
            raise
        finally:
            conf.set(CLEAN_UP, before) if before else conf.unset(CLEAN_UP)
            self._log(f"pipeline_{part if isinstance(part, str) else part[-1]}", status, began, sum(out.values()), error)
        return out


def maintain(store: TableStore, names: list[str], target_mb: int = 256, days: float = 14) -> None:
    """Rewrites tables into files of a good size and drops versions of over ``days`` days ago, but for the last."""
    for n in names:
        if store.exists(n):
            retry_on_conflict(lambda n=n: store.compact(n, target_mb))
            store.expire(n, days=days)


def row_counts(store: TableStore, names: list[str]) -> DataFrame:
    """(table_name, row_count) of published tables, as one relation."""
    out = None
    for n in names:
        if store.exists(n):
            one = store.read(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count"))
            out = one if out is None else out.unionAll(one)
    return out if out is not None else store.spark.createDataFrame([], "table_name string, row_count long")


def validate_settings(settings: dict[str, str | None], needed: list[str]) -> None:
    """Raises if a setting is missing or still a placeholder in angle brackets."""
    bad = [k for k in needed if not (v := (settings.get(k) or "").strip()) or (v.startswith("<") and v.endswith(">"))]
    if bad:
        raise ValueError(f"missing or placeholder settings: {', '.join(bad)}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Refresh the published tables")
    p.add_argument("source")
    p.add_argument("store")
    p.add_argument("--mode", choices=(FULL, INCREMENTAL), default=INCREMENTAL)
    p.add_argument("--refresh-days", type=int, default=7)
    p.add_argument("--pipeline", choices=(SERVING_SLICE, ML_SLICE, ALL), default=ALL)
    p.add_argument("--check", action="store_true", help="fail if a quality check fails")
    p.add_argument("--maintain", action="store_true", help="compact tables and expire old versions afterwards")
    p.add_argument("--events", help="file that gets lineage events, a line each")
    p.add_argument("--train", metavar="VERSION", help="train and register the baselines on the newest snapshot")
    a = p.parse_args(argv)
    from ..session import build_session

    spark: SparkSession = build_session()
    began = time.time()
    validate_settings({"source": a.source, "store": a.store}, ["source", "store"])
    store = TableStore(spark, a.store)

    def send(event: dict) -> None:
        with open(a.events, "a", encoding="utf-8") as f:
            f.write(json.dumps(event) + "\n")

    got = Runner(Tables(spark, a.source), store, a.mode, a.refresh_days, send=send if a.events else None).run(a.pipeline, a.check)
    if a.train:
        from ..ml import baselines

        rows = store.read("ml_training_player_match")
        sid = rows.agg(F.max_by("snapshot_id", "snapshot_cutoff_time")).first()[0]
        done = baselines.train_all(rows.filter(F.col("snapshot_id") == sid), a.train)
        print(baselines.register(store, done, a.train, sid, datetime.datetime.now(), f"{a.store}/models"))
    if a.maintain:
        maintain(store, [*PUBLISHED, "ml_training_player_match", "ops_pipeline_runs", "ml_model_registry"])
    print(got, f"{time.time() - began:.1f} s")


if __name__ == "__main__":
    main()
