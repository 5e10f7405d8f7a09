"""Failures, due times and delivery flags as state of a stream."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import json
import time

import pytest

from test_ingest import detail, summary
from scoreline.streaming import retries as R


class Timers:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.now


class Handle:
    """One key's state and timers, in memory."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)


def event(kind, summary="s", error=None, delivered=None):
    return {"id": 1, "kind": kind, "summary": summary, "error": error, "delivered": delivered}


def step(p, now, *events):
    import pandas as pd

    return [tuple(r) for f in p.handleInputRows((1,), iter([pd.DataFrame(list(events))]), Timers(now)) for r in f.itertuples(index=False)]


def expire(p, at):
    return [tuple(r) for f in p.handleExpiredTimer((1,), Timers(at), Timers(at)) for r in f.itertuples(index=False)]


def test_waiting():
    p, h = R.Waiting(), Handle()
    p.init(h)
    assert step(p, 5, event("listed"), event("listed", "s2")) == [(1, "s", 0, "", 5)]
    assert step(p, 10, event("failed", error="no", delivered="logs")) == [] and h.timers == [10_010]
    assert step(p, 20, event("listed", "s3")) == []  # suppressed while it waits
    assert expire(p, 9_999) == [] and expire(p, 10_010) == [(1, "s3", 1, "logs", 10_010)]
    assert step(p, 11_000, event("later")) == [] and expire(p, 11_001) == [(1, "s3", 1, "logs", 11_001)]
    assert step(p, 12_000, event("failed", error="no", delivered="logs,messages")) == [] and h.timers[-1] == 32_000
    assert step(p, 13_000, event("done")) == [] and h.value is None and expire(p, 32_000) == []
    assert step(p, 14_000, event("failed", error="late")) == [] and h.value is None
    assert [p.delay(n) for n in (0, 1, 2, 3, 20, 10_000)] == [10_000, 10_000, 20_000, 40_000, 21_600_000, 21_600_000]


def test_stream_with_restart(spark, tmp_path):
    """A match whose document fails at first, one whose players cannot be sent at first, three due retries with a cap of
    two, and a restart while some of them wait."""
    land, out = tmp_path / "list", tmp_path / "outcomes"
    land.mkdir()
    (land / "a.json").write_text("\n".join(json.dumps({"page_offset": i, "value": json.dumps(summary(i))}) for i in range(1, 7)))
    fails = tmp_path / "fails"  # files that make things fail while they are there
    fails.mkdir()
    for i in (2, 3, 4):
        (fails / f"fetch-{i}").write_text("")
    (fails / "summaries").write_text("")
    sent, asked = [], []

    def fetch(ids):
        wanted = [r.id for r in ids.collect()]
        asked.append(sorted(wanted))
        rows = [(i, None, "cannot fetch") if (fails / f"fetch-{i}").exists() else (i, json.dumps(detail()), None) for i in wanted]
        return spark.createDataFrame(rows, "id long, detail string, error string")

    def sink(name, rows, number):
        if name == "summaries" and (fails / "summaries").exists():
            raise RuntimeError("sink is down")
        sent.extend((name, r.logid) for r in rows.select("logid").distinct().collect())

    def start():
        entries = spark.readStream.schema("page_offset long, value string").json(str(land))
        return R.start_delivery(entries, fetch, sink, str(out), str(tmp_path / "cp"), "1 second", 2, R.Waiting(500, 1000))

    def until(done):
        end = time.time() + 150
        while not done():
            assert q.isActive and time.time() < end, (sent, asked, q.exception())
            time.sleep(0.2)

    q = start()
    until(lambda: len([s for s in sent if s[0] == "logs"]) == 3 and len(asked) > 1)
    q.stop()
    assert {s for s in sent} == {(d, i) for d in ("logs", "messages") for i in (1, 5, 6)} and asked[0] == [1, 2, 3, 4, 5, 6]
    for f in fails.iterdir():
        f.unlink()
    before = len(asked)
    q = start()
    until(lambda: len(sent) >= 18)
    time.sleep(3)
    q.stop()
    assert sorted(sent) == sorted((d, i) for d in R.DATASETS for i in range(1, 7))  # each once
    assert all(len(a) <= 2 for a in asked[1:]) and len(asked) > before
