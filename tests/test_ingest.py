"""Scenarios of the ingest: parsing, normalising, paging, retries, delivery, streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from scoreline.plans.store import TableStore
from scoreline.sources import documents as D
from scoreline.sources.paging import PagedListSource, collect, collect_new, with_retries
from scoreline.streaming import ingest as I

NOW = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def summary(i, **kw):
    return {"id": i, "title": f"t{i}", "map": "m", "date": 1_700_000_000, "views": 5, "players": 12, **kw}


def detail(**kw):
    return {
        "success": True, "version": 3, "length": 1423,
        "info": {"map": "cp_x", "date": 1_700_000_100, "title": "T", "total_length": 9, "uploader": {"id": "76561197960497430", "name": "u"}},
        "teams": {"Red": {"score": 0}, "Blue": {"score": 1}},
        "players": {"[U:1:1]": {"team": "Red", "kills": 3, "class_stats": [{"type": "soldier"}, {"type": "scout"}, {"type": "soldier"}]}},
        "chat": [{"steamid": "[U:1:1]", "name": "n", "msg": " Holy Spam "}, {"msg": "  "}, {"steamid": None, "msg": "GG"}],
        **kw,
    }


def frame(spark, pairs):
    return spark.createDataFrame([(s, json.dumps(d) if isinstance(d, dict) else d) for s, d in pairs], f"summary {D.SUMMARY}, detail string")


def test_list_page(spark):
    page = {"success": True, "results": 2, "total": 9, "parameters": {}, "logs": [summary(10), summary(9)]}
    got = D.parse_list(spark.createDataFrame([(json.dumps(page),)], "value string"))
    assert [r.summary.id for r in got.orderBy("position").collect()] == [10, 9]


def test_list_page_names_what_is_wrong(spark):
    page = {"success": True, "results": 1, "total": 9, "logs": [{**summary(10), "views": None}]}
    with pytest.raises(Exception, match=r"logs\[\].views"):
        D.parse_list(spark.createDataFrame([(json.dumps(page),)], "value string")).collect()


def test_detail_without_success_is_an_error(spark):
    df = frame(spark, [(summary(1), {"success": False}), (summary(2), "no json")])
    with pytest.raises(Exception, match="success=false|no match"):
        D.parse_details(df).collect()
    assert D.parse_details(df, strict=False).filter("error is null").count() == 0


def test_normalised_records(spark):
    p = D.parse_details(frame(spark, [(summary(4031052), detail())]))
    now = F.lit(NOW).cast("timestamp")
    g = D.log_records(p, now).first()
    assert (g.durationseconds, g.redscore, g.bluescore, g.payloadschemaversion, g.uploadersteamid, g.map, g.title) == (1423, 0, 1, 3, "76561197960497430", "cp_x", "T")
    assert g.sourcedateiso == "2023-11-14T22:15:00.000Z" and g.ingestedat == "2024-03-01T00:00:00.000Z"
    m = D.message_records(p, now).orderBy("messageindex").collect()
    assert [(r.recordid, r.message, r.messagelower) for r in m] == [("4031052:0", "Holy Spam", "holy spam"), ("4031052:2", "GG", "gg")]
    s = D.summary_records(p, now).collect()
    assert [(r.recordid, r.classesplayedcsv, r.kills, r.deaths) for r in s] == [("4031052:[U:1:1]", "soldier,scout", 3, None)]


@pytest.mark.parametrize("raw, want", [(123, "123"), ("[U:1:2]", "[U:1:2]"), ({"id": 7}, "7"), (None, None)])
def test_uploader_is_number_text_or_object(spark, raw, want):
    d = detail()
    d["info"]["uploader"] = raw
    assert D.log_records(D.parse_details(frame(spark, [(summary(1), d)])), F.current_timestamp()).first().uploadersteamid == want


def test_detail_falls_back_to_the_summary(spark):
    p = D.parse_details(frame(spark, [(summary(1), {"success": True})]))
    g = D.log_records(p, F.current_timestamp()).first()
    assert (g.title, g.map, g.durationseconds, g.redscore) == ("t1", "m", None, None)
    assert D.message_records(p, F.current_timestamp()).count() == D.summary_records(p, F.current_timestamp()).count() == 0


def pages(ids, size):
    ids = sorted(ids, reverse=True)
    return lambda offset: {"logs": [summary(i) for i in ids[offset : offset + size]]}


def test_paging_stops():
    assert [s["id"] for s in collect_new(pages(range(1, 8), 2), 2, 4).summaries] == [5, 6, 7]
    got = collect(pages(range(1, 8), 2), 2, 0, 1)
    assert [s["id"] for s in got.summaries] == [6, 7] and got.next_offset == 2
    assert collect(pages(range(1, 4), 2), 2).next_offset is None
    assert collect(pages([], 2), 2).summaries == []
    assert collect_new(pages(range(1, 20), 2), 2, 4, 2).next_offset == 4  # the gap is told


def test_retries_wait_longer_each_time():
    waits, calls = [], iter([ValueError, ValueError, None])

    def call():
        if e := next(calls):
            raise e
        return {"ok": 1}

    assert with_retries(call, 3, 0.5, waits.append) == {"ok": 1} and waits == [0.5, 1.0]
    with pytest.raises(ValueError):
        with_retries(lambda: (_ for _ in ()).throw(ValueError()), 2, 0, lambda s: None)


def test_paged_source(spark, tmp_path):
    for o in (0, 2):
        (tmp_path / f"{o}.json").write_text(json.dumps({"success": True, "results": 2, "total": 4, "logs": [summary(10 - o), summary(9 - o)]}))
    spark.dataSource.register(PagedListSource)
    df = spark.read.format("paged_list").options(path=str(tmp_path), pages=3, page_size=2).load()
    assert sorted(r.summary.id for r in D.parse_list(df).collect()) == [7, 8, 9, 10]


def test_merge_candidates(spark):
    f = lambda *ids, t: spark.createDataFrame([(summary(i, title=t),) for i in ids], f"summary {D.SUMMARY}")
    got = D.merge_candidates(f(3, 2, t="new"), f(3, 1, t="old")).collect()
    assert [(r.id, r.summary.title) for r in got] == [(1, "old"), (2, "new"), (3, "new")]


def test_backoff(spark):
    df = spark.createDataFrame([(1,), (2,), (20,)], "n int").select(I.retry_delay_ms(F.col("n")).alias("d"))
    assert [r.d for r in df.collect()] == [10_000, 20_000, 21_600_000]


def fetcher(spark, docs):
    rows = [(i, json.dumps(d) if isinstance(d, dict) else None, None if isinstance(d, dict) else str(d)) for i, d in docs.items()]
    got = spark.createDataFrame(rows, "id long, detail string, error string")
    return lambda ids: ids.join(got, "id")


def listed(spark, *ids):
    return spark.createDataFrame([(summary(i),) for i in ids], f"summary {D.SUMMARY}")


def test_run_emits_and_moves_the_cursor(spark, tmp_path):
    events = []
    b = I.BatchIngest(TableStore(spark, str(tmp_path)), fetcher(spark, {1: detail(), 2: detail()}), on_event=lambda k, f: events.append(k))
    dry = b.run(listed(spark, 1, 2), NOW, dry_run=True)
    assert dry.emitted == {"logs": 0, "messages": 0, "summaries": 0} and dry.last_id == 0 and not b.store.exists("logs")
    got = b.run(listed(spark, 1, 2), NOW)
    assert got.emitted == {"logs": 2, "messages": 4, "summaries": 2} and got.last_id == 2 and got.failed == 0
    assert b.run(listed(spark, 1, 2), NOW).new == 0
    assert events == ["START", "COMPLETE"] * 3


def test_failures_wait_and_come_back(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    bad = I.BatchIngest(store, fetcher(spark, {1: "HTTP 500", 2: detail()}))
    assert bad.run(listed(spark, 1, 2), NOW).failed == 1
    good = I.BatchIngest(store, fetcher(spark, {1: detail(), 3: detail()}))
    early = good.run(listed(spark, 1, 3), NOW)  # 1 is suppressed until it is due
    assert (early.new, early.retried, early.failed) == (1, 0, 1)
    later = good.run(listed(spark, 1), NOW + dt.timedelta(seconds=11))
    assert (later.retried, later.emitted["logs"], later.failed) == (1, 1, 0)


def test_delivered_datasets_are_not_sent_again(spark, tmp_path):
    store, broken = TableStore(spark, str(tmp_path)), {"summaries"}

    def sink(name, df):
        if name in broken:
            raise RuntimeError("overloaded")
        return df.count()

    b = I.BatchIngest(store, fetcher(spark, {1: detail()}), sink)
    assert b.run(listed(spark, 1), NOW).emitted == {"logs": 1, "messages": 2, "summaries": 0}
    broken.clear()
    assert b.run(listed(spark, 1), NOW + dt.timedelta(minutes=1)).emitted == {"logs": 0, "messages": 0, "summaries": 1}


def test_retry_cap(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    I.BatchIngest(store, fetcher(spark, {i: "down" for i in (1, 2, 3)})).run(listed(spark, 1, 2, 3), NOW)
    b = I.BatchIngest(store, fetcher(spark, {i: detail() for i in (1, 2, 3)}), most_retries=2)
    got = b.run(listed(spark).limit(0), NOW + dt.timedelta(minutes=1))
    assert (got.retried, got.failed) == (2, 1)


def test_a_failed_start_event_stops_the_run(spark, tmp_path):
    def event(kind, facts):
        raise RuntimeError("no lineage")

    b = I.BatchIngest(TableStore(spark, str(tmp_path)), fetcher(spark, {1: detail()}), on_event=event)
    with pytest.raises(RuntimeError, match="no lineage"):
        b.run(listed(spark, 1), NOW)
    assert not b.store.exists("logs")


def test_state_tolerates_anything():
    assert I.State.parse(None, "n") == I.State.parse("{", "n") == I.State.parse("[]", "n") == I.State(0, "n")
    assert I.State.parse('{"last_id": "5", "updated_at": "x"}', "n") == I.State(5, "x")


def test_stream_fans_out_once(spark, tmp_path):
    land, out = tmp_path / "land", tmp_path / "out"
    land.mkdir()
    (land / "a.txt").write_text("\n".join(json.dumps({"summary": summary(i), "detail": detail() if i < 3 else {"success": False}}) for i in (1, 2, 3)))
    for _ in range(2):
        I.start_ingest(spark, str(land), str(out), str(tmp_path / "cp")).awaitTermination()
    n = {k: spark.read.parquet(f"{out}/{k}").count() for k in ("logs", "messages", "summaries", "failures")}
    assert n == {"logs": 2, "messages": 4, "summaries": 2, "failures": 1}


def test_stream_deduplicates_within_the_watermark(spark, tmp_path):
    rows = [("1:a", "m", NOW.replace(tzinfo=None)), ("1:a", "m", NOW.replace(tzinfo=None)), ("1:b", "m", NOW.replace(tzinfo=None))]
    spark.createDataFrame(rows, "recordid string, map string, __ingest_ts timestamp").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("recordid string, map string, __ingest_ts timestamp").parquet(str(tmp_path / "in"))
    q = I.deduplicated(s).writeStream.format("memory").queryName("dedup").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert spark.table("dedup").count() == 2


def test_list_stream_follows_the_last_id(spark, tmp_path):
    land = tmp_path / "pages"
    land.mkdir()

    def publish(ids):
        ids = sorted(ids, reverse=True)
        for o in range(0, len(ids) + 1, 2):
            (land / f"{o}.json").write_text(json.dumps({"success": True, "results": 2, "total": len(ids), "logs": [summary(i) for i in ids[o : o + 2]]}))

    def run():
        q = spark.readStream.format("paged_list").options(path=str(land), page_size=2, pages=10, progress=str(tmp_path / "progress")).load().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).start()
        q.processAllAvailable()
        q.stop()
        return sorted(r.page_offset for r in spark.read.schema("page_offset long, value string").parquet(str(tmp_path / "out")).collect())

    spark.dataSource.register(PagedListSource)
    publish([1, 2, 3])
    assert run() == [1, 2, 3]
    publish([1, 2, 3, 4, 5])
    assert run() == [1, 2, 3, 4, 5]


def test_lineage_events(spark, tmp_path):
    from scoreline.plans.lineage import Lineage

    sent = []
    b = I.BatchIngest(TableStore(spark, str(tmp_path)), fetcher(spark, {1: detail()}), on_event=Lineage(sent.append))
    b.run(listed(spark, 1), NOW)
    assert [e["eventType"] for e in sent] == ["START", "COMPLETE"] and len({e["run"]["runId"] for e in sent}) == 1
    assert [o["name"] for o in sent[0]["outputs"]] == list(I.DATASETS) and len(sent[0]["inputs"]) == 1
    b.fetch = lambda ids: 1 / 0
    with pytest.raises(ZeroDivisionError):
        b.run(listed(spark, 2), NOW)
    assert sent[-1]["eventType"] == "FAIL" and "division" in sent[-1]["run"]["facets"]["errorMessage"]["message"]


def test_control(spark, tmp_path):
    from scoreline.streaming import control as C

    land, parts = tmp_path / "pages", tmp_path / "details"
    land.mkdir()
    parts.mkdir()
    ids = list(range(9, 0, -1))
    for o in range(0, 10, 2):
        (land / f"{o}.json").write_text(json.dumps({"logs": [summary(i) for i in ids[o : o + 2]]}))
    for i in ids[1:]:
        (parts / f"{i}.json").write_text(json.dumps(detail()))
    fetch = C.pages_of(str(land))
    store = TableStore(spark, str(tmp_path / "a"))
    b = I.BatchIngest(store, C.details_of(spark, str(parts)))
    assert C.tick(b, fetch, 2, NOW, 1, dry_run=True).new == 9 and C.health(store, NOW)["last_id"] == 0
    got = C.tick(b, fetch, 2, NOW, 1)  # a backlog of five pages, one page a step: no gap
    assert got.emitted["logs"] == 8 and got.failed == 1 and store.read("logs").count() == 8
    assert store.read("ingest_failures").first().last_error == "no detail found" and C.health(store, NOW) == {"ok": True, "last_id": 8, "updated_at": NOW.isoformat(), "failed": 1}
    other = I.BatchIngest(TableStore(spark, str(tmp_path / "b")), C.details_of(spark, str(parts)))
    steps = C.full_history(other, fetch, 2, NOW, 0, 2)
    assert len(steps) == 3 and sum(s.emitted["logs"] for s in steps) == 8


def test_patience_with_an_overloaded_receiver():
    from scoreline.sources.sink import in_chunks, with_patience

    waits, fail, sent = [], [RuntimeError("Pipeline overloaded"), RuntimeError("429 Too Many Requests")], []

    def send():
        if fail:
            raise fail.pop()
        sent.append(1)

    with_patience(send, sleep=waits.append)
    assert sent == [1] and waits == [0.5, 1.0]
    for errors in ([ValueError("broken")], [RuntimeError("overloaded")] * 3):
        fail[:] = errors
        with pytest.raises((ValueError, RuntimeError)):
            with_patience(send, sleep=waits.append)
    assert [len(c) for c in in_chunks(iter("x" * 25), 10)] == [10, 10, 5] and list(in_chunks(iter(""), 0)) == [] and len(list(in_chunks(iter("xy"), 0))) == 2


def test_sink_to_a_folder(spark, tmp_path):
    """25 records of a task in chunks of 10, 10 and 5; a write that fails leaves nothing."""
    from scoreline.sources.sink import record_sink

    send = record_sink(str(tmp_path), 10)
    rows = spark.range(25).selectExpr("cast(id as string) as recordid", "named_struct('a', id) as s")
    assert send("logs", rows.coalesce(1)) == 25
    files = sorted((tmp_path / "logs").iterdir())
    assert sorted(len(f.read_text().splitlines()) for f in files) == [5, 10, 10]
    got = [json.loads(x) for f in files for x in f.read_text().splitlines()]
    assert sorted(int(r["recordid"]) for r in got) == list(range(25)) and all(r["s"]["a"] == int(r["recordid"]) for r in got)
    assert send("empty", rows.limit(0)) == 0 and send("messages", rows.repartition(4)) == 25
    bad = rows.repartition(1).withColumn("x", F.expr("if(recordid = '24', raise_error('broken'), 1)"))
    with pytest.raises(Exception, match="broken"):
        send("bad", bad.repartition(3))
    assert not [f for f in (tmp_path / "bad").glob("*.json")]


def test_sink_to_a_receiver_that_is_overloaded_at_first(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from scoreline.sources.sink import record_sink

    got, refuse = [], [429, 429]

    class Receiver(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            code = refuse.pop() if refuse else 200 if b'"bad"' not in body else 400
            if code == 200:
                got.append((self.path, len(json.loads(body)), self.headers["Idempotency-Key"]))
            self.send_response(code)
            self.end_headers()

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Receiver)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        send = record_sink(f"http://127.0.0.1:{server.server_port}/in", 10, delay=0.01)
        rows = spark.range(25).selectExpr("cast(id as string) as recordid").coalesce(1)
        assert send("chat", rows) == 25 and [n for _, n, _ in got] == [10, 10, 5] and {p for p, _, _ in got} == {"/in/chat"} and len({k for *_, k in got}) == 3
        with pytest.raises(Exception, match="400"):
            send("chat", spark.createDataFrame([("bad",)], "recordid string"))
    finally:
        server.shutdown()


@pytest.mark.parametrize("message, offset", [({"mode": "full-history", "offset": 30}, 30), ({"mode": "full-history", "offset": -1}, None), ({"mode": "x", "offset": 1}, None), ({"mode": "full-history", "offset": True}, None), ({"mode": "full-history", "offset": "3"}, None), ([], None), (None, None)])
def test_queue_messages(message, offset):
    from scoreline.streaming.control import offset_of

    assert offset_of(message) == offset


def pages_of_list(ids, size):
    """A list of ids, newest first, as a function of the offset, and what it was asked for."""
    asked = []

    def fetch(offset):
        asked.append(offset)
        return {"logs": [summary(i) for i in sorted(ids, reverse=True)[offset : offset + size]]}

    return fetch, asked


@pytest.mark.parametrize("n, size, last, pages", [(500, 10, 0, 10), (500, 10, 500, 10), (499, 10, 37, 3), (7, 10, 0, 2), (0, 5, 0, 1), (64, 1, 0, 5), (30, 3, 29, 1)])
def test_plan_takes_the_old_end(n, size, last, pages):
    from scoreline.sources.paging import plan_oldest, read_stretch

    fetch, asked = pages_of_list(range(1, n + 1), size)
    got, at = [], last
    while parts := plan_oldest(fetch, size, at, pages):
        assert len(parts) <= pages and parts[0].low == at and all(a.high == b.low for a, b in zip(parts, parts[1:]))
        got += [s["id"] for p in parts for s in read_stretch(fetch, size, p)]
        at = parts[-1].high
    assert got == list(range(last + 1, n + 1))
    asked.clear()
    plan_oldest(fetch, size, last, pages)
    assert len(asked) <= 2 * max(1, (n // size).bit_length()) + pages + 2


def test_stretches_are_found_where_they_have_moved(spark):
    from scoreline.sources.paging import plan_oldest, read_stretch

    ids = list(range(1, 101))
    fetch, _ = pages_of_list(ids, 5)
    parts = plan_oldest(fetch, 5, 20, 4)
    for change in (lambda: ids.extend(range(200, 223)), lambda: [ids.remove(i) for i in range(200, 223)], lambda: [ids.remove(i) for i in range(60, 91)]):
        change()
        for p in parts:
            assert [s["id"] for s in read_stretch(fetch, 5, p)] == list(range(p.low + 1, p.high + 1))
    ids.remove(25)
    assert [s["id"] for p in parts for s in read_stretch(fetch, 5, p)] == [i for i in range(21, 41) if i != 25]


def test_list_stream_of_a_backlog(spark, tmp_path):
    """500 ids at 10 pages a batch come over five batches, each page a partition; a restart goes on where it was."""
    land, size = tmp_path / "pages", 10
    land.mkdir()

    def publish(n):
        for o in range(0, n, size):
            (land / f"{o}.json").write_text(json.dumps({"success": True, "logs": [summary(i) for i in range(n - o, max(0, n - o - size), -1)]}))

    def start():
        df = spark.readStream.format("paged_list").options(path=str(land), page_size=size, pages=10, progress=str(tmp_path / "progress")).load()
        return df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).start()

    spark.dataSource.register(PagedListSource)
    publish(500)
    q = start()
    q.processAllAvailable()
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    q.stop()
    assert batches == [100] * 5
    read = lambda: sorted(r.page_offset for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert read() == list(range(1, 501))
    publish(730)
    for stop_early in (True, False):
        q = start()
        if stop_early:  # after its first batch, wherever that leaves it
            while not any(p["numInputRows"] for p in q.recentProgress):
                q.awaitTermination(0.2)
        else:
            q.processAllAvailable()
        q.stop()
    assert read() == list(range(1, 731))
    with pytest.raises(Exception, match="progress"):
        spark.readStream.format("paged_list").options(path=str(land)).load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp2")).start().processAllAvailable()


def test_tick_works_a_backlog_off_in_steps(spark, tmp_path):
    from scoreline.streaming import control as C

    fetch, _ = pages_of_list(range(1, 13), 2)
    docs = {i: detail() for i in range(1, 13) if i not in (3, 4)}
    b = I.BatchIngest(TableStore(spark, str(tmp_path)), fetcher(spark, docs | {3: "gone", 4: "gone"}))
    steps, run = [], b.run
    b.run = lambda rows, *a, **k: steps.append(rows.count()) or run(rows, *a, **k)
    assert C.tick(b, fetch, 2, NOW, 2, dry_run=True).new == 12 and steps == [4, 4, 4]
    got = C.tick(b, fetch, 2, NOW, 1)
    assert steps[3:] == [2] * 6 and got.new == 12 and got.emitted["logs"] == 10 and got.failed == 2 and got.last_id == 12
    assert C.tick(b, fetch, 2, NOW, 1).new == 0


def test_messages_queued_meanwhile_stay(spark, tmp_path):
    from scoreline.streaming import control as C

    fetch, _ = pages_of_list(range(1, 7), 2)
    store = TableStore(spark, str(tmp_path))
    b = I.BatchIngest(store, fetcher(spark, {i: detail() for i in range(1, 7)}))
    run = b.run
    b.run = lambda *a, **k: C.enqueue(store, 99) or run(*a, **k)
    C.enqueue(store, 0)
    C.enqueue(store, 0)
    assert len(C.work_queue(b, fetch, 2, NOW, 1)) == 1
    assert sorted(json.loads(r.message)["offset"] for r in store.read(C.QUEUE).collect()) == [0, 2, 99]
