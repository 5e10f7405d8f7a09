"""Versioned tables, incremental against full refresh, run log, checks."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from helpers import canonical
from scoreline.operators import quality
from scoreline.plans import layout
from scoreline.plans.catalogue import LEXICON
from scoreline.plans.runner import FULL, INCREMENTAL, SERVING_SLICE, Runner
from scoreline.plans.store import Conflict, TableStore, retry_on_conflict
from scoreline.plans.tables import Tables


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_versions(spark, tmp_path):
    s = TableStore(spark, str(tmp_path))
    assert not s.exists("t")
    s.overwrite("t", kv(spark, (1, "a"), (2, "b")))
    s.append("t", kv(spark, (3, "c")))
    s.replace_keys("t", kv(spark, (2, "B")), ["k"])
    s.replace_where("t", kv(spark, (9, "z")), F.col("k") >= 3)
    assert rows(s.read("t")) == [(1, "a"), (2, "B"), (9, "z")]
    assert rows(s.read("t", 2)) == [(1, "a"), (2, "b"), (3, "c")]
    s.compact("t")
    s.expire("t")
    assert len(s.versions("t")) == 1 and rows(s.read("t")) == [(1, "a"), (2, "B"), (9, "z")]


def test_two_writers_of_one_version_conflict(spark, tmp_path):
    s = TableStore(spark, str(tmp_path))
    v = s.overwrite("t", kv(spark, (1, "a")))
    s.overwrite("t", kv(spark, (2, "b")), base=v)
    with pytest.raises(Conflict):
        s.overwrite("t", kv(spark, (3, "c")), base=v)
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise Conflict("x")

    retry_on_conflict(flaky, sleep=lambda d: None)
    assert len(tries) == 3


@pytest.fixture(scope="module")
def published(spark, sf_dir, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("full")))
    t = Tables(spark, sf_dir, LEXICON)
    out = Runner(t, store, FULL).run(SERVING_SLICE)
    return store, t, out


def test_published_tables_equal_their_plans(spark, sf_dir, published):
    store, _, out = published
    plain = Tables(spark, sf_dir, LEXICON)
    for n in ("features_player_match", "serving_player_profiles", "serving_map_overview_daily"):
        assert canonical(store.read(n).drop("updated_at").toPandas()) == canonical(plain[n].drop("updated_at").toPandas())
    assert out["features_player_match"] == plain["features_player_match"].count()


def test_a_wide_incremental_run_equals_a_full_one(spark, sf_dir, published, tmp_path):
    """Starts from tables without the newest year, then refreshes a window that covers it."""
    full, _, _ = published
    store = TableStore(spark, str(tmp_path))
    cut = dt.date(2000, 8, 1)
    old = full.read("features_player_match").filter(F.col("match_date") < F.lit(cut))
    store.overwrite("features_player_match", old)
    for n in ("features_player_recent_form", "serving_player_match_deep_dive"):
        store.overwrite(n, full.read(n).filter(F.col("match_date") < F.lit(cut)))
    Runner(Tables(spark, sf_dir, LEXICON), store, INCREMENTAL, refresh_days=400).run(SERVING_SLICE)
    for n in ("features_player_match", "features_player_recent_form", "serving_player_profiles", "serving_map_overview_daily", "serving_player_match_deep_dive"):
        assert canonical(store.read(n).drop("updated_at").toPandas()) == canonical(full.read(n).drop("updated_at").toPandas()), n


def test_run_log(published):
    store, _, out = published
    log = {r.step_name: r for r in store.read("ops_pipeline_runs").collect()}
    assert log["pipeline_feature-serving"].status == "success" and log["features_player_match"].row_count == out["features_player_match"]


def test_a_failed_step_is_logged_and_raised(spark, sf_dir, tmp_path):
    store = TableStore(spark, str(tmp_path))
    r = Runner(Tables(spark, sf_dir), store, FULL)
    r.features_player_match = lambda: 1 / 0
    with pytest.raises(ZeroDivisionError):
        r.run(SERVING_SLICE)
    log = {x.step_name: x.status for x in store.read("ops_pipeline_runs").collect()}
    assert log == {"bases": "success", "features_player_match": "failed", "pipeline_feature-serving": "failed"}


def test_checks_find_duplicates_orphans_and_null_keys(spark, published):
    _, t, _ = published
    bad = dict(t.items())
    match = t["features_player_match"].limit(3)
    bad["features_player_match"] = match.unionByName(match).unionByName(match.limit(1).withColumn("steamid", F.lit(None).cast("string")))
    got = {r.check_name: r for r in quality.platform_checks(bad, t.as_of).collect()}
    assert got["features_player_match_duplicate_keys"].status == "FAIL" and got["features_player_match_duplicate_keys"].metric_value == 3
    assert got["features_player_match_null_keys"].metric_value == 1
    assert got["features_recent_form_orphans"].status == "FAIL"
    with pytest.raises(AssertionError, match="features_player_match_duplicate_keys"):
        quality.assert_passed(quality.platform_checks(bad, t.as_of))


def test_checks_on_empty_tables_fail_and_do_not_crash(spark, published):
    _, t, _ = published
    empty = {k: v.limit(0) for k, v in t.items()}
    got = {r.check_name: r.status for r in quality.platform_checks(empty, t.as_of, drift=True).collect()}
    assert got["core_logs_non_empty"] == "FAIL" and got["features_player_match_freshness_days"] == "FAIL" and got["features_player_match_null_keys"] == "PASS"
    assert quality.readiness_checks(empty["features_player_match"], empty["features_player_recent_form"], empty["ml_training_dataset_snapshots"], t.as_of).count() == 12


def test_assert_passed_reads_any_cell(spark):
    quality.assert_passed(kv(spark, (1, "PASS")))
    with pytest.raises(AssertionError):
        quality.assert_passed(kv(spark, (1, " fail ")))


def test_maintenance_and_settings(spark, tmp_path):
    from scoreline.plans.runner import maintain, row_counts, validate_settings

    s = TableStore(spark, str(tmp_path))
    for k in range(5):
        s.append("t", kv(spark, (k, "x")))
    maintain(s, ["t", "absent"])
    assert len(s.versions("t")) == 6 and s.read("t").count() == 5
    assert len(s._fs.listStatus(s._path(s._pointer("t", 6)["parts"]["all"][0]))) <= 3
    s.expire("t", days=14, now=lambda: time.time() + 15 * 86_400)
    assert s.versions("t") == [6] and s.read("t").count() == 5
    assert [tuple(r) for r in row_counts(s, ["t", "absent"]).collect()] == [("t", 5)] and row_counts(s, []).count() == 0
    validate_settings({"a": "b"}, ["a"])
    with pytest.raises(ValueError, match="b, c"):
        validate_settings({"a": "x", "b": "<put it here>", "c": " "}, ["a", "b", "c"])


def test_parts_that_are_not_touched_keep_their_files(spark, tmp_path):
    s = TableStore(spark, str(tmp_path))
    s.overwrite("t", kv(spark, (1, "a"), (1, "b"), (2, "c"), (None, "d")), by="k")
    assert s.parts("t") == ["1", "2", "none"]
    before = s._pointer("t", 1)["parts"]
    s.replace_where("t", kv(spark, (2, "C"), (3, "e")), F.col("k") >= 2, parts=lambda p: p != "none" and int(p) >= 2)
    after = s._pointer("t", 2)["parts"]
    assert after["1"] == before["1"] and after["none"] == before["none"] and after["2"] != before["2"]
    assert sorted((r.k or 0, r.v) for r in s.read("t").collect()) == [(0, "d"), (1, "a"), (1, "b"), (2, "C"), (3, "e")]
    s.replace_keys("t", kv(spark, (1, "z")), ["k"], parts=lambda p: p == "1")
    s.append("t", kv(spark, (1, "y")))
    assert sorted(r.v for r in s.read("t", parts=lambda p: p == "1").collect()) == ["y", "z"]
    s.expire("t")
    assert sorted(r.v for r in s.read("t").collect()) == ["C", "d", "e", "y", "z"]


def test_incremental_bases_follow_new_deliveries(spark, sf_dir, tmp_path):
    """Deliveries that come later are taken up, and months outside of the window are left alone."""
    store, t = TableStore(spark, str(tmp_path)), Tables(spark, sf_dir, LEXICON)
    cut = dt.datetime(2001, 6, 1)
    early = Tables(spark, sf_dir, LEXICON)
    early.replace("logs", t["logs"].filter(F.col("match_time") < F.lit(cut)))
    early.replace("summaries", t["summaries"].filter(F.col("match_time") < F.lit(cut)))
    Runner(early, store, FULL).bases()
    before = store._pointer("summaries_base", 1)["parts"]
    Runner(t, store, INCREMENTAL, refresh_days=90).bases()
    after = store._pointer("summaries_base", 2)["parts"]
    assert after["1999-01"] == before["1999-01"] and "2001-07" in after
    want = Tables(spark, sf_dir, LEXICON)
    for n in ("logs_base", "summaries_base", "messages_base"):
        assert canonical(store.read(n).toPandas()) == canonical(want[n].toPandas()), n


def test_a_refresh_of_few_players_touches_their_buckets_alone(spark, sf_dir, tmp_path):
    """One new match of two players: of all player tables no other bucket is read or written, and all are as if built
    at once."""
    store, t = TableStore(spark, str(tmp_path)), Tables(spark, sf_dir, LEXICON)
    top = t["logs"].agg(F.max("match_time")).first()[0]
    last = t["summaries_base"].filter(F.col("match_time") >= F.lit(top - dt.timedelta(days=0))).select("logid").distinct()
    early = Tables(spark, sf_dir, LEXICON)
    for n in ("logs", "summaries"):
        early.replace(n, t[n].join(last, "logid", "left_anti"))
    names = ["features_player_match", "features_player_recent_form", "serving_player_profiles", "serving_player_match_deep_dive"]
    Runner(early, store, FULL, buckets=64).run(SERVING_SLICE)
    before = {n: store._pointer(n, 1)["parts"] for n in names}
    read = []
    plain = store.read
    store.read = lambda name, version=None, parts=None: read.append((name, plain(name, version, parts).inputFiles())) or plain(name, version, parts) if parts else plain(name, version, parts)
    Runner(t, store, INCREMENTAL, refresh_days=0).run(SERVING_SLICE)
    store.read = plain
    who = plain("features_player_match").filter(F.col("match_date") >= F.lit(top.date())).select("steamid").distinct()
    mine = {str(b) for b in layout.touched(who, 64)}
    assert 0 < len(mine) < 32
    for n in names:
        after = store._pointer(n, 2)["parts"]
        assert {k.split("~")[1] for k in after if after[k] != before[n].get(k)} == mine
        assert all(after[k] == before[n][k] for k in before[n] if k.split("~")[1] not in mine)
        assert store.written(n) == plain(n, parts=layout.parts_of(mine, None if n != names[0] else lambda m: m >= f"{top:%Y-%m}")).count()
    history = [fs for n, fs in read if n == names[0]][1:]  # the first looks for rows of the changed matches
    assert history and all(f.rsplit("~", 1)[1].split("/")[0].split("%")[0] in mine for fs in history for f in fs)
    want = Tables(spark, sf_dir, LEXICON)
    for n in names:
        assert canonical(plain(n).drop("updated_at").toPandas()) == canonical(want[n].drop("updated_at").toPandas()), n


def test_a_player_taken_out_of_a_match_is_refreshed(spark, sf_dir, tmp_path):
    store, t = TableStore(spark, str(tmp_path)), Tables(spark, sf_dir, LEXICON)
    Runner(t, store, FULL, buckets=8).run(SERVING_SLICE)
    last = t["summaries_base"].orderBy(F.desc("match_time"), F.desc("logid")).first()
    later = Tables(spark, sf_dir, LEXICON)
    later.replace("summaries", t["summaries"].filter((F.col("logid") != last.logid) | (F.col("steamid") != last.steamid)))
    later.replace("logs", t["logs"])
    Runner(later, store, INCREMENTAL, refresh_days=3).run(SERVING_SLICE)
    want = Tables(spark, sf_dir, LEXICON)
    want.replace("summaries", later["summaries"])
    for n in ("features_player_match", "features_player_recent_form", "serving_player_profiles", "serving_player_match_deep_dive"):
        assert canonical(store.read(n).drop("updated_at").toPandas()) == canonical(want[n].drop("updated_at").toPandas()), n


def test_layout():
    assert [layout.buckets_for(n) for n in (0, 10, 50_000_000, 50_000_001, 10**10, 10**15)] == [1, 1, 1, 2, 256, 4096]
    assert layout.buckets_of(layout.by_month_and_player(16)) == layout.buckets_of(layout.by_player(16)) == 16
    assert layout.buckets_of(None) is layout.buckets_of("date_format(match_date, 'yyyy-MM')") is None
    keep = layout.parts_of({3}, lambda m: m == "none" or m >= "2001-02")
    assert [keep(p) for p in ("2001-02~3", "2001-01~3", "none~3", "2001-03~4", "2001-02")] == [True, False, True, False, True]


def test_graph_of_steps(spark):
    """Steps run after those that they wait for, side by side otherwise; a failed one stops what waits for it alone."""
    import threading

    from scoreline.plans.runner import STEPS, run_graph

    ran, both = [], threading.Barrier(2, timeout=60)

    def work(step):
        if step in ("b", "c"):
            both.wait()  # passes only if both run at once
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == step
        if step == "b":
            raise ValueError("broken")
        ran.append(step)

    failed = run_graph(spark, {"a": (), "b": ("a",), "c": ("a",), "d": ("b",), "e": ("c", "absent"), "f": ("d", "e")}, work)
    assert ran == ["a", "c", "e"] and list(failed) == ["b"] and str(failed["b"]) == "broken"
    seen = []
    for k, before in STEPS.items():
        assert set(before) <= set(seen)
        seen.append(k)


def test_a_failed_branch_leaves_the_others(spark, sf_dir, tmp_path):
    store = TableStore(spark, str(tmp_path))
    r = Runner(Tables(spark, sf_dir, LEXICON), store, FULL)
    r.features_player_recent_form = lambda: 1 / 0
    with pytest.raises(ZeroDivisionError):
        r.run()
    log = {x.step_name: x.status for x in store.read("ops_pipeline_runs").collect()}
    assert log == {"bases": "success", "features_player_match": "success", "features_player_recent_form": "failed", "serving_map_overview_daily": "success", "ml_progress": "success", "pipeline_all": "failed"}


def test_lineage_of_a_full_run(spark, sf_dir, tmp_path):
    """Events name every published table with its columns and what was read for it; the store's folder has a quote."""
    from scoreline.plans.tables import PUBLISHED

    sent, store = [], TableStore(spark, f"{tmp_path}/it's a store")
    r = Runner(Tables(spark, sf_dir, LEXICON), store, FULL, send=sent.append)
    r.ml_snapshot = lambda: int("it's broken")
    with pytest.raises(ValueError):
        r.run()
    done = {e["job"]["name"]: e for e in sent if e["eventType"] == "COMPLETE"}
    reads = {n: {i["name"] for i in e["inputs"]} for n, e in done.items()}
    assert set(PUBLISHED) <= set(done)
    assert reads["summaries_base"] == {"lineitem", "orders", "part"} and reads["features_player_match"] == {"logs_base", "summaries_base", "messages_base"}
    assert reads["features_player_recent_form"] == {"features_player_match"} and reads["serving_ml_pipeline_progress_daily"] == {"events", "nation", "supplier", "customer"}
    for n in PUBLISHED:
        out = done[n]["outputs"][0]
        assert out["name"] == n and [f["name"] for f in out["facets"]["schema"]["fields"]] == store.read(n).columns
        assert out["outputFacets"]["outputStatistics"]["rowCount"] == store.read(n).count()
    assert len({e["run"]["facets"]["parent"]["run"]["runId"] for e in sent}) == 1
    assert [e["job"]["name"] for e in sent if e["eventType"] == "FAIL"] == ["ml_snapshot"]
    log = {x.step_name: x for x in store.read("ops_pipeline_runs").collect()}
    assert "it's broken" in log["ml_snapshot"].error_text and log["ml_snapshot"].status == "failed"
