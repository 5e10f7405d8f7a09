"""What a review found, each as a small case."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__


def test_profile_lookup_has_the_columns_of_its_sql(spark, sf_dir):
    got = __spark_entry__.queries()["q27_1_profile_lookup"](spark, sf_dir)
    assert got.columns == ["steamid", "impact_percentile", "win_rate_percentile", "tilt_risk_percentile"]


def test_stage_change_of_a_version_in_production(spark, sf_dir, monkeypatch):
    """The version has its stage already, or is not there at all: the SQL's rows all the same."""
    import datetime

    from scoreline.operators import mlops

    when = datetime.datetime(2001, 8, 1, 12)
    rows = [("a", "v1", "production", True, None), ("a", "v2", "production", False, None), ("a", "v3", "staging", None, when), ("b", "v1", "production", True, when)]
    reg = spark.createDataFrame(rows, "model_name string, model_version string, stage string, is_active boolean, promoted_at timestamp_ntz")
    got = {(r.model_name, r.model_version): tuple(r)[2:] for r in mlops.with_stage(reg, "a", "v1", "production", when).collect()}
    assert got == {("a", "v1"): ("production", True, when), ("a", "v2"): ("production", False, None), ("a", "v3"): ("staging", None, when), ("b", "v1"): ("production", True, when)}
    gone = mlops.with_stage(reg, "a", "v9", "production", when).collect()
    assert [r.is_active for r in sorted(gone)] == [False, False, None, True]

    from scoreline.plans import model_queries

    made = spark.createDataFrame([(model_queries.NAME, model_queries.VERSION, "production", True, None)], reg.schema)
    monkeypatch.setattr(model_queries, "_tables", lambda *_: {"ml_model_registry": made})
    assert [tuple(r)[2:] for r in model_queries.stage_change(spark, sf_dir).collect()] == [("production", True, when)]


def test_parts_of_rows_are_exact(spark):
    import datetime
    from decimal import Decimal

    from scoreline.ml import training

    for n in (10, 90, 290, 2_737_680, 10**12 + 10):
        for a in (0.1, 0.2, 0.6, 0.7, 0.8, 0.85):
            assert training.part_of(n, a) == int(n * Decimal(str(a)))
    assert int(2_737_680 * 0.7) == training.part_of(2_737_680, 0.7) - 1  # what doubles give
    at = datetime.datetime(2001, 1, 1)
    rows = spark.createDataFrame([(at + datetime.timedelta(hours=k), k, "a") for k in range(90)], "match_time timestamp_ntz, logid long, steamid string")
    sizes = {name: (a.count(), b.count()) for name, a, b in training.temporal_folds(rows, 5, 1)}
    assert sizes == {"fold_60_10": (54, 9), "fold_70_10": (63, 9), "fold_80_20": (72, 18)}


def test_words_of_a_long_text_take_time_in_line_with_its_length(spark):
    """A text of 200,000 words was cut again for each of its words."""
    import time

    from scoreline.ml import sentiment

    text = "Not, good games are never really that bad! " * 25_000
    rows = spark.createDataFrame([(text, 1), ("good", 0)], "text string, y int")
    began = time.time()
    got = {r.word: (r.pos, r.neg) for r in sentiment.word_counts(rows, "text", "y").collect()}
    assert time.time() - began < 60
    assert {w for w, (pos, _) in got.items() if pos} == sentiment.words_of(text) and got["good"] == (1, 1)


def test_rows_of_the_smallest_hashes(spark):
    from pyspark.sql import functions as F

    from scoreline.ml import sentiment

    rows = spark.createDataFrame([(f"t{k % 40}", k % 2) for k in range(100)], "text string, y int")
    for most in (1, 7, 50, 99, 100, 1000):
        want = rows.orderBy(F.xxhash64("text", "y"), "text", "y").limit(most).collect()
        assert sorted(sentiment.smallest(rows, most, "text", "y").collect()) == sorted(want)


def test_deep_dive_profiles_and_snapshot_take_one_shuffle_by_player(spark, sf_dir):
    """What the features alone tell is what features and form tell, without a join of the two."""
    from scoreline.operators import features, mlops, serving
    from scoreline.plans.tables import Tables

    t = Tables(spark, sf_dir)
    f = t["features_player_match"].persist()
    form = features.recent_form(f)
    pairs = [
        (serving.deep_dive_at_once(f), serving.match_deep_dive(f, form)),
        (serving.player_profiles(f), serving.player_profiles(f, form)),
        (mlops.snapshot_rows(f, None, t["logs_base"]), mlops.snapshot_rows(f, form, t["logs_base"])),
    ]
    for one, two in pairs:
        assert sorted(one.columns) == sorted(two.columns)
        two = two.select(*one.columns)
        assert one.count() == two.count() and one.exceptAll(two).isEmpty()
    f.unpersist()
    plan = t["serving_player_match_deep_dive"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == t["features_player_match"]._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_refreshed_store_keeps_one_version(spark, sf_dir):
    from scoreline.plans import ingest_queries
    from scoreline.plans.runner import Runner

    steps = Runner.steps_for("serving_player_match_deep_dive")
    assert steps == ["bases", "features_player_match", "serving_player_match_deep_dive"]
    store = ingest_queries.refreshed_store(spark, sf_dir, steps)
    for n in ("logs_base", "summaries_base", "features_player_match", "serving_player_match_deep_dive"):
        assert store.versions(n) == [2]


def test_player_rows_move_once_by_match(spark, sf_dir, tmp_path):
    """Deduplication finds the rows where the join by match has put them, and so do the team windows of stored rows."""
    from scoreline.functions.chat import lexicon_scorer
    from scoreline.operators import features
    from scoreline.plans.store import TableStore
    from scoreline.plans.tables import Tables

    size = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(size)
    spark.conf.set(size, "-1")
    try:
        t, store = Tables(spark, sf_dir), TableStore(spark, str(tmp_path))
        exchanges = lambda df: [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
        assert len(exchanges(t["summaries_base"])) == 4  # lines and parts by part, lines and orders by match
        for n in ("summaries_base", "logs_base", "messages_base"):
            store.overwrite(n, t[n].limit(50))
        rows = features.player_match(*[store.read(n) for n in ("summaries_base", "logs_base", "messages_base")], lexicon_scorer())
        assert exchanges(rows) and not [x for x in exchanges(rows) if "team#" in x]
    finally:
        spark.conf.set(size, before)


def test_refresh_of_the_map_overview_writes_what_it_takes(spark, sf_dir):
    from scoreline.operators import serving
    from scoreline.plans import ingest_queries
    from scoreline.plans.runner import Runner

    store = ingest_queries.refreshed_store(spark, sf_dir, Runner.steps_for("serving_map_overview_daily"))
    assert set(store.read("features_player_match").columns) == {"logid", *serving.OVERVIEW_TAKES}
    assert not store._names(f"{store.root}/refresh_summaries_base") and not store._names(f"{store.root}/refresh_logs_base")
    assert store.versions("summaries_base") == [2]


def test_form_in_chunks_reads_written_player_rows(spark, sf_dir):
    """Counting and cutting chunks made the player rows from the source anew, pass by pass."""
    from scoreline.plans import ingest_queries

    got = ingest_queries.form_in_chunks(spark, sf_dir)
    read = got.inputFiles()
    assert read and all("/features_player_match/" in f for f in read)


def test_maintenance_finds_only_its_table(spark, sf_dir, monkeypatch):
    """What the map overview was made of stayed on disk beside its merged copy."""
    from scoreline.plans import ingest_queries
    from scoreline.plans.store import TableStore

    seen, compact = [], TableStore.compact
    monkeypatch.setattr(TableStore, "compact", lambda self, name: (seen.append(sorted(self._names(self.root))), compact(self, name)))
    assert ingest_queries.maintained(spark, sf_dir).count() > 0
    assert seen == [["ops_pipeline_runs", "serving_map_overview_daily"]]


def test_a_failure_is_no_result_of_the_lexicon(spark, sf_dir, monkeypatch):
    """Any error on the way to a model, a failed job's too, gave the lexicon's numbers in its place."""
    import pytest

    from scoreline.functions import chat
    from scoreline.ml import sentiment
    from scoreline.plans import ingest_queries

    def broken(*_):
        raise OSError("no space left on device")

    lost = lambda: spark.read.parquet(f"{sf_dir}/no_such_table.parquet")
    for way, error in ((broken, OSError), (lost, Exception)):
        with pytest.raises(error):
            chat.first_that_works(way)
    labelled = spark.createDataFrame([("trash", 1), ("good", 1)], "text string, toxic int")
    for rows in (labelled, labelled.limit(0)):
        monkeypatch.setattr(ingest_queries, "_labelled", lambda *_, rows=rows: rows)
        with pytest.raises(sentiment.OneLabel):
            ingest_queries.model_chat(spark, sf_dir)
    monkeypatch.setattr(ingest_queries, "_labelled", broken)
    with pytest.raises(OSError):
        ingest_queries.model_chat(spark, sf_dir)


def test_training_rows_in_slices_are_those_of_one_plan(spark, sf_dir):
    """Rows without a match, a time or a player among them, and no rows at all."""
    from pyspark.sql import functions as F

    from scoreline.operators import mlops
    from scoreline.plans import slices
    from scoreline.plans.tables import Tables

    odd = Tables(spark, sf_dir)
    rows = odd["summaries"]
    for c, at in (("match_time", 0), ("steamid", 1), ("logid", 2)):
        rows = rows.withColumn(c, F.when(F.pmod(F.xxhash64("recordid"), F.lit(23)) != at, F.col(c)))
    odd.replace("summaries", rows)
    none = Tables(spark, sf_dir)
    none.replace("summaries", none["summaries"].filter("false"))
    for t, n in ((odd, 3), (none, 2)):
        one = mlops.snapshot_rows(t["features_player_match"], None, t["logs_base"])
        got = slices.training_rows(t, n)
        assert got.columns == one.columns and [f.dataType for f in got.schema] == [f.dataType for f in one.schema]
        assert got.count() == one.count() and got.exceptAll(one).isEmpty() and (t is none or one.count() > 1000)
    assert [slices.slices_for(k) for k in (0, 1, 500_000, 500_001, 10**12)] == [1, 1, 1, 2, 8]


def test_training_rows_leave_only_themselves_on_disk(spark, sf_dir, monkeypatch):
    """One plan kept all of its shuffles to the end; slices keep a part of one table, and what is made of it."""
    import __spark_entry__

    from scoreline.plans import slices
    from scoreline.plans.store import TableStore

    seen, drop = [], TableStore.drop_parts

    def dropped(self, name, parts):
        drop(self, name, parts)
        seen.append((name, len(self.parts(name)), sum(n.startswith("_part=") for top in self._names(f"{self.root}/{name}") for n in self._names(f"{self.root}/{name}/{top}"))))

    monkeypatch.setattr(TableStore, "drop_parts", dropped)
    monkeypatch.setattr(slices, "ROWS_PER_SLICE", 2500)
    files = __spark_entry__.queries()["t_ml_training_player_match"](spark, sf_dir).inputFiles()
    assert files and all("/training_rows/" in f for f in files)
    names = [name for name, _, _ in seen]
    assert names == sorted(names) and set(names) == {"by_day", "by_player"} and all(left == 0 for name, left, _ in (seen[names.index("by_player") - 1], seen[-1]))
    assert [left for name, left, _ in seen if name == "by_day"] == list(range(names.count("by_day")))[::-1]
    # pieces of parts that are still to come are all that is left
    assert all(pieces == 0 for _, left, pieces in seen if not left)
