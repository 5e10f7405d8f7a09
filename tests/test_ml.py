"""Snapshots, registry, gates, metrics and training."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreline.ml import metrics as M
from scoreline.ml import training as T
from scoreline.operators import mlops
from scoreline.plans.catalogue import LEXICON
from scoreline.plans.tables import Tables
from scoreline.schemas import MODEL_REGISTRY, VALIDATION_METRICS

NOW = dt.datetime(2024, 1, 1)


def registry(spark, *rows):
    full = [{"model_name": "win_probability_baseline", "model_version": "v1", "task_type": "classification", "stage": "candidate", "snapshot_id": "s", "training_code_version": "c", "feature_sql_version": "f", "artifact_uri": "u", "metrics_json": None, "calibration_notes": None, "created_at": NOW, "promoted_at": None, "is_active": False, **r} for r in rows]
    return spark.createDataFrame([tuple(r.values()) for r in full], MODEL_REGISTRY)


def no_metrics(spark):
    return spark.createDataFrame([], VALIDATION_METRICS)


@pytest.mark.parametrize("js, name, value", [('{"f1": 0.5}', "f1", 0.5), ('{"f1": NaN}', None, None), ("{}", None, None), (None, None, None), ('{"mae": 3, "rmse": 4}', "rmse", 4.0)])
def test_primary_metric(spark, js, name, value):
    snaps = spark.createDataFrame([], "snapshot_id string, snapshot_cutoff_time timestamp, snapshot_cutoff_date date, source_match_rows long, source_recent_form_rows long, training_rows long, created_at timestamp")
    r = mlops.serving_registry(registry(spark, {"metrics_json": js}), snaps, dt.date(2024, 1, 11)).first()
    assert (r.primary_metric_name, r.primary_metric_value, r.data_age_days) == (name, value, 10)


def test_step_names_are_no_patterns(spark):
    runs = spark.createDataFrame([(n, "success", NOW, 1.0, "r") for n in ("pipeline", "pipeline_ml", "pipelineX")], "step_name string, status string, started_at timestamp, duration_seconds double, run_id string")
    t = lambda ddl: spark.createDataFrame([], ddl)
    snaps = t("snapshot_id string, snapshot_cutoff_date date, training_rows long, created_at timestamp")
    got = mlops.pipeline_progress_daily(runs, snaps, t(MODEL_REGISTRY), t("to_stage string, changed_at timestamp")).first()
    assert got.pipeline_success_runs == 2 and got.active_production_models == 0


def test_gates(spark):
    reg = registry(spark, {"metrics_json": '{"f1": 0.7, "brier": 0.3}', "artifact_uri": " "})
    got = {g[0]: g[1] for g in mlops.promotion_gates(reg, no_metrics(spark), "win_probability_baseline", "v1")}
    assert got["win_f1"] == "PASS" and got["win_brier"] == "FAIL" and got["lineage_artifact_uri"] == "FAIL" and got["lineage_snapshot_id"] == "PASS"
    assert mlops.gate("x", math.nan, ">=", 1)[1] == mlops.gate("x", None, ">=", 1)[1] == "FAIL"
    tilt = registry(spark, {"model_name": "tilt_risk_baseline", "metrics_json": "{}"})
    got = {g[0]: g[1] for g in mlops.promotion_gates(tilt, no_metrics(spark), "tilt_risk_baseline", "v1")}
    assert got["tilt_f1"] == "FAIL" and got["tilt_daily_days"] == "FAIL" and got["tilt_daily_f1_stddev"] == "PASS"
    with pytest.raises(ValueError):
        mlops.promotion_gates(reg, no_metrics(spark), "win_probability_baseline", "v9")


def test_stage_changes(spark):
    reg = registry(spark, {"stage": "production", "is_active": True}, {"model_version": "v2"})
    new, log = mlops.change_stage(reg, "win_probability_baseline", "v2", "production", "me", "why", NOW)
    got = {r.model_version: r for r in new.collect()}
    assert got["v2"].is_active and got["v2"].promoted_at == NOW and not got["v1"].is_active and got["v1"].stage == "production"
    assert log.first().from_stage == "candidate"
    assert mlops.change_stage(new, "win_probability_baseline", "v2", "production", "me", "", NOW) is None
    assert mlops.rollback_target(new, "win_probability_baseline") == "v1"
    with pytest.raises(ValueError, match="gates failed"):
        mlops.change_stage(reg, "win_probability_baseline", "v2", "staging", "me", "", NOW, no_metrics(spark))
    with pytest.raises(ValueError, match="no such stage"):
        mlops.change_stage(reg, "win_probability_baseline", "v2", "live", "me", "", NOW)


def test_percentiles_of_a_day(spark):
    rows = [(i, f"p{i}", NOW, dt.date(2024, 1, 1), "Red", i / 1000.0, 1, 0) for i in range(250)]
    f = spark.createDataFrame(rows, "logid long, steamid string, match_time timestamp_ntz, match_date date, team string, impact_index double, won_game int, possible_tilt_label int").withColumn("classes_played_csv", F.lit(""))
    form = spark.createDataFrame([], "steamid string, logid long, games_played_to_date int, career_avg_kills double, career_avg_damage double, career_avg_impact double, rolling_5_avg_kills double, rolling_10_avg_damage double, rolling_10_avg_impact double, rolling_10_kda_ratio double, rolling_10_win_rate double, rolling_10_negative_chat_ratio double, form_delta_kills double, form_delta_damage double, form_delta_impact double, momentum_label string")
    logs = spark.createDataFrame([(1, 3, 1)], "logid long, redscore long, bluescore long")
    got = mlops.snapshot_rows(f, form, logs)
    n = {r.label_impact_percentile: r["count"] for r in got.groupBy("label_impact_percentile").count().collect()}
    assert len(n) == 100 and all(n[k] == (3 if k <= 50 else 2) for k in n)
    one = got.filter("logid = 1").first()
    assert (one.team_score, one.opponent_score, one.score_delta, one.snapshot_id) == (3, 1, 2, "train_1704067200")


def scored(spark, y, p):
    return spark.createDataFrame(list(zip(map(int, y), map(float, p))), "y int, p double")


@pytest.mark.parametrize("y, p, auc", [([0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9], 1.0), ([0, 1, 0, 1], [0.5] * 4, 0.5), ([1, 1], [0.1, 0.9], None)])
def test_auc(spark, y, p, auc):
    assert M.binary_metrics(scored(spark, y, p)).first().roc_auc == auc


def test_areas_against_brute_force(spark):
    rng = np.random.default_rng(0)
    y, p = rng.integers(0, 2, 200), np.round(rng.random(200), 1)
    r = M.binary_metrics(scored(spark, y, p), 0.5).first()
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        rec, pre = (pos >= t).sum() / len(pos), (pos >= t).sum() / (p >= t).sum()
        ap, last = ap + (rec - last) * pre, rec
    assert abs(r.roc_auc - auc) < 1e-12 and abs(r.pr_auc - ap) < 1e-12 and abs(r.brier - np.mean((p - y) ** 2)) < 1e-12


def test_bins_and_thresholds(spark):
    s = scored(spark, [0, 1, 1], [0.0, 0.1, 1.0])
    assert [(r.bin, r.rows) for r in M.calibration_table(s).collect()] == [(0, 2), (9, 1)]
    best = M.choose_threshold(M.threshold_table(s, [0.05, 0.5]), 0.9, 0.9)
    assert best.threshold == 0.05 and best.selected_by_constraints
    assert not M.choose_threshold(M.threshold_table(s, [0.5]), 1.0, 1.0).selected_by_constraints


def test_folds_and_splits(spark):
    df = spark.range(100).select(F.col("id").alias("logid"), F.lit("a").alias("steamid"), F.timestamp_seconds(F.col("id") * 40000).alias("match_time"))
    a, b = T.split_time(df)
    assert a.count() == 80 and a.agg(F.max("logid")).first()[0] < b.agg(F.min("logid")).first()[0]
    assert [(n, x.count(), y.count()) for n, x, y in T.temporal_folds(df, 65, 5)] == [("fold_70_10", 70, 10), ("fold_80_20", 80, 20)]


def test_leakage_and_gates():
    with pytest.raises(RuntimeError, match="score_delta"):
        T.assert_no_leakage("win", ["kills", "score_delta"], ["score_delta"])
    assert T.fold_metric([0.5], "std") == 0.0 and math.isnan(T.fold_metric([], "min"))
    got = {g[0]: g[1] for g in T.training_gates("win_probability_baseline", {"f1": 0.7, "brier": 0.1}, [{"f1": 0.5}, {"f1": 0.9}])}
    assert got == {"f1": "PASS", "brier": "PASS", "min_fold_f1": "FAIL"}
    assert T.metrics_json({"a": math.nan, "b": 1.0}) == '{"a": null, "b": 1.0}'
    assert "| a |" in T.report("R", {"S": [{"a": 1.0}]})


def test_feature_quality(spark):
    df = spark.createDataFrame([("m1", float(i)) for i in range(101)] + [("m2", None), (None, 1e9)], "map string, x double")
    got = T.FeatureQuality(["x"], min_count=50).fit(df).transform(df)
    assert {r.map for r in got.collect()} == {"m1", "__OTHER__"} and got.agg(F.max("x")).first()[0] < 1e9


def test_models_train_on_a_snapshot(spark, sf_dir):
    t = Tables(spark, sf_dir, LEXICON)
    rows = mlops.snapshot_rows(t["features_player_match"], t["features_player_recent_form"], t["logs_base"]).persist()
    nums, texts = ["rolling_5_avg_kills", "rolling_10_win_rate", "kills", "deaths"], ["map", "momentum_label"]
    train, test = T.split_time(rows)
    model, platt = T.fit_calibrated(lambda d: T.win_model(nums, texts, iterations=3, depth=3).fit(d), train, "label_win", least=100)
    r = M.binary_metrics(platt.apply(model.transform(test)).withColumnRenamed("label_win", "y")).first()
    assert 0 <= r.brier <= 1 and r.rows_total == test.count()
    reg = T.impact_model(nums, texts, iterations=3, depth=3).fit(train)
    m = M.regression_metrics(T.clip_percentile(reg.transform(test)).withColumnRenamed("label_impact_percentile", "y")).first()
    assert m.rmse >= m.mae > 0
    pipe, weighted = T.tilt_model(train.withColumn("label_tilt", (F.col("deaths") > 15).cast("int")), nums, texts)
    tilt = T.probability(pipe.fit(weighted).transform(test.withColumn("y", (F.col("deaths") > 15).cast("int"))))
    assert M.binary_metrics(tilt).first().roc_auc > 0.95
    imp = T.permutation_importance(lambda d: M.ranking_areas(T.probability(pipe.fit(weighted).transform(d)).withColumn("y", (F.col("logid") % 2).cast("int"))).first().roc_auc or 0.0, test, ["kills"], sample=50, repeats=1)
    assert imp[0][0] == "kills"
    rows.unpersist()


def test_baselines_are_trained_registered_and_rolled_back(spark, sf_dir, tmp_path):
    from scoreline.ml import baselines as B
    from scoreline.plans.store import TableStore

    t = Tables(spark, sf_dir, LEXICON)
    rows = mlops.snapshot_rows(t["features_player_match"], t["features_player_recent_form"], t["logs_base"]).limit(1500).withColumn("label_tilt", (F.col("deaths") > 20).cast("int")).persist()
    trained = B.train_all(rows, "v1", iterations=2, min_fold=(200, 50), depth=3)
    assert [x.name for x in trained] == ["win_probability_baseline", "impact_percentile_baseline", "tilt_risk_baseline"]
    assert all(len(x.folds) == 3 for x in trained) and trained[2].holdout["roc_auc"] > 0.9
    store, sid = TableStore(spark, str(tmp_path / "store")), rows.first().snapshot_id
    for v in ("v1", "v2"):
        text = B.register(store, trained, v, sid, NOW, str(tmp_path / "models"))
    assert "# Offline evaluation" in text and store.read("ml_model_registry").count() == 6
    model, facts = B.load_model(str(tmp_path / "models/win_probability_baseline/v2"))
    assert facts["snapshot_id"] == sid
    a, b = (sorted(r.prediction for r in m.transform(rows).select("prediction").collect()) for m in (model, trained[0].model))
    assert a == b
    new, log = mlops.change_stage(store.read("ml_model_registry"), "tilt_risk_baseline", "v2", "production", "me", "", NOW)
    store.overwrite("ml_model_registry", new)
    new, _ = mlops.change_stage(store.read("ml_model_registry"), "tilt_risk_baseline", "v1", "archived", "me", "", NOW)
    store.overwrite("ml_model_registry", new)
    assert B.rollback(store, "tilt_risk_baseline", "me", "bad", NOW, enforce=False) == "v1"
    got = {r.model_version: r.is_active for r in store.read("ml_model_registry").filter("model_name = 'tilt_risk_baseline'").collect()}
    assert got == {"v1": True, "v2": False} and store.read("ml_model_stage_history").count() == 1
    rows.unpersist()


def test_texts(spark):
    """The most frequent value for a missing one; -1 for one that was not seen."""
    df = spark.createDataFrame([("b",), ("b",), ("a",), (None,)], "m string")
    model = T.Texts(["m"], True).fit(df)
    got = model.transform(spark.createDataFrame([("a",), ("b",), (None,), ("new",)], "m string")).collect()
    assert [(r.m, r.m_i) for r in got] == [("a", 0.0), ("b", 1.0), ("b", 1.0), ("new", -1.0)]
    empty = T.Texts(["m"], True).fit(df.limit(0)).transform(df).collect()
    assert {r.m_i for r in empty} == {-1.0}


@pytest.mark.parametrize("distinct", [3, 5000])
def test_areas_over_many_ranges(spark, distinct):
    rng = np.random.default_rng(1)
    y, p, g = rng.integers(0, 2, 6000), rng.integers(0, distinct, 6000) / distinct, rng.integers(0, 2, 6000)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, p, g)], "y int, p double, g int")
    for r in M.ranking_areas(df, ["g"]).collect():
        mine = g == r.g
        order = np.argsort(p[mine], kind="stable")
        ps, ys = p[mine][order], y[mine][order]
        rank = (np.searchsorted(ps, ps, "left") + np.searchsorted(ps, ps, "right") + 1) / 2
        n1, n0 = ys.sum(), (1 - ys).sum()
        assert r.roc_auc == pytest.approx((rank[ys == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0))
