"""Queries over the registry, its gates and changes, and over prepared features, with SQL of the same rows."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import rnd
from ..ml import training
from ..operators import mlops
from . import catalogue, ingest_queries, oracle
from .runner import SERVING_SLICE, row_counts
from .tables import Tables

WHEN = datetime.datetime(2001, 8, 1, 12)
NAME, VERSION = "win_probability_baseline", "v3"
KEYS = ["model_name", "model_version"]


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir, catalogue.LEXICON)


def promotion_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gate of every registered version."""
    t = _tables(spark, sf_dir)
    return mlops.gate_table(t["ml_model_registry"], t["ml_model_validation_metrics_daily"])


def stage_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry once a version has become the production one of its model, also if it was that before."""
    new = mlops.with_stage(_tables(spark, sf_dir)["ml_model_registry"], NAME, VERSION, "production", WHEN)
    return new.select(*KEYS, "stage", "is_active", "promoted_at")


def rollback_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mlops.rollback_targets(_tables(spark, sf_dir)["ml_model_registry"])


def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after the even suppliers' versions have been registered again, as candidates."""
    old = _tables(spark, sf_dir)["ml_model_registry"]
    again = F.substring("model_version", 2, 20).cast("int") % 2 == 0
    new = old.filter(again).withColumns({"stage": F.lit("candidate"), "is_active": F.lit(False), "created_at": F.to_timestamp_ntz(F.lit("2001-08-01 12:00:00"))})
    return mlops.upsert(old, new, KEYS).select(*KEYS, "stage", "is_active", "created_at")


def metrics_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily figures once those of the newest snapshots' keys have come again with other row counts; by model."""
    old = _tables(spark, sf_dir)["ml_model_validation_metrics_daily"]
    keys = [*KEYS, "snapshot_id"]
    new = old.filter(F.col("rows_total") > 250).withColumn("rows_total", F.col("rows_total") + 7)
    return mlops.upsert(old, new, keys).groupBy("model_name").agg(F.count("*").alias("n"), F.sum("rows_total").alias("rows_total"))


def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all player and map tables after a full and an incremental run."""
    return row_counts(ingest_queries.refreshed_store(spark, sf_dir, SERVING_SLICE), list(ingest_queries.REFRESHED))


def linear_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What linear models see, summed by map: two scaled numbers and the most frequent text."""
    rows = _tables(spark, sf_dir)["features_player_match"].select("map", "team", F.when(F.col("kills") % 7 != 0, F.col("kills")).cast("double").alias("kills"), F.col("deaths").cast("double"))
    made = Pipeline(stages=training.preprocess(["kills", "deaths"], ["team"], True)).fit(rows).transform(rows)
    f = made.select("map", vector_to_array("features").alias("f"))
    return f.groupBy("map").agg(rnd(F.sum(F.col("f")[0]), 4).alias("kills"), rnd(F.sum(F.col("f")[1]), 4).alias("deaths"), F.sum(F.col("f")[2]).cast("long").alias("first_team"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "m_promotion_gates": promotion_gates,
    "m_stage_change": stage_change,
    "m_rollback_targets": rollback_targets,
    "m_registry_upsert": registry_upsert,
    "m_metrics_upsert": metrics_upsert,
    "m_linear_features": linear_features,
    "r_row_counts": published_counts,
}

_LINEAGE = ("snapshot_id", "training_code_version", "feature_sql_version", "artifact_uri")
_FIGURES = ("f1", "brier", "recall", "rmse", "mae")
_GATES = ", ".join(f"('{n}', '{g}', '{m}', '{op}', {t}::double)" for n, gs in mlops.GATES.items() for g, m, op, t in gs)

SQL: dict[str, str] = {
    "m_promotion_gates": oracle.compose(f"""select * from (with v as (select * from ml_model_registry qualify row_number() over (partition by model_name, model_version order by created_at desc, snapshot_id desc) = 1),
  g(name, gate, metric, op, target) as (values {_GATES}),
  l as (select model_name, model_version, 'lineage_' || k as gate, coalesce(trim(x), '') <> '' as ok from ({' union all '.join(f"select model_name, model_version, '{c}' as k, {c} as x from v" for c in _LINEAGE)}) a),
  m as (select model_name, model_version, {', '.join(f"try_cast(json_extract_string(metrics_json, '$.{c}') as double) as m_{c}" for c in _FIGURES)} from v),
  f as (select model_name, model_version, gate, op, target, case metric {' '.join(f"when '{c}' then m_{c}" for c in _FIGURES)} end as x from m join g on model_name = name),
  s as (select v.model_name, v.model_version, count(distinct progress_date) as days, coalesce(stddev_samp(f1), 0.0) as spread from v
    left join ml_model_validation_metrics_daily d on v.model_name = d.model_name and v.model_version = d.model_version and f1 is not null where v.model_name = 'tilt_risk_baseline' group by 1, 2)
  select model_name, model_version, gate, case when ok then 'PASS' else 'FAIL' end as status from (
    select * from l union all select model_name, model_version, gate, coalesce(case op when '>=' then x >= target else x <= target end, false) from f
    union all select model_name, model_version, 'tilt_daily_days', days >= {mlops.MIN_DAYS} from s
    union all select model_name, model_version, 'tilt_daily_f1_stddev', {oracle.r('spread', 9)} <= {mlops.MAX_F1_SPREAD} from s) z) y""", "ml_model_registry", "ml_model_validation_metrics_daily"),
    "m_stage_change": oracle.compose(f"""select model_name, model_version, case when mine then 'production' else stage end as stage,
  case when mine then true when model_name = '{NAME}' and stage = 'production' then false else is_active end as is_active, case when mine then timestamp '{WHEN}' else promoted_at end as promoted_at
  from (select *, model_name = '{NAME}' and model_version = '{VERSION}' as mine from ml_model_registry) x""", "ml_model_registry"),
    "m_rollback_targets": oracle.compose("""select model_name, model_version from ml_model_registry where not coalesce(is_active, false) and stage in ('staging', 'archived', 'production')
  qualify row_number() over (partition by model_name order by coalesce(promoted_at, created_at) desc, model_version desc) = 1""", "ml_model_registry"),
    "m_registry_upsert": oracle.compose("""select model_name, model_version, case when again then 'candidate' else stage end as stage, case when again then false else is_active end as is_active,
  case when again then timestamp '2001-08-01 12:00:00' else created_at end as created_at from (select *, cast(substr(model_version, 2) as integer) % 2 = 0 as again from ml_model_registry) x""", "ml_model_registry"),
    "m_metrics_upsert": oracle.compose("""select * from (with d as (select * from ml_model_validation_metrics_daily), k as (select distinct model_name, model_version, snapshot_id from d where rows_total > 250)
  select model_name, count(*) as n, cast(sum(rows_total) as bigint) as rows_total from (
    select model_name, rows_total from d anti join k using (model_name, model_version, snapshot_id) union all select model_name, rows_total + 7 from d where rows_total > 250) x group by 1) y""", "ml_model_validation_metrics_daily"),
    "m_linear_features": oracle.compose(f"""select * from (with t as (select map, team, case when kills % 7 <> 0 then kills end::double as kills, deaths::double as deaths from features_player_match),
  s as (select median(kills) as mk, median(deaths) as md from t), u as (select map, team, coalesce(kills, mk) as k, coalesce(deaths, md) as d from t, s),
  z as (select avg(k) as ak, stddev_samp(k) as sk, avg(d) as ad, stddev_samp(d) as sd from u), f as (select team as first from u where team is not null group by team order by count(*) desc, team limit 1)
  select map, {oracle.r('coalesce(sum((k - ak) / nullif(sk, 0)), 0.0)', 4)} as kills, {oracle.r('coalesce(sum((d - ad) / nullif(sd, 0)), 0.0)', 4)} as deaths,
  count(*) filter (coalesce(team, first) = first) as first_team from u, z, f group by map) y""", "features_player_match"),
    "r_row_counts": " union all ".join(f"select '{n}' as table_name, count(*) as row_count from ({oracle.SQL['x_t_' + n]}) q{k}" for k, n in enumerate(ingest_queries.REFRESHED)),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
