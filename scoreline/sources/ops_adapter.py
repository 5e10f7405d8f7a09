"""Operational and model tables from the star schema, as SQL that both Spark and other engines read.

Braces name the input table, at signs shared expressions. Values are derived from keys, so every size of the inputs gives a consistent
history: runs, model versions in all stages, snapshots and daily validation metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SHARED = {
    "@name": "CASE s % 3 WHEN 0 THEN 'win_probability_baseline' WHEN 1 THEN 'impact_percentile_baseline' ELSE 'tilt_risk_baseline' END",
    "@task": "CASE s % 3 WHEN 1 THEN 'regression' ELSE 'classification' END",
    "@open": "chr(123)",
    "@shut": "chr(125)",
}


def _sql(text: str) -> str:
    for k, v in _SHARED.items():
        text = text.replace(k, v)
    return text


SQL = {
    "ops_pipeline_runs": """
SELECT 'run' || CAST(event_id AS STRING) AS run_id, 'incremental' AS run_mode,
  CASE event_id % 4 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'pipeline_ml' WHEN 2 THEN 'pipelineX' ELSE 'features_player_match' END AS step_name,
  CASE WHEN event_id % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
  ts AS started_at, ts AS finished_at, CAST(event_id % 300 AS DOUBLE) AS duration_seconds,
  CAST(user_id AS BIGINT) AS row_count, CAST(NULL AS STRING) AS error_text, ts AS created_at FROM {events}""",
    "ml_training_dataset_snapshots": """
SELECT 'train_' || CAST(n_nationkey AS STRING) AS snapshot_id, CAST(DATE '2001-06-01' + CAST(n_nationkey * 2 AS INT) AS @time) AS snapshot_cutoff_time,
  DATE '2001-06-01' + CAST(n_nationkey * 2 AS INT) AS snapshot_cutoff_date, CAST(n_nationkey * 1000 AS BIGINT) AS source_match_rows,
  CAST(n_nationkey * 1000 AS BIGINT) AS source_recent_form_rows, CAST(n_nationkey * 900 AS BIGINT) AS training_rows,
  CAST(DATE '2001-06-02' + CAST(n_nationkey * 2 AS INT) AS @time) AS created_at FROM {nation}""",
    "ml_model_registry": """
SELECT @name AS model_name, 'v' || CAST(s AS STRING) AS model_version, @task AS task_type,
  CASE n % 4 WHEN 0 THEN 'candidate' WHEN 1 THEN 'staging' WHEN 2 THEN 'production' ELSE 'archived' END AS stage,
  'train_' || CAST(n + CASE WHEN s % 5 = 0 THEN 100 ELSE 0 END AS STRING) AS snapshot_id, 'code1' AS training_code_version, 'sql1' AS feature_sql_version,
  CASE WHEN s % 6 = 0 THEN ' ' ELSE 'file:/models/' || CAST(s AS STRING) END AS artifact_uri,
  CASE s % 5 WHEN 0 THEN @open || '"f1": 0.' || CAST(100 + s % 900 AS STRING) || @shut
    WHEN 1 THEN @open || '"rmse": ' || CAST(s % 40 AS STRING) || '.5, "mae": 12.25' || @shut
    WHEN 2 THEN @open || @shut WHEN 3 THEN CAST(NULL AS STRING)
    ELSE @open || '"auc": 0.7' || CAST(s % 100 AS STRING) || ', "precision": 0.5, "recall": null' || @shut END AS metrics_json,
  'none' AS calibration_notes, CAST(DATE '2001-05-20' + CAST(s % 60 AS INT) AS @time) AS created_at,
  CASE WHEN n % 4 IN (1, 2) THEN CAST(DATE '2001-05-25' + CAST(s % 60 AS INT) AS @time) END AS promoted_at,
  CASE WHEN s % 7 = 0 THEN CAST(NULL AS BOOLEAN) ELSE n % 4 = 2 AND s % 2 = 0 END AS is_active
FROM (SELECT s_suppkey AS s, s_nationkey AS n FROM {supplier}) x""",
    "ml_model_stage_history": """
SELECT @name AS model_name, 'v' || CAST(s AS STRING) AS model_version, 'candidate' AS from_stage,
  CASE s % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'production' ELSE 'archived' END AS to_stage, 'ops' AS changed_by, 'test' AS change_reason,
  CAST(DATE '2001-05-01' + CAST(s % 100 AS INT) AS @time) AS changed_at FROM (SELECT c_custkey AS s FROM {customer}) x WHERE s % 3 < 2""",
    "ml_model_validation_metrics_daily": """
SELECT @name AS model_name, 'v' || CAST(s AS STRING) AS model_version, @task AS task_type, 'train_' || CAST(s % 25 AS STRING) AS snapshot_id,
  DATE '2001-04-01' + CAST(d AS INT) AS progress_date, CAST(z * 10 AS BIGINT) AS rows_total, z / 128.0 AS observed_positive_rate, z / 64.0 AS predicted_positive_rate,
  CASE WHEN s % 3 <> 1 THEN z / 128.0 END AS precision, CASE WHEN s % 3 <> 1 THEN z / 64.0 END AS recall, CASE WHEN s % 3 <> 1 THEN z / 80.0 END AS f1,
  CASE WHEN s % 3 <> 1 THEN z / 100.0 END AS roc_auc, CASE WHEN s % 3 <> 1 THEN z / 75.0 END AS pr_auc, CASE WHEN s % 3 <> 1 THEN z / 250.0 END AS brier,
  CASE WHEN s % 3 = 1 THEN z / 2.0 END AS rmse, CASE WHEN s % 3 = 1 THEN z / 3.0 END AS mae, CAST(DATE '2001-08-01' AS @time) AS created_at
FROM (SELECT CAST(p_size AS DOUBLE) AS z, p_partkey % 10 + 1 AS s, CAST(FLOOR(p_partkey / 10) AS BIGINT) % 120 AS d FROM {part} WHERE p_partkey <= 1200) x""",
}
INPUTS = {"ops_pipeline_runs": "events", "ml_training_dataset_snapshots": "nation", "ml_model_registry": "supplier", "ml_model_stage_history": "customer", "ml_model_validation_metrics_daily": "part"}


def ops_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = INPUTS[name]
    return spark.sql(_sql(SQL[name]).replace("@time", "TIMESTAMP_NTZ"), **{source: spark.read.parquet(f"{sf_dir}/{source}.parquet")})


def plain_sql(name: str) -> str:
    """The same for an engine where the inputs are views of their names."""
    return _sql(SQL[name]).replace("@time", "TIMESTAMP").replace("{" + INPUTS[name] + "}", INPUTS[name])
