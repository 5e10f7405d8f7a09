"""Table contracts: every published table's columns and types, as DDL strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOGS = "recordid string, logid bigint, title string, map string, sourcedateepochseconds bigint, sourcedateiso string, sourceplayercount bigint, sourceviewcount bigint, durationseconds bigint, redscore bigint, bluescore bigint, uploadersteamid string, payloadschemaversion bigint, ingestedat string, __ingest_ts timestamp"
MESSAGES = "recordid string, logid bigint, title string, map string, sourcedateepochseconds bigint, sourcedateiso string, messageindex bigint, steamid string, playername string, message string, messagelower string, ingestedat string, __ingest_ts timestamp"
SUMMARIES = "recordid string, logid bigint, title string, map string, sourcedateepochseconds bigint, sourcedateiso string, steamid string, team string, kills bigint, assists bigint, deaths bigint, damagedealt bigint, damagetaken bigint, healingdone bigint, ubersused bigint, classesplayedcsv string, ingestedat string, __ingest_ts timestamp"

PIPELINE_RUNS = "run_id string, run_mode string, step_name string, status string, started_at timestamp, finished_at timestamp, duration_seconds double, row_count bigint, error_text string, created_at timestamp"
MODEL_REGISTRY = "model_name string, model_version string, task_type string, stage string, snapshot_id string, training_code_version string, feature_sql_version string, artifact_uri string, metrics_json string, calibration_notes string, created_at timestamp, promoted_at timestamp, is_active boolean"
STAGE_HISTORY = "model_name string, model_version string, from_stage string, to_stage string, changed_by string, change_reason string, changed_at timestamp"
SNAPSHOTS = "snapshot_id string, snapshot_cutoff_time timestamp, snapshot_cutoff_date date, source_match_rows bigint, source_recent_form_rows bigint, training_rows bigint, created_at timestamp"
VALIDATION_METRICS = "model_name string, model_version string, task_type string, snapshot_id string, progress_date date, rows_total bigint, observed_positive_rate double, predicted_positive_rate double, precision double, recall double, f1 double, roc_auc double, pr_auc double, brier double, rmse double, mae double, created_at timestamp"

BY_NAME = {
    "logs": LOGS,
    "messages": MESSAGES,
    "summaries": SUMMARIES,
    "ops_pipeline_runs": PIPELINE_RUNS,
    "ml_model_registry": MODEL_REGISTRY,
    "ml_model_stage_history": STAGE_HISTORY,
    "ml_training_dataset_snapshots": SNAPSHOTS,
    "ml_model_validation_metrics_daily": VALIDATION_METRICS,
}


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a contract, in order, cast to its types; columns that are missing are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])
