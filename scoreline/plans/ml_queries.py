"""Metric queries on the labels table: a deterministic score stands for a model."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import rnd
from ..ml import metrics

_SCORE = "cast((doc_id * 37) % 101 + toxic * 40 as double) / cast(141 as double)"
THRESHOLDS = [0.2, 0.35, 0.5, 0.65, 0.8]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rows.select(F.expr(f"cast({_SCORE} as double)").alias("p"), F.col("toxic").cast("int").alias("y"), F.col("quality").alias("segment"), (F.col("doc_id") % 5).alias("day"))


def _rounded(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[rnd(c, 9).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


def _run(spark: SparkSession, sf_dir: str, *, make) -> DataFrame:
    return _rounded(make(scored(spark, sf_dir)))


QUERIES = {
    "k14_binary_metrics": lambda s: metrics.binary_metrics(s, 0.5),
    "k15_regression_metrics": lambda s: metrics.regression_metrics(s),
    "k16_threshold_table": lambda s: metrics.threshold_table(s, THRESHOLDS),
    "k18_calibration_table": lambda s: metrics.calibration_table(s),
    "k19_calibration_error": lambda s: metrics.expected_calibration_error(s),
    "k20_segment_metrics": lambda s: metrics.binary_metrics(s, 0.5, ["segment"], 20),
    "k21_daily_metrics": lambda s: metrics.regression_metrics(s, ["day"]),
}


def queries():
    return {k: partial(_run, make=m) for k, m in QUERIES.items()}


def _sql() -> dict[str, str]:
    from .oracle import r, ratio

    score = _SCORE
    base = f"with s as (select cast({score} as double) as p, cast(toxic as integer) as y, quality as segment, doc_id % 5 as day from labels)"
    areas = """, st as (select {k} p, sum(y)::double as pos, count(*)::double as n from s group by {k} p), ru as (select *, sum(pos) over ({part} order by p desc) as tp, sum(n) over ({part} order by p desc) as al from st),
  ar as (select {k} case when sum(pos) > 0 and sum(n - pos) > 0 then sum((n - pos) * (tp - pos / 2)) / (sum(pos) * sum(n - pos)) end as roc_auc, case when sum(pos) > 0 and sum(n - pos) > 0 then sum(pos * tp / al) / sum(pos) end as pr_auc from ru {g})"""
    counts = "count(*) as rows_total, count(*) filter (p < 0.5 and y = 0)::double as true_negatives, count(*) filter (p >= 0.5 and y = 0)::double as false_positives, count(*) filter (p < 0.5 and y = 1)::double as false_negatives, count(*) filter (p >= 0.5 and y = 1)::double as true_positives"
    rates = f"{r('avg((p - y) * (p - y))', 9)} as brier, {r('avg(y)', 9)} as positive_rate, {r('avg(case when p >= 0.5 then 1 else 0 end)', 9)} as predicted_positive_rate"
    prf = f"{r('coalesce(' + ratio('true_positives', 'true_positives + false_positives') + ', 0)', 9)} as precision, {r('coalesce(' + ratio('true_positives', 'true_positives + false_negatives') + ', 0)', 9)} as recall, {r('coalesce(' + ratio('2 * true_positives', '2 * true_positives + false_positives + false_negatives') + ', 0)', 9)} as f1, {r('roc_auc', 9)} as roc_auc, {r('pr_auc', 9)} as pr_auc"
    reg = f"count(*) as rows_total, {r('sqrt(avg((p - y) * (p - y)))', 9)} as rmse, {r('avg(abs(p - y))', 9)} as mae"
    cal = "b as (select greatest(0, " + " + ".join(f"(case when p > {k / 10} then 1 else 0 end)" for k in range(1, 10)) + ") as bin, p, y from s), ca as (select bin, count(*) as rows, avg(p) as ap, avg(y) as ao, min(p) as mi, max(p) as ma from b group by bin)"
    th = " union all ".join(f"select {t}::double as threshold, coalesce(sum(y) filter (p >= {t}), 0) as tp, count(*) filter (p >= {t}) as hit, sum(y) as pos, count(*) as n from s" for t in THRESHOLDS)
    return {
        "k14_binary_metrics": f"{base}{areas.format(k='', part='', g='')}, c as (select {counts}, {rates} from s) select c.*, {prf} from c, ar",
        "k15_regression_metrics": f"{base} select {reg} from s",
        "k16_threshold_table": f"{base} select {r('threshold', 9)} as threshold, {r('coalesce(' + ratio('tp', 'hit') + ', 0)', 9)} as precision, {r('coalesce(' + ratio('tp', 'pos') + ', 0)', 9)} as recall, {r('coalesce(' + ratio('2 * tp', 'hit + pos') + ', 0)', 9)} as f1, {r(ratio('hit', 'n'), 9)} as predicted_positive_rate from ({th}) x",
        "k18_calibration_table": f"{base}, {cal} select cast(bin as integer) as bin, rows, {r('ap', 9)} as avg_predicted, {r('ao', 9)} as avg_observed, {r('mi', 9)} as min_prob, {r('ma', 9)} as max_prob from ca",
        "k19_calibration_error": f"{base}, {cal} select {r('sum(rows * abs(ap - ao)) / sum(rows)', 9)} as ece from ca",
        "k20_segment_metrics": f"{base}{areas.format(k='segment,', part='partition by segment', g='group by segment')}, c as (select segment, {counts}, {rates} from s group by segment having count(*) >= 20) select c.*, {prf} from c join ar on c.segment is not distinct from ar.segment",
        "k21_daily_metrics": f"{base} select day, {reg} from s group by day",
    }


SQL = _sql()
