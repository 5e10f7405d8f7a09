"""Model metrics as aggregates: (y, p) rows in, one row of figures out, for all rows or per segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import ratio


def _or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


#: Ranges of scores, of about as many distinct ones each, that are ranked apart.
RANGES = 256


def ranking_areas(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """roc_auc and pr_auc (average precision) per group; null with one class only.

    Equal scores are one step: rows are first summed up per distinct score. Steps are cut into ranges of scores at
    approximate quantiles; what lies above a range comes from sums of ranges, and only steps of one range are
    sorted together, so that no task sorts all scores."""
    keys = by or []
    steps = scored.groupBy(*keys, p).agg(F.sum(y).cast("double").alias("_pos"), F.count("*").cast("double").alias("_n"))
    edges = steps.agg(F.percentile_approx(p, F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)]), F.lit(10 * RANGES)).alias("_edges"))
    placed = steps.crossJoin(F.broadcast(edges)).withColumn("_range", F.expr(f"aggregate(_edges, 0, (n, e) -> n + int(e < {p}))")).drop("_edges")
    above = Window.partitionBy(*keys).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(*keys, "_range").agg(F.sum("_pos").alias("_rp"), F.sum("_n").alias("_rn"))
    before = {c: F.coalesce(F.sum(v).over(above), F.lit(0.0)) for c, v in (("_bp", "_rp"), ("_bn", "_rn"))}
    ranges = ranges.withColumns(before).drop("_rp", "_rn")
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, "_range")]
    met = placed.alias("s").join(ranges.alias("r"), on).select("s.*", "r._bp", "r._bn")
    down = Window.partitionBy(*keys, "_range").orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    run = met.withColumns({"_tp": F.col("_bp") + F.sum("_pos").over(down), "_all": F.col("_bn") + F.sum("_n").over(down)})
    neg = F.col("_n") - F.col("_pos")
    agg = run.groupBy(*keys).agg(
        F.sum("_pos").alias("_p"),
        F.sum(neg).alias("_m"),
        F.sum(neg * (F.col("_tp") - F.col("_pos") / 2)).alias("_above"),
        F.sum(F.col("_pos") * F.col("_tp") / F.col("_all")).alias("_ap"),
    )
    both = (F.col("_p") > 0) & (F.col("_m") > 0)
    return agg.select(*keys, F.when(both, F.col("_above") / (F.col("_p") * F.col("_m"))).alias("roc_auc"), F.when(both, F.col("_ap") / F.col("_p")).alias("pr_auc"))


def binary_metrics(scored: DataFrame, threshold: float = 0.5, by: list[str] | None = None, min_rows: int = 0, y: str = "y", p: str = "p") -> DataFrame:
    """Confusion counts, precision, recall and F1 (0 where undefined), Brier score, rates and areas."""
    keys = by or []
    hit = (F.col(p) >= threshold).cast("int")
    yes = F.col(y)
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")
    counts = scored.groupBy(*keys).agg(
        F.count("*").alias("rows_total"),
        n((1 - hit) * (1 - yes)).alias("true_negatives"),
        n(hit * (1 - yes)).alias("false_positives"),
        n((1 - hit) * yes).alias("false_negatives"),
        n(hit * yes).alias("true_positives"),
        F.avg(F.pow(F.col(p) - yes, F.lit(2.0))).alias("brier"),
        F.avg(yes).alias("positive_rate"),
        F.avg(hit).alias("predicted_positive_rate"),
    )
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    got = counts.filter(F.col("rows_total") >= min_rows).withColumns({"precision": _or_zero(tp, tp + fp), "recall": _or_zero(tp, tp + fn), "f1": _or_zero(2 * tp, 2 * tp + fp + fn)})
    areas = ranking_areas(scored, by, y, p)
    if not keys:
        return got.crossJoin(areas)
    for k in keys:
        areas = areas.withColumnRenamed(k, f"_r_{k}")
    on = [got[k].eqNullSafe(areas[f"_r_{k}"]) for k in keys]
    return got.join(areas, on, "left").drop(*[f"_r_{k}" for k in keys])


def regression_metrics(scored: DataFrame, by: list[str] | None = None, min_rows: int = 0, y: str = "y", p: str = "p") -> DataFrame:
    gap = F.col(p) - F.col(y)
    got = scored.groupBy(*(by or [])).agg(F.count("*").alias("rows_total"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))
    return got.filter(F.col("rows_total") >= min_rows)


def threshold_table(scored: DataFrame, thresholds: list[float], y: str = "y", p: str = "p") -> DataFrame:
    """Precision, recall and F1 at each threshold, from one pass over the scores."""
    yes = F.col(y)
    sums = [F.sum("y").alias("_p"), F.count("*").alias("_n")]
    sums += [F.struct(F.sum(F.when(F.col("p") >= t, F.col("y")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("p") >= t, 1).otherwise(0)).alias("hit")).alias(f"t{i}") for i, t in enumerate(thresholds)]
    one = scored.select(yes.alias("y"), F.col(p).alias("p")).agg(*sums)
    rows = one.select("_p", "_n", F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}.tp").alias("tp"), F.col(f"t{i}.hit").alias("hit")) for i, t in enumerate(thresholds)])).alias("x"))
    tp, hit, pos = F.col("x.tp"), F.col("x.hit"), F.col("_p")
    return rows.select("x.threshold", _or_zero(tp, hit).alias("precision"), _or_zero(tp, pos).alias("recall"), _or_zero(2 * tp, hit + pos).alias("f1"), ratio(hit, F.col("_n")).alias("predicted_positive_rate"))


def choose_threshold(table: DataFrame, min_precision: float, min_recall: float):
    """The row of best F1, then precision, then recall, among those that meet both minima, else among all."""
    ok = (F.col("precision") >= min_precision) & (F.col("recall") >= min_recall)
    return table.withColumn("selected_by_constraints", ok).orderBy(F.desc("selected_by_constraints"), F.desc("f1"), F.desc("precision"), F.desc("recall"), "threshold").first()


def _bin(p: str, bins: int) -> Column:
    """Equal bins, closed on the right, the first one on both sides."""
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(p)))
    edges = [k / bins for k in range(1, bins)]
    b = F.lit(0)
    for e in edges:
        b = b + (x > F.lit(e)).cast("int")
    return b


def calibration_table(scored: DataFrame, bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    return scored.groupBy(_bin(p, bins).alias("bin")).agg(F.count("*").alias("rows"), F.avg(p).alias("avg_predicted"), F.avg(y).alias("avg_observed"), F.min(p).alias("min_prob"), F.max(p).alias("max_prob")).orderBy("bin")


def expected_calibration_error(scored: DataFrame, bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    t = calibration_table(scored, bins, y, p)
    return t.agg((F.sum(F.col("rows") * F.abs(F.col("avg_predicted") - F.col("avg_observed"))) / F.sum("rows")).alias("ece"))


def daily_metrics(scored: DataFrame, model: str, version: str, snapshot: str, task: str, threshold: float = 0.5) -> DataFrame:
    """Rows of the validation metrics table, one for each day of the scored rows."""
    names = {"model_name": model, "model_version": version, "task_type": task, "snapshot_id": snapshot}
    if task == "classification":
        m = binary_metrics(scored, threshold, ["match_date"]).withColumnRenamed("positive_rate", "observed_positive_rate")
    else:
        m = regression_metrics(scored, ["match_date"])
    return m.withColumns({k: F.lit(v) for k, v in names.items()}).withColumnRenamed("match_date", "progress_date")
