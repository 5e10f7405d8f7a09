"""Helpers that most tables use: rounding, ratios, latest row per key, refresh bounds."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rnd(x: Column | str, n: int) -> Column:
    """Rounds half away from zero. Values within 1e-7 units of the tie count as the tie, so that the order in
    which an engine summed up doubles does not show in the last digit."""
    x, p = (F.col(x) if isinstance(x, str) else x).cast("double"), F.lit(10.0**n)
    return F.signum(x) * F.floor(F.abs(x) * p + F.lit(0.5000001)).cast("double") / p + F.lit(0.0)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double; null where b is zero or null."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def share(cond: Column) -> Column:
    """Part of the rows for which cond holds."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def times(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order. Catalyst limits each task to one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def refresh_bound(df: DataFrame, col: str, days: int) -> datetime.date:
    """First day of the trailing window: the largest date less ``days``; 1970-01-01 without any. One small action,
    so that the bound becomes a literal that is pushed into scans."""
    top = df.agg(F.max(col)).first()[0]
    return top - datetime.timedelta(days=days) if top else datetime.date(1970, 1, 1)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def checked_broadcast(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A broadcast hint if a bounded count shows at most ``most`` rows; else the frame as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def won(team: str = "team", red: str = "redscore", blue: str = "bluescore") -> Column:
    """1 for the side with the higher score; 0 for a tie, an unknown score or an unknown side."""
    return F.when((F.col(team) == "Red") & (F.col(red) > F.col(blue)), 1).when((F.col(team) == "Blue") & (F.col(blue) > F.col(red)), 1).otherwise(0)
