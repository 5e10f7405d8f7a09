"""Session settings: those of the launcher where there is one, settings for one machine otherwise."""

from __future__ import annotations

import os

from pyspark import SparkContext
from pyspark.sql import SparkSession


def launched() -> bool:
    """Whether spark-submit, a shell or a running session has chosen master, memory and partitions already."""
    return "PYSPARK_GATEWAY_PORT" in os.environ or SparkContext._active_spark_context is not None


def build_session(app: str = "scoreline", cores: int | str = "*", memory: str = "8g", shuffle: int | None = None) -> SparkSession:
    """``cores``, ``memory`` and ``shuffle`` hold only if nothing has launched this process for a cluster."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if not launched():
        b = b.master(f"local[{cores}]").config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.scheduler.mode", "FAIR")
        if shuffle:
            b = b.config("spark.sql.shuffle.partitions", str(shuffle))
    return b.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Adds the folder of this package to the path of Python workers, for sessions whose workers start elsewhere."""
    env, home = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = env.get("PYTHONPATH", "").split(os.pathsep)
    if home not in path and home not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [*path, home]))
