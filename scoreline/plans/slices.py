"""Training rows of a whole source in slices, for tables whose shuffles together would outgrow the disks.

Every row moves by match, by day and by player, as in one plan, but a slice at a time: between moves rows lie in files, and a
slice's files and shuffles go when the next step has it. A slice holds whole matches, days or players, so it gives the rows that
it would give in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import mlops
from . import layout
from .runner import tidy_shuffles
from .store import TableStore, work_folder
from .tables import Tables

#: Line items that one slice is meant to hold, and the most slices: each reads the source anew.
ROWS_PER_SLICE, MOST_SLICES = 500_000, 8
STREAMS = ("logs", "summaries", "messages")


def slices_for(rows: int) -> int:
    return min(MOST_SLICES, max(1, -(-rows // ROWS_PER_SLICE)))


def _slice(key: str, n: int, i: int) -> Column:
    return F.expr(f"{layout.bucket(n, key)} = {i}")


def training_rows(t: Tables, slices: int | None = None) -> DataFrame:
    """The snapshot of the newest match, written. Without ``slices`` the number of line items decides."""
    spark, store = t.spark, TableStore(t.spark, work_folder(t.spark))
    n = slices or slices_for(spark.read.parquet(f"{t.sf_dir}/lineitem.parquet").count())

    def used_up(name: str):
        """The table's parts, one after the other; each goes when it has been worked on. One empty frame if there is none."""
        for p in store.parts(name) or [""]:
            yield store.read(name, parts=lambda k: k == p)
            store.drop_parts(name, lambda k: k == p)

    with tidy_shuffles(spark):
        for i in range(n):
            some = Tables(spark, t.sf_dir, as_of=t.as_of, scorer=t.scorer)
            for name in STREAMS:
                some.replace(name, t[name].filter(_slice("logid", n, i)))
            game = some["logs_base"].select("logid", "redscore", "bluescore")
            rows = some["features_player_match"].drop("classes_played_csv").join(game, "logid", "left")
            store.append("by_day", rows, layout.bucket(n, "match_date"))
        cutoff = mlops.newest_match(store.read("by_day"))
        for rows in used_up("by_day"):
            store.append("by_player", rows.withColumn("label_impact_percentile", mlops.impact_percentile()), layout.bucket(n))
        for rows in used_up("by_player"):
            store.append("training_rows", mlops.training_rows(mlops.with_form(rows), cutoff, F.col("label_impact_percentile")))
    return store.read("training_rows")
