"""Rolling frames over keys of very many rows: each key's line is cut into chunks that are worked on side by side.

A chunk holds its own rows and a halo, the last rows before it, so that every frame of up to ``halo`` preceding rows
is whole; how many rows lie before a chunk is known from the chunks' counts. Cuts come from a hashed sample of each
key's rows, by the full order, so that rows of one time are cut too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .core import checked_broadcast

#: Rows of one key that make one chunk, about.
CHUNK = 1_000_000
#: Rows of the sample for each chunk.
POINTS = 32


def hot_keys(rows: DataFrame, key: str, most: int = CHUNK) -> DataFrame | None:
    """Keys of more than ``most`` rows, so at most one for each ``most`` rows of the table; None if there are none."""
    found = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(key).collect()
    return rows.sparkSession.createDataFrame([(r[0],) for r in found], f"`{key}` {rows.schema[key].dataType.simpleString()}") if found else None


def split_off(rows: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all other keys, null among them, and rows of these."""
    few = checked_broadcast(hot)
    return rows.join(few, key, "left_anti"), rows.join(few, key, "left_semi")


def in_chunks(rows: DataFrame, key: str, order: list[str], halo: int, chunk: int = CHUNK) -> DataFrame:
    """The rows with ``_chunk``, their chunk, ``_before``, the number of the key's rows before that chunk, and
    ``_halo``: true for copies of the last ``halo`` rows before it, which only complete its frames.

    ``order`` tells any two rows of a key apart. What moves is keys and order twice, to count chunks and find their last
    rows; the rows themselves stay where they lie for the frames' own shuffle, ``halo`` rows of each chunk twice, if what is
    known of the keys can be broadcast, and move once by key if not.
    """
    place = F.struct(*order)
    step = max(1, chunk // POINTS)
    narrow = rows.select(key, *order)
    points = narrow.filter(F.pmod(F.xxhash64(key, *order), F.lit(step)) == 0).groupBy(key).agg(F.array_sort(F.collect_list(place)).alias("_points"))
    every = F.filter("_points", lambda p, i: (i + 1) % POINTS == 0)
    cuts = checked_broadcast(points.select(key, every.alias("_cuts")))
    number = F.coalesce(F.size(F.filter("_cuts", lambda c: c < place)), F.lit(0))
    # of each chunk its size and its last rows, in keys and order alone
    cut = narrow.join(cuts, key, "left").withColumn("_chunk", number).drop("_cuts")
    back = Window.partitionBy(key, "_chunk").orderBy(*[F.desc(c) for c in order])
    sizes = cut.groupBy(key, "_chunk").agg(F.count("*").alias("_size"))
    tails = cut.withColumn("_back", F.row_number().over(back)).filter(F.col("_back") <= halo).groupBy(key, "_chunk").agg(F.array_sort(F.collect_list(place)).alias("_last"))
    chunks = sizes.join(tails, [key, "_chunk"]).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_chunk", "_size", "_last"))).alias("_all"))
    # for each chunk the rows before it, and the first row of its halo: the last ``halo`` chunks before it hold them all
    so_far = lambda i: F.aggregate(F.slice("_all", F.lit(1), i), F.lit(0).cast("long"), lambda n, c: n + c["_size"])
    ends = lambda i: F.flatten(F.transform(F.slice("_all", F.greatest(i - halo + 1, F.lit(1)), F.least(i, F.lit(halo))), lambda c: c["_last"]))
    first = lambda e: F.get(e, F.greatest(F.size(e) - halo, F.lit(0)))
    starts = F.transform("_all", lambda c, i: F.struct(c["_chunk"].alias("_chunk"), so_far(i).alias("_before"), first(ends(i)).alias("_from")))
    known = checked_broadcast(chunks.select(key, starts.alias("_starts")).join(cuts, key, "left"))
    # a row goes to its own chunk, and to the later ones whose halo begins at it or before it
    mine = rows.join(known, key).withColumn("_own", number)
    into = F.filter("_starts", lambda s: (s["_chunk"] == F.col("_own")) | ((s["_chunk"] > F.col("_own")) & (s["_from"] <= place)))
    dealt = mine.withColumn("_into", F.explode(into)).withColumns({"_chunk": F.col("_into._chunk"), "_before": F.col("_into._before")})
    return dealt.withColumn("_halo", F.col("_chunk") != F.col("_own")).drop("_starts", "_cuts", "_own", "_into")
