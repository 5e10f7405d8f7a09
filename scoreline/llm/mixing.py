"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact size. Each source takes whole passes over its documents while its target
allows, then spends what remains of the target: a bulk share in proportion over all sizes, and the last words
by a bounded-knapsack dynamic program over the size counts. The program says how many documents of each size
to take; which ones is decided by a seeded hash.

Defined cases: a null or empty text has size 0 and takes 0; a text of any length is counted whole; a null source
is a source of its own, after all others; rows equal in doc_id and text are documents of their own; documents of
one size are taken in the order of a seeded hash, then of doc_id; an empty table gives no rows; a source without
words has target 0; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import KEY, WORD, Workspace, boxed, row_key, table, unboxed

#: Words that the dynamic program fits; more than that is taken in proportion first.
WINDOW = 1 << 16
#: Up to so many sources their plan, a row each, is broadcast; beyond that it is joined by source.
MANY_SOURCES = 10_000
#: Rows that one rank bucket holds on average.
BUCKET = 256


def targets(sizes: list[int], weights: list[float], limit: float = 3.0) -> list[float]:
    """Shares of the sum of sizes by weight, none above ``limit`` times its own size; the excess is reshared."""
    out, left, open_ = [0.0] * len(sizes), float(sum(sizes)), [i for i, w in enumerate(weights) if w > 0]
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w > limit * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = limit * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum up to ``budget``, or as near below it as
    the dynamic program reaches.

    All but the last ``window`` words are spread over the sizes in proportion to their counts. Then a bit set of
    reachable sums, one big integer, is shifted by multiples of each size (counts split into powers of two) until
    the budget is reached; the steps are walked back to counts.
    """
    order = np.argsort(-sizes, kind="stable")
    take = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if total <= budget:
        return counts.astype(np.int64)
    if (bulk := budget - window) > 0:
        share, carry = bulk / total, 0.0
        for i in order:
            carry += share * float(counts[i]) * float(sizes[i])
            take[i] = min(int(counts[i]), max(0, int(carry // sizes[i])))
            carry -= float(take[i] * sizes[i])
    left = budget - int((take * sizes).sum())
    mask, reach, steps = (1 << (left + 1)) - 1, 1, []
    for i in order:
        n, part = min(int(counts[i] - take[i]), left // int(sizes[i])), 1
        while n > 0 and not reach >> left & 1:
            m = min(part, n)
            new = reach | (reach << (m * int(sizes[i]))) & mask
            if new != reach:
                steps.append((i, m, reach))
                reach = new
            n, part = n - m, part * 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, m, before in reversed(steps):
        if not before >> at & 1:
            at -= m * int(sizes[i])
            take[i] += m
    return take


def numbered(sources: DataFrame, work: Workspace) -> DataFrame:
    """``sources`` with ``sid``, their place from 0 by code points, null last. Sorted in parallel; the driver holds one
    number for each sorted part."""
    placed = work.put(sources.orderBy(F.col("source").isNull(), "source").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    n = sorted(placed.groupBy(part.alias("p")).count().collect())
    before = dict(zip([p for p, _ in n], np.cumsum([0, *[c for _, c in n]]).tolist()))
    shift = F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair]) if before else F.lit(None)
    return placed.withColumn("sid", (shift[part] + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("_at") if before else placed.withColumn("sid", F.col("_at")).drop("_at")


def goals(sources: DataFrame, weights, limit: float) -> DataFrame:
    """``targets`` for a table of sources (sid, n), by rounds of sums: what is open shares what is left, and a source is
    full if its part of a share by weight is above its limit, which only becomes more as others fill up."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    known = sources.withColumn("w", w)
    full, seen = F.lit(False), -1
    while True:
        n, filled, left, open_ = known.agg(
            F.coalesce(F.sum("n"), F.lit(0)),
            F.count(F.when(full, 1)),
            F.coalesce(F.sum("n"), F.lit(0)) - limit * F.coalesce(F.sum(F.when(full, F.col("n"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)),
        ).first()
        share = F.lit(float(left)) * F.col("w") / F.lit(float(open_)) if open_ else F.lit(0.0)
        if filled == seen or not open_:
            return known.withColumn("target", F.when(full, limit * F.col("n")).otherwise(share).cast("double")).drop("w")
        full, seen = full | (share > limit * F.col("n")), filled


def ranked(rows: DataFrame, keys: list[str], n: str, h: str, order: list[str], count: str) -> DataFrame:
    """``before``: how many of a group's rows, ``count`` each, come before a row by (hash ``h``, ``order``). Groups of
    ``n`` are cut into ranges of the hash of about ``BUCKET`` rows that are ranked apart."""
    share = F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))
    cut = rows.withColumn("_b", F.floor(share * F.ceil(F.col(n) / BUCKET)))
    by = ", ".join(keys)
    sums = cut.groupBy(*keys, "_b").agg(F.sum(count).alias("_s"))
    earlier = sums.selectExpr(*keys, "_b", f"sum(_s) over (partition by {by} order by _b rows between unbounded preceding and current row) - _s as _e")
    within = f"sum({count}) over (partition by {by}, _b order by {h}, {', '.join(order)} rows between unbounded preceding and current row) - {count}"
    return cut.join(earlier, [*keys, "_b"]).selectExpr(*rows.columns, f"_e + {within} as before")


def planned(docs: DataFrame, weights=(5, 2, 1), limit: float = 3.0, seed: int = 7, work: Workspace | None = None) -> DataFrame:
    """Documents equal in doc_id and text as one row: doc_id, rk1, rk2, size, source_size, target, c (how many they are),
    passes, and chosen (how many of them are taken once more).

    ``weights`` repeat over the sources in code point order, null last.

    Scale: one pass over the texts leaves narrow rows, equal ones summed on the map side; size counts are one array
    per source, no longer than the distinct sizes; rows are ranked within hash buckets of about ``BUCKET`` rows, so
    that no source or size, however common, meets in one task.
    """
    work = work or Workspace(docs.sparkSession, "mixing")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    narrow = docs.select("doc_id", "source", size, F.xxhash64(F.lit(seed), "doc_id", "text").alias("u"), *row_key("doc_id", "text"))
    sized = work.put(narrow.groupBy("doc_id", "source", "size", "u", *KEY).agg(F.count("*").alias("c")))
    sources = numbered(sized.groupBy("source").agg(F.sum(F.col("size") * F.col("c")).alias("n")), work)
    goal = work.put(goals(sources, weights, limit))
    passes = F.when(F.col("n") > 0, F.least(F.lit(int(limit)), F.floor(F.col("target") / F.col("n")))).otherwise(0).cast("int")
    plan = goal.select("sid", F.col("source").alias("_source"), F.col("n").alias("source_size"), "target", passes.alias("passes"), F.rint(F.col("target") - passes * F.col("n")).cast("long").alias("left"))
    plan = F.broadcast(plan) if goal.count() <= MANY_SOURCES else plan
    known = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def pick(parts):
        for p in parts:
            for r in p.itertuples():
                s = np.array([x["size"] for x in r.sizes], np.int64)
                n = np.array([x["n"] for x in r.sizes], np.int64)
                o = np.argsort(s)
                s, n = s[o], n[o]
                yield pd.DataFrame({"sid": r.sid, "size": s, "n": n, "more": fit(s, n, int(r.left)) if r.left > 0 else np.zeros(len(s), np.int64)})

    counted = known.filter("size > 0").groupBy("sid", "left", "size").agg(F.sum("c").alias("n"))
    per = counted.groupBy("sid", "left").agg(F.collect_list(F.struct("size", "n")).alias("sizes"))
    quota = work.put(per.mapInPandas(pick, "sid long, size long, n long, more long"))
    asked = known.join(quota, ["sid", "size"], "left")
    out = ["doc_id", *KEY, "size", "source_size", "target", "c", "passes"]
    whole = asked.filter("more is null or more = 0 or more = n").select(*out, F.when(F.col("more") > 0, F.col("c")).otherwise(0).alias("chosen"))
    some = asked.filter("more > 0 and more < n").select(*out, "sid", "n", "u", "more")
    part = ranked(some, ["sid", "size"], "n", "u", ["doc_id", *KEY], "c").select(*out, F.greatest(F.lit(0), F.least("c", F.col("more") - F.col("before"))).alias("chosen"))
    return whole.union(part)


def mix(docs: DataFrame, weights=(5, 2, 1), limit: float = 3.0, seed: int = 7, work: Workspace | None = None) -> DataFrame:
    """A row for every row of ``docs`` (doc_id, text, source) with ``size``, ``source_size``, ``target`` and ``taken``,
    the words that the mix takes of it: 0 to ``limit`` times its size. Rows are not joined: of equal ones each is told
    apart by its number alone."""
    copies = F.expr("explode(sequence(0L, (c - 1) div 4096))").alias("_i")
    each = planned(docs, weights, limit, seed, work).select("*", copies).select("*", F.expr("explode(sequence(_i * 4096 + 1, least(c, (_i + 1) * 4096)))").alias("_k"))
    taken = F.col("size") * (F.col("passes") + F.when(F.col("_k") <= F.col("chosen"), 1).otherwise(0))
    return each.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: a document taken twice is there twice, one not taken is gone.

    Documents of no words go, as the mix takes none of their words. The mix itself runs on narrow rows; whole
    texts move once, to meet their counts. Of rows equal in doc_id and text that the mix takes in part, those of
    the smallest hashes of their place are taken once more.
    """
    work = Workspace(spark, "mixing")
    times = planned(docs, work=work).filter("size > 0 and (passes > 0 or chosen > 0)").select(*KEY, "c", "passes", "chosen")
    rows = docs.select(boxed(docs), *row_key("doc_id", "text"), F.monotonically_increasing_id().alias("rid"))
    met = rows.join(times.hint("shuffle_hash"), KEY)
    odd = "chosen > 0 and chosen < c"
    even = met.filter(f"not ({odd})").select("row", "rid", F.expr("passes + int(chosen > 0)").alias("t"))
    split = met.filter(odd).withColumn("_h", F.xxhash64("rid", *KEY)).withColumn("_o", F.lit(1))
    extra = ranked(split, KEY, "c", "_h", ["rid"], "_o").select("row", "rid", F.expr("passes + int(before < chosen)").alias("t"))
    # what repeats is rid, so that both halves need the same columns and share one shuffle of the rows
    return even.union(extra).withColumn("_i", F.explode(F.expr("array_repeat(rid, int(t))"))).select(*unboxed(docs))
