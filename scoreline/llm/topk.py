"""Exact top-k inner-product search: a ball tree per shard, searched by branch and bound.

A node's bound for a query q is q . centre + |q| * radius. Each query descends from the root, best bound first: an
inner node gives way to its two children, a leaf is scored, and a node whose bound falls below the query's current
k-th score is cut with all that is under it. That score is shared: it travels with the query from one round of
shards to the next. A tree is built once, stored, and met by blocks of queries.

Components too large for exact products in doubles make a row wide; wide rows and queries are scored apart, in
integers of any size.

Defined cases: vectors that are null, or hold null or non-finite components, and rows without an id take no part;
rows of one id are rows of their own, each a candidate of the others; only vectors of the query's dimension are
compared; a query gets all there is if that is fewer than k; equal scores go to the smaller id; a score beyond 64
bits is ranked by its true value and shown as the nearest long; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Workspace, arrow_map, table

LEAF = 64
SHARD = 16_384
QUERIES = 16_384
LEAST_SHARDS = 64
#: Below every score and bound; half of it still is.
NONE = -1e300


def quantise(rows: DataFrame, scale: float = 64.0) -> DataFrame:
    """(rid, vec_id, dim, wide, v): v is floor(scale * x) of each component, as doubles, in one binary. A wide row, one
    whose products could leave the exact range of doubles, has its components as they were."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rid, ids, dim, wide, out = [], [], [], [], []
        for r, i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if i is None or not v.is_valid or (x := v.values).null_count:
                continue
            x = x.to_numpy(zero_copy_only=False).astype("<f8")
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                q = np.floor(x * scale)
            rid.append(r)
            ids.append(i)
            dim.append(len(x))
            wide.append(bool(np.abs(q).max(initial=0) > math.sqrt(2.0**52 / max(1, len(x)))))
            out.append((x if wide[-1] else q).tobytes())
        made = [pa.array(rid, pa.int64()), pa.array(ids, pa.int64()), pa.array(dim, pa.int32()), pa.array(wide, pa.bool_()), pa.array(out, pa.binary())]
        yield pa.record_batch(made, ["rid", "vec_id", "dim", "wide", "v"])

    named = rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return arrow_map(named, run, "rid long, vec_id long, dim int, wide boolean, v binary")


def build(rid: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(rid, ids, x, lo, hi, left, centre, radius): a node holds the rows from lo to hi; its children are ``left`` and
    the next, or left is -1. Nodes are halved at the median of their widest coordinate down to ``LEAF`` rows. Of
    equal vectors only the ``k + 1`` of smallest ids are kept: no query can return more of them."""
    order = np.lexsort((rid, ids, *x.T[::-1]))
    rid, ids, x = rid[order], ids[order], x[order]
    new = np.r_[True, (x[1:] != x[:-1]).any(1)]
    first = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
    keep = np.arange(len(x)) - first <= k
    rid, ids, x = rid[keep], ids[keep], x[keep]
    at, nodes, left, centre, radius = np.arange(len(x)), [(0, len(x))], [], [], []
    for lo, hi in nodes:  # grows
        part = x[at[lo:hi]]
        centre.append(part.mean(0))
        radius.append(math.sqrt(((part - centre[-1]) ** 2).sum(1).max()))
        spread = np.ptp(part, axis=0) if part.shape[1] else np.zeros(1)
        if hi - lo <= LEAF or not spread.max():
            left.append(-1)
            continue
        half = (hi - lo) // 2
        at[lo:hi] = at[lo:hi][np.argpartition(part[:, spread.argmax()], half)]
        left.append(len(nodes))
        nodes += [(lo, lo + half), (lo + half, hi)]
    lo, hi = np.array(nodes).T
    small = np.abs(x).max(initial=0) < 2**31
    return rid[at], ids[at], x[at].astype(np.int32) if small else x[at], lo, hi, np.array(left), np.array(centre), np.array(radius)


class BallTree:
    def __init__(self, arrays: tuple[np.ndarray, ...]):
        self.rid, self.ids, x, self.lo, self.hi, self.left, self.centre, self.radius = arrays
        self.x = x.astype(np.float64)
        self.far = np.sqrt((self.centre**2).sum(1)) + self.radius
        self.visited = 0

    def _bound(self, q: np.ndarray, norm: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Never below the true bound: what rounding can lose is added."""
        return np.einsum("ij,ij->i", q, self.centre[node]) + norm * (self.radius[node] + 1e-9 * self.far[node]) + 1

    def search(self, rid: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of each query's best k rows here, or -1, and their scores; scores below ``floor`` may be left out.

        All queries take a step at once. Until each has k scores a step takes its one best open node, after that
        the best 2, 4, ..., none of them below the query's k-th score."""
        n, norm = len(q), np.sqrt((q**2).sum(1))
        open_ = np.full((n, len(self.lo)), NONE)
        open_[:, 0] = self._bound(q, norm, np.zeros(n, np.int64))
        at, score = np.full((n, k), -1), np.full((n, k), NONE)
        kth, step = floor.copy(), 1
        while True:
            if step == 1:
                top = open_.argmax(1)[:, None]
            else:
                top = np.argpartition(-open_, min(step, open_.shape[1]) - 1, axis=1)[:, :step]
            who, col = np.nonzero(np.take_along_axis(open_, top, 1) >= np.maximum(kth, NONE / 2)[:, None])
            if not len(who):
                return at, score
            node = top[who, col]
            self.visited += len(who)
            open_[who, node] = NONE
            inner = self.left[node] >= 0
            w, child = who[inner], self.left[node[inner]]
            for c in (child, child + 1):
                open_[w, c] = self._bound(q[w], norm[w], c)
            w, leaf = who[~inner], node[~inner]
            by = np.argsort(leaf, kind="stable")
            for group in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
                if len(group):
                    self._score(leaf[group[0]], w[group], rid, q, at, score, kth, k)
            kth = np.maximum(floor, score[:, -1])
            step = step * 2 if (score[:, -1] > NONE).all() or not inner.any() else step

    def _score(self, leaf, mine, rid, q, at, score, kth, k) -> None:
        rows = np.arange(self.lo[leaf], self.hi[leaf])
        s = q[mine] @ self.x[rows].T
        s[self.rid[rows][None, :] == rid[mine][:, None]] = NONE
        better = (s >= np.maximum(kth[mine], NONE / 2)[:, None]).any(1)
        mine, s = mine[better], s[better]
        if len(mine):
            all_at = np.concatenate([at[mine], np.broadcast_to(rows, s.shape)], 1)
            all_s = np.concatenate([score[mine], s], 1)
            top = np.lexsort((self.rid[all_at], self.ids[all_at], -all_s), axis=1)[:, :k]
            at[mine], score[mine] = np.take_along_axis(all_at, top, 1), np.take_along_axis(all_s, top, 1)


def _matrix(v: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(v), "<f8").reshape(len(v), dim)


FOUND = "qrid long, query_id long, rid long, vec_id long, score long, beyond binary"
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _beyond(score: int) -> bytes | None:
    """Puts scores that are shown as the least or the greatest long in order."""
    if LOW < score < HIGH:
        return None
    size = abs(score).to_bytes(1024, "big")
    return size if score > 0 else bytes(255 - b for b in size)


def _integers(v: bytes, wide: bool) -> list[int]:
    x = np.frombuffer(v, "<f8").tolist()
    return [math.floor(64 * c) if abs(c) < 2.0**46 else int(c) * 64 for c in x] if wide else list(map(int, x))


def _exact(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k of each query among the rows of its dimension, in integers of any size."""
    out = []
    c = [(int(r.rid), int(r.vec_id), r.dim, _integers(r.v, r.wide)) for r in rows.itertuples()]
    for q in queries.itertuples():
        v = _integers(q.q, q.qwide)
        got = [(-sum(map(int.__mul__, v, x)), i, r) for r, i, dim, x in c if dim == q.qdim and r != q.qrid]
        out += [(q.qrid, q.qid, r, i, max(LOW, min(HIGH, -s)), _beyond(-s)) for s, i, r in sorted(got)[:k]]
    return pd.DataFrame(out, columns=["qrid", "query_id", "rid", "vec_id", "score", "beyond"])


def search(rows: DataFrame, is_query, k: int = 20, work: Workspace | None = None) -> DataFrame:
    """The k best other rows of every row for which ``is_query`` holds, ranks from 1.

    Scale: rows are cut into shards of about ``SHARD`` by a hash, and each shard's tree is built once and stored.
    Queries meet a tree in blocks of about ``QUERIES``, so that a task holds one of each, whatever the sizes of the
    tables. Round one looks into one shard per query, round two into about the square root of their number, round
    three into the rest, each round starting from the k-th score so far; a round returns at most k rows per query
    and shard.
    """
    spark = rows.sparkSession
    work = work or Workspace(spark, "topk")
    x = work.put(quantise(rows))
    wide, asked = F.count(F.when(F.col("wide"), 1)), F.count(F.when(is_query, 1))
    n, n_wide, n_queries = x.agg(F.count("*"), wide, asked).first()
    shards = max(math.ceil(n / SHARD), min(LEAST_SHARDS, math.ceil(n / LEAF)), 1)
    groups = max(1, math.ceil(n_queries / QUERIES))
    h = F.xxhash64("rid")
    placed = x.withColumn("shard", F.pmod(h, F.lit(shards)))
    g = F.pmod(F.shiftright(h, 20), F.lit(groups)).cast("int").alias("qg")
    queries = placed.filter(is_query).select(F.col("rid").alias("qrid"), F.col("vec_id").alias("qid"), F.col("dim").alias("qdim"), F.col("v").alias("q"), F.col("wide").alias("qwide"), F.col("shard").alias("home"), g)

    def plant(part: pd.DataFrame) -> pd.DataFrame:
        arrays = build(part.rid.to_numpy(), part.vec_id.to_numpy(), _matrix(part.v, part.dim.iloc[0]), k)
        return pd.DataFrame({"shard": part.shard.iloc[:1], "dim": part.dim.iloc[:1], "tree": [pickle.dumps(arrays)]})

    blocks = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")
    trees = work.put(placed.filter("not wide").groupBy("shard", "dim").applyInPandas(plant, "shard long, dim int, tree binary"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for t in left.itertuples():
            tree, q = BallTree(pickle.loads(t.tree)), right[right.qdim == t.dim]
            for lo in range(0, len(q), 256):
                b = q.iloc[lo : lo + 256]
                floor = b.kth.to_numpy(np.float64, na_value=NONE)
                at, score = tree.search(b.qrid.to_numpy(), _matrix(b.q, t.dim), floor, k)
                ok = (at >= 0) & (score > NONE / 2) & (score >= floor[:, None])
                r, _ = np.nonzero(ok)
                out.append(pd.DataFrame({"qrid": b.qrid.to_numpy()[r], "query_id": b.qid.to_numpy()[r], "rid": tree.rid[at[ok]], "vec_id": tree.ids[at[ok]], "score": score[ok].astype(np.int64), "beyond": None}))
        return pd.concat(out) if out else _exact(left[:0], right[:0], k)

    def best(got: DataFrame) -> DataFrame:
        order = "order by score desc, coalesce(beyond, x'') desc, vec_id, rid"
        ranked = got.selectExpr("*", f"cast(row_number() over (partition by qrid {order}) as int) as rank")
        return work.put(ranked.filter(F.col("rank") <= k))

    cols = [c.split()[0] for c in FOUND.split(", ")]
    found, mid = None, math.ceil(math.sqrt(shards))
    narrow = queries.filter("not qwide")
    for lo, hi in ((0, 1), (1, 1 + mid), (1 + mid, shards)):
        if lo >= min(hi, shards):
            continue
        now = narrow.withColumn("kth", F.lit(None).cast("double"))
        if found is not None:
            now = narrow.join(found.filter(F.col("rank") == k).select("qrid", F.col("score").cast("double").alias("kth")), "qrid", "left")
        step = F.explode(F.sequence(F.lit(lo), F.lit(min(hi, shards) - 1)))
        sent = now.withColumn("i", step).select("qrid", "qid", "qdim", "q", "kth", F.pmod(F.col("home") + F.col("i"), F.lit(shards)).alias("qshard"), "qg")
        got = trees.select("*", blocks).groupBy("shard", "g").cogroup(sent.groupBy("qshard", "qg")).applyInPandas(run, FOUND)
        last, found = found, best(got.union(found.select(*cols)) if found is not None else got)
        work.drop(last)
    if n_wide:

        def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return _exact(left, right, k)

        every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("qshard")
        for some, those in ((placed, queries.filter("qwide")), (placed.filter("wide"), narrow)):
            asked = those.select("*", every).groupBy("qshard", "qg")
            got = some.select("*", blocks).groupBy("shard", "g").cogroup(asked).applyInPandas(scan, FOUND)
            last, found = found, best(found.select(*cols).union(got))
            work.drop(last)
    work.drop(x, trees)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


SQL = {
    "op2_topk": """
with x as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda c: cast(floor(64 * cast(c as double)) as bigint)) as v from embeddings
           where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (select q.rid as qrid, c.rid, q.vec_id as query_id, c.vec_id as vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
      from x q join x c on q.rid <> c.rid and len(q.v) = len(c.v) where q.vec_id % 20 = 0),
r as (select query_id, cast(row_number() over (partition by qrid order by score desc, vec_id, rid) as integer) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 20""",
}
