"""Centroid clustering by Sort-means, in whole numbers.

Each round every vector goes to its nearest centroid (ties: the smaller number), and every centroid that has vectors
becomes their floored mean. For each centroid the others are put in order of their distance from it. A vector's scan
starts at its centroid of the round before, at distance d, and goes through the others in that one's order; it stops
at the first that lies strictly beyond 2 d, as none from there on can be as near.

Components too large for exact products in doubles make a vector wide; wide vectors, and all vectors while a centroid
is wide, are measured in integers of any size.

Defined cases: vectors that are null, of another dimension, or hold null or non-finite components take no part; rows
without an id take part, but are starting centroids only if too few others are kept; rows of one id, and equal vectors,
are vectors of their own (of rows of one id, any may be the first starting centroids, but the same in each run); fewer vectors than centroids
make so many centroids; a centroid without vectors stays, its inertia is that of no row; distances and inertias beyond
64 bits are given as the greatest long; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from .base import Workspace, arrow_map, let_workers_import, table, vectors

DIM, K, ROUNDS, SEED = 64, 8, 10, "3"
HIGH = (1 << 63) - 1
#: Sums travel in digits of this many bits, so that Spark's decimals hold them whatever their size.
DIGIT = 60
VECTOR = "id long, at int, wide boolean, v binary"
SUMS = "array<struct<cluster:int,dim:int,digit:int,s:bigint>>"


def narrow(dim: int) -> int:
    """Components up to this are narrow: squared distances between them are exact in doubles."""
    return min((1 << 31) - 1, math.isqrt((1 << 51) // max(1, dim)))


def quantise(rows: DataFrame, dim: int = DIM, scale: float = 1024.0) -> DataFrame:
    """(id, at, wide, v): floor(scale * x) of the components of each kept vector, as 32-bit integers in one binary, or
    as decimals in text if they are wide; ``at`` is its cluster so far."""

    most = narrow(dim)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for places, x in vectors(batch.column(1)):
            if x.shape[1] != dim:
                continue
            with np.errstate(over="ignore"):
                q = np.floor(x * scale)
            wide = np.abs(q).max(1, initial=0) > most
            packed = np.where(wide[:, None], 0, q).astype("<i4")
            out = [",".join(str(_floor(c, scale)) for c in v.tolist()).encode() if w else p.tobytes() for v, p, w in zip(x, packed, wide.tolist())]
            cols = [batch.column(0).take(pa.array(places)), pa.array(np.zeros(len(x), np.int32)), pa.array(wide), pa.array(out, pa.binary())]
            yield pa.record_batch(cols, ["id", "at", "wide", "v"])

    return arrow_map(rows.select(F.col("vec_id").cast("long").alias("id"), "embedding"), run, VECTOR)


def _floor(x: float, scale: float) -> int:
    """floor(scale * x) where the product may exceed the doubles."""
    return math.floor(x * scale) if abs(x * scale) < math.inf else int(x) * int(scale)


def numbers(v: bytes, wide: bool) -> list[int]:
    return [int(c) for c in v.split(b",")] if wide else np.frombuffer(v, "<i4").tolist()


class SortMeans:
    """The centroids of one round, each with the others in order of their distance from it."""

    def __init__(self, centroids: list[list[int]]):
        self.c = centroids
        self.wide = any(abs(x) > narrow(len(c)) for c in centroids for x in c)
        gap = [[sum((x - y) ** 2 for x, y in zip(a, b)) for b in centroids] for a in centroids]
        self.order = [sorted((j for j in range(len(gap)) if j != a), key=lambda j: (gap[a][j], j)) for a in range(len(gap))]
        self.gap, self.measured = gap, 0
        if not self.wide:
            self.x = np.array(centroids, np.float64).reshape(len(centroids), len(centroids[0]) if centroids else 0)
            self.norm = (self.x**2).sum(1)

    def narrow(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of the rows of a matrix that were at ``at``."""
        x, near = x.astype(np.float64), at.copy()
        norm, best = (x**2).sum(1), np.zeros(len(x))

        def measure(rows: np.ndarray, j: int) -> np.ndarray:
            self.measured += len(rows)
            return norm[rows] + self.norm[j] - 2 * (x[rows] @ self.x[j])

        for a in np.unique(at).tolist():
            rows = np.flatnonzero(at == a)
            best[rows] = measure(rows, a)
            reach = 4 * best[rows]  # twice the distance, squared
            for j in self.order[a]:
                on = reach >= self.gap[a][j]
                rows, reach = rows[on], reach[on]
                if not len(rows):
                    break
                d = measure(rows, j)
                better = (d < best[rows]) | ((d == best[rows]) & (j < near[rows]))
                best[rows[better]], near[rows[better]] = d[better], j
        return near, best.astype(np.int64)

    def any_size(self, x: list[int], at: int) -> tuple[int, int]:
        """(cluster, squared distance) of one vector."""

        def measure(j: int) -> tuple[int, int]:
            self.measured += 1
            return sum((p - q) ** 2 for p, q in zip(x, self.c[j])), j

        first = best = measure(at)
        for j in self.order[at]:
            if self.gap[at][j] > 4 * first[0]:
                break
            best = min(best, measure(j))
        return best[1], best[0]


def _digits(n: int) -> Iterator[tuple[int, int]]:
    """The signed digits of a number, least first."""
    sign, n, k = (-1, -n, 0) if n < 0 else (1, n, 0)
    while n or not k:
        yield k, sign * (n & ((1 << DIGIT) - 1))
        n, k = n >> DIGIT, k + 1


def _assign(batch: pa.RecordBatch, means: SortMeans, dim: int, sums: dict | None) -> tuple[np.ndarray, list[int]]:
    """Clusters and distances of a batch; ``sums`` takes up its components and counts (dim -1) by cluster."""
    at = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
    wide, v = np.array(batch.column(2).to_pylist(), bool), batch.column(3).to_pylist()
    near, far = at.copy(), [0] * len(v)
    plain = np.flatnonzero(~wide) if not means.wide else np.array([], np.int64)
    if len(plain):
        x = np.frombuffer(b"".join(v[i] for i in plain), "<i4").reshape(len(plain), dim)
        near[plain], d = means.narrow(x, at[plain])
        for i, n in zip(plain.tolist(), d.tolist()):
            far[i] = n
        if sums is not None:
            for a in np.unique(near[plain]).tolist():
                mine = x[near[plain] == a]
                for k, s in enumerate(mine.sum(0, dtype=np.int64).tolist()):
                    sums[a, k] += s
                sums[a, -1] += len(mine)
    for i in sorted({*range(len(v))} - {*plain.tolist()}):
        x = numbers(v[i], bool(wide[i]))
        near[i], far[i] = means.any_size(x, int(at[i]))
        if sums is not None:
            for k, s in enumerate([*x, 1]):
                sums[int(near[i]), k if k < dim else -1] += s
    return near, far


def _round(x: DataFrame, centroids: list[list[int]], dim: int) -> DataFrame:
    """Every vector with its cluster; the last row of a task also holds the task's sums, so that one pass over the
    vectors yields both, and the sums are read alone, as a column."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, sums, held = SortMeans(centroids), defaultdict(int), None
        for b in batches:
            if b.num_rows:
                if held is not None:
                    yield filled(held, None)
                near, _ = _assign(b, means, dim, sums)
                held = [b.column(0), pa.array(near, pa.int32()), b.column(2), b.column(3)]
        if held is not None:
            yield filled(held, [{"cluster": a, "dim": k, "digit": g, "s": s} for (a, k), n in sorted(sums.items()) for g, s in _digits(n)])

    def filled(cols: list[pa.Array], last: list | None) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("cluster", pa.int32()), ("dim", pa.int32()), ("digit", pa.int32()), ("s", pa.int64())]))
        return pa.record_batch([*cols, pa.array([None] * (len(cols[0]) - 1) + [last], kind)], ["id", "at", "wide", "v", "sums"])

    return x.select("id", "at", "wide", "v").mapInArrow(run, f"{VECTOR}, sums {SUMS}")


def _means(x: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: k times dim sums come to the driver, and nothing else."""
    parts = x.filter("sums is not null").select(F.explode("sums").alias("p")).select("p.*")
    total: dict[tuple[int, int], int] = defaultdict(int)
    for r in parts.groupBy("cluster", "dim", "digit").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        total[r.cluster, r.dim] += int(r.s) << (DIGIT * r.digit)
    return [[total[a, k] // n for k in range(len(c))] if (n := total[a, -1]) else c for a, c in enumerate(centroids)]


def start(x: DataFrame, k: int = K, seed: str = SEED) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = x.select(h.alias("h"), "id", "wide", "v").orderBy(F.col("h").asc_nulls_last(), "id", "wide", "v").limit(k).collect()
    by_content = sorted(first, key=lambda r: (r.h is None, r.h or "", r.id or 0, numbers(r.v, r.wide)))
    return [numbers(r.v, r.wide) for r in by_content]


def cluster(rows: DataFrame, dim: int = DIM, k: int = K, rounds: int = ROUNDS, seed: str = SEED, scale: float = 1024.0, work: Workspace | None = None) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every kept vector, the distance as a decimal or, beyond it, the greatest long; and the
    centroids.

    Scale: a round is one pass over the vectors, without a shuffle of them; it writes them with their new clusters,
    from which the next one's scans start, and the round before goes. What is shuffled is k * dim sums a task, added
    on the map side first; what the driver sees is k * dim sums.
    """
    spark = rows.sparkSession
    let_workers_import(spark)
    work = work or Workspace(spark, "centroids")
    x = work.put(quantise(rows, dim, scale))
    centroids = start(x, k, seed)
    for _ in range(rounds if centroids else 0):
        last, x = x, work.put(_round(x, centroids, dim))
        work.drop(last)
        centroids = _means(x, centroids)
    final = StructType([StructField("id", LongType()), StructField("cluster", IntegerType()), StructField("distance", LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = SortMeans(centroids)
        for b in batches:
            if b.num_rows:
                near, far = _assign(b, means, dim, None)
                yield pa.record_batch([b.column(0), pa.array(near, pa.int32()), pa.array([min(HIGH, d) for d in far], pa.int64())], final.names)

    got = work.put(x.select("id", "at", "wide", "v").mapInArrow(run, final))
    work.drop(x)
    return got, centroids


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, centroids = cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    by = {r.cluster: min(HIGH, int(r.s)) for r in got.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    told = [(a, by[a], hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for a, c in enumerate(centroids) if a in by]
    small = spark.createDataFrame(told, "cluster int, cluster_inertia long, centroid_sha256 string")  # a row a cluster
    all_ = F.lit(min(HIGH, sum(by.values()))).cast("long").alias("inertia")
    return got.join(F.broadcast(small), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", all_, "centroid_sha256")


def _sql() -> str:
    """The rounds written out, each a step of its own."""
    nearest = "select rid, arg_min(c, {{'d': d, 'c': c}}) as a, min(d) as d from (select x.rid, m.c, list_sum(list_transform(list_zip(x.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d from x, m{r} m) group by rid"
    steps = [
        f"""x as materialized (select row_number() over () as rid, vec_id, list_transform(embedding, lambda c: cast(floor(1024 * cast(c as double)) as hugeint)) as v from embeddings
  where embedding is not null and len(embedding) = {DIM} and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0)""",
        f"""m0 as materialized (select row_number() over (order by sha256('{SEED}:' || cast(vec_id as varchar)) nulls last, vec_id, v) - 1 as c, v from x
  order by sha256('{SEED}:' || cast(vec_id as varchar)) nulls last, vec_id, v limit {K})""",
    ]
    for r in range(ROUNDS):
        steps.append(f"a{r} as materialized ({nearest.format(r=r)})")
        steps.append(
            f"""s{r} as materialized (select c, list(q order by k) as v from (
  select a.a as c, k, cast((sum(x.v[k]) - ((sum(x.v[k]) % count(*)) + count(*)) % count(*)) // count(*) as hugeint) as q
  from a{r} a join x using (rid), generate_series(1, {DIM}) g(k) group by a.a, k) group by c)"""
        )
        steps.append(f"m{r + 1} as materialized (select m.c, coalesce(s.v, m.v) as v from m{r} m left join s{r} s on m.c = s.c)")
    steps.append(f"f as materialized ({nearest.format(r=ROUNDS)})")
    return "with " + ",\n".join(steps) + f"""
select x.vec_id, cast(f.a as integer) as "cluster", cast(f.d as bigint) as distance, cast(sum(f.d) over (partition by f.a) as bigint) as cluster_inertia,
  cast(sum(f.d) over () as bigint) as inertia, sha256(array_to_string(list_transform(m.v, lambda c: cast(c as varchar)), ',')) as centroid_sha256
from f join x using (rid) join m{ROUNDS} m on m.c = f.a"""


SQL = {"op11_centroids": _sql()}
