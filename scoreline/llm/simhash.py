"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are cut into m partitions, correlated bits together, with a threshold t_i for each: if two
fingerprints differ in at most 3 bits and the t_i sum up to 3 - m + 1, they differ in at most t_i bits in at
least one partition i. Partitions may get unequal thresholds; a dynamic program picks them by estimated
candidate counts. Probing a partition sends a fingerprint to every value within t_i bits; all that meet are
verified on all 64 bits.

The pipeline's stage links more than op3's rule does: also all texts whose sets of 5-word shingles have a
Jaccard similarity of 0.8 or more. Candidates share one of 24 bands of 4 minimum hashes, which a pair of
similarity 0.8 misses with a chance of 3 in a million, and are verified on their whole shingle sets.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; a text of any length is
read whole; a null doc_id never is a component's smallest unless all its ids are null; components are told apart
by their links, whatever their ids; rows of one text are linked; a bit set in just half the hashes is 0; other
columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Workspace, arrow_map, boxed, raw, table, unboxed
from .graph import components

BITS, RADIUS = 64, 3
#: Fingerprints of one probed value that meet in a task; a value of more is split by further bits, up to ``LEVELS``
#: times, and what is still more is dealt out in pairs of chunks.
CHUNK, LEVELS = 256, 3
#: Cost of moving a row against verifying a candidate.
ROW, CANDIDATE = 1.0, 0.05
#: The stage's second link: words of a shingle, similarity in fifths, bands and minimum hashes of each.
WORDS, FIFTHS, BANDS, DEPTH = 5, 4, 24, 4
#: Texts of one band that meet in a task; a band of more is dealt out in pairs of chunks.
TEXTS = 512
_odd = np.random.default_rng(42).integers(0, 1 << 64, (3, BANDS * DEPTH), np.uint64) | np.uint64(1)


def fingerprint(text: bytes, n: int = 3) -> int:
    w = text.lower().split()
    if not w:
        return 0
    s = list(map(b" ".join, zip(*(w[i:] for i in range(n))))) if len(w) >= n else [b" ".join(w)]
    seen = np.zeros(BITS, np.int64)
    f = xxhash.xxh64_intdigest
    for at in range(0, len(s), 65536):
        h = np.array([f(x, 42) for x in s[at : at + 65536]], "<u8")
        seen += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(seen * 2 > len(s), bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """(doc_id, fp): fp the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fp = [_signed(fingerprint(t, n)) for t in raw(batch, "text")]
        yield pa.record_batch([batch.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, fp long")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _odd[2, -1]
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; a text of fewer words is one shingle, one of none has none."""
    w = text.lower().split()
    h = np.array([xxhash.xxh64_intdigest(x, 42) for x in w], np.uint64)
    if len(h) < WORDS:
        h = np.r_[h, np.zeros(WORDS - len(h), np.uint64)] if len(h) else h
    n = max(len(h) - WORDS + 1, 0)
    x = np.zeros(n, np.uint64)
    for i in range(WORDS):
        x += h[i : i + n] * _odd[2, i]
    return np.unique(_mixed(x))


def bands(s: np.ndarray) -> np.ndarray:
    """One key for each band of minimum hashes over a text's shingles."""
    low = np.full(BANDS * DEPTH, ~np.uint64(0))
    for at in range(0, len(s), 512):
        low = np.minimum(low, ((s[at : at + 512, None] ^ _odd[0]) * _odd[1]).min(0))
    key = (low.reshape(BANDS, DEPTH) * _odd[2, :DEPTH]).sum(1, dtype=np.uint64)
    return _mixed(key + np.arange(BANDS, dtype=np.uint64) * _odd[2, DEPTH])


def banded(docs: DataFrame) -> DataFrame:
    """``fingerprints`` of rows named by ``rid``, with txt, which stands for the words of a text, and the keys of its
    bands; no words, no bands."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fp, txt, keys = [], [], []
        for t in raw(batch, "text"):
            s = shingles(t)
            fp.append(_signed(fingerprint(t)))
            txt.append(_signed(xxhash.xxh64_intdigest(b" ".join(t.lower().split()), 43)))
            keys.append(bands(s).view(np.int64) if len(s) else [])
        made = [pa.array(fp, pa.int64()), pa.array(txt, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.record_batch([batch.column(0), batch.column(1), *made], ["rid", "doc_id", "fp", "txt", "bands"])

    schema = "rid long, doc_id long, fp long, txt long, bands array<long>"
    return arrow_map(docs.select("rid", F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and of those with bits i and j both set; summed per task, 4,096 numbers in all."""

    def run(batches):
        n, m = 0, np.zeros((BITS, BITS), np.int64)
        for b in batches:
            x = np.unpackbits(b.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n, m = n + len(x), m + (x.T @ x).astype(np.int64)
        yield pa.record_batch([pa.array(np.arange(BITS * BITS + 1), pa.int32()), pa.array(np.r_[m.ravel(), n])], ["i", "n"])

    got = dict(fps.select("fp").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n")).collect())
    return got.get(BITS * BITS, 0), np.array([got.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of near-equal width; each starts from the free bit of strongest correlations and takes those
    that correlate most with what it has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    r = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(r, 0)
    free, out = set(range(BITS)), []
    for k in range(m):
        f = sorted(free)
        part = [max(f, key=lambda b: (r[b, f].max(), -b))]
        free.discard(part[0])
        for _ in range(BITS // m + (k < BITS % m) - 1):
            part.append(max(sorted(free), key=lambda b: r[b, part].sum()))
            free.discard(part[-1])
        out.append(sorted(part))
    return out


def _within(p: np.ndarray, t: int) -> float:
    """Chance that independent bits that differ with chances p differ in at most t places."""
    d = np.zeros(t + 1)
    d[0] = 1
    for x in p:
        d[1:], d[0] = d[1:] * (1 - x) + d[:-1] * x, d[0] * (1 - x)
    return float(d.sum())


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of -1 (partition left out) up, one for each partition, that sum up to ``total`` at least cost.
    cost[i][t + 1] is that of threshold t in partition i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (v, ts) in best.items():
            for t in range(-1, len(c) - 1):
                if s + t not in new or v + c[t + 1] < new[s + t][0]:
                    new[s + t] = (v + c[t + 1], [*ts, t])
        best = new
    return best[total]


def _value(bits: list[int]):
    """The bits of fp at these places as a number, in Spark."""
    x = F.lit(0).cast("long")
    for k, b in enumerate(bits):
        x = x.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long")), k))
    return x


def _named(part: int, free):
    """Values of different partitions get different keys; with a key go the bits that it does not name."""
    return lambda v: F.struct(F.xxhash64(F.lit(part), v).alias("key"), free.alias("free"))


def plan(fps: DataFrame) -> list[tuple[list[int], int]]:
    """Partitions and thresholds of least estimated cost, over 2, 3 and 4 partitions.

    A threshold of 0 meets as many candidates as equal values make, counted exactly over all fingerprints; for
    higher ones that count is scaled by the chances of the bits to differ.
    """
    n, both = bit_statistics(fps)
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    splits = {m: group_bits(n, both, m) for m in (2, 3, 4)}
    parts = [(m, i, bits) for m, s in splits.items() for i, bits in enumerate(s)]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), _value(b).alias("v")) for k, (_, _, b) in enumerate(parts)])
    met = fps.select(F.explode(keys).alias("x")).groupBy("x").agg(F.count("*").alias("c"))
    same = dict(met.groupBy("x.k").agg(F.sum(F.expr("double(c) * (c - 1) / 2"))).collect())
    best = None
    for m, s in splits.items():
        cost = []
        for k, (mm, i, bits) in enumerate(parts):
            if mm == m:
                base = max(_within(differ[bits], 0), 1e-30)
                at = [(1 if t == 0 else 2) * same.get(k, 0) * _within(differ[bits], t) / base for t in range(RADIUS + 1)]
                probes = [sum(comb(len(bits), j) for j in range(t + 1)) for t in range(RADIUS + 1)]
                cost.append([0.0] + [ROW * n * probes[t] + CANDIDATE * at[t] for t in range(RADIUS + 1)])
        v, ts = allocate(cost, RADIUS - m + 1)
        if best is None or v < best[0]:
            best = (v, [(b, t) for b, t in zip(s, ts) if t >= 0])
    return best[1]


def forest(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """(member, root) for the components within x of distance at most 3, by taking each component's frontier out
    of what is left: no fingerprint is compared with those that already have a component."""
    left = np.unique(x)
    while len(left) > 1:
        root, todo, left = left[0], [left[0]], left[1:]
        while todo and len(left):
            hit = np.bitwise_count(left ^ todo.pop()) <= RADIUS
            if hit.any():
                todo.extend(left[hit])
                for v in left[hit]:
                    yield v, root
                left = left[~hit]


def _edges(batches, chunk: int = CHUNK):
    """Edges between fingerprints of equal key; rows come sorted by key, so that a key's rows stand together, at
    most two chunks of them. Short runs are compared at growing lags, all at once; long ones by ``forest``."""
    tail_k, tail_f = np.empty(0, np.int64), np.empty(0, np.uint64)

    def work(k, f):
        cut = np.r_[0, np.flatnonzero(np.diff(k)) + 1, len(k)]
        width = np.diff(cut)
        a, b = [], []
        for i in np.flatnonzero(width > 16):
            pairs = list(forest(f[cut[i] : cut[i + 1]]))
            a += [p[0] for p in pairs]
            b += [p[1] for p in pairs]
        small = np.repeat(width <= 16, width)
        k, f = k[small], f[small]
        for lag in range(1, 16):
            at = np.flatnonzero(k[lag:] == k[:-lag]) if len(k) > lag else []
            if not len(at):
                break
            hit = at[(np.bitwise_count(f[at] ^ f[at + lag]) <= RADIUS) & (f[at] != f[at + lag])]
            a.extend(f[hit + lag])
            b.extend(f[hit])
        return pa.record_batch([pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(np.array(b, np.uint64).view(np.int64))], ["a", "b"])

    for batch in batches:
        k = np.r_[tail_k, batch.column(0).to_numpy(zero_copy_only=False)]
        f = np.r_[tail_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
        if len(k):
            last = np.searchsorted(k, k[-1])
            tail_k, tail_f = k[last:], f[last:]
            yield work(k[:last], f[:last])
    yield work(tail_k, tail_f)


def _split(level: int, g: int):
    """Bits whose place has g as its digit of weight 4 ** level: four sets that hold every bit once."""
    return F.lit(_signed(sum(1 << b for b in range(BITS) if b >> 2 * level & 3 == g)))


def links(fps: DataFrame, chosen: list[tuple[list[int], int]], work: Workspace, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) that join all fingerprints within 3 bits of each other to their components.

    Fingerprints that meet at a value shared by many still differ in at most 3 of the bits that the value does not
    name, so of any four sets of these bits they agree in one: such a value is split by each set in turn.
    """
    keys = []
    for i, (bits, t) in enumerate(chosen):
        v = _value(bits)
        masks = [sum(1 << b for b in c) for j in range(t + 1) for c in combinations(range(len(bits)), j)]
        values = F.array(v) if t == 0 else F.transform(F.array(*[F.lit(x).cast("long") for x in masks]), lambda m: m.bitwiseXOR(v))
        free = F.lit(_signed(sum(1 << b for b in range(BITS) if b not in bits)))
        keys.append(F.transform(values, _named(i, free)))
    keyed = fps.select("fp", F.explode(F.concat(*keys)).alias("x")).select("fp", "x.key", "x.free")
    ready, staged = [], []
    for level in range(LEVELS + 1):
        counted = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
        met = work.put(keyed.join(counted, "key").select("key", "fp", "free", "n"))
        staged.append(met)
        ready.append(met.filter(F.col("n") <= chunk).select("key", "fp"))
        hot = met.filter(F.col("n") > chunk)
        if level == LEVELS or hot.isEmpty():
            break
        parts = [F.struct(F.xxhash64("key", F.lit(level), F.lit(g), F.col("fp").bitwiseAND(F.col("free")).bitwiseAND(_split(level, g))).alias("key"), F.col("free").bitwiseAND(F.bitwise_not(_split(level, g))).alias("free")) for g in range(4)]
        keyed = hot.select("fp", F.explode(F.array(*parts)).alias("x")).select("fp", "x.key", "x.free")
    g = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(3)), g).cast("int")
    pairs = hot.select("key", "fp", g.alias("g"), mine.alias("c")).select("key", "fp", "c", F.explode(F.expr("sequence(0, g - 1)")).alias("d"))
    dealt = pairs.select(F.xxhash64("key", F.least("c", "d"), F.greatest("c", "d")).alias("key"), "fp")
    for r in ready:
        dealt = dealt.union(r)
    got = work.put(dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_edges, "a long, b long"))
    work.drop(*staged)
    return got


def alike(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """(member, root) by place for the components of texts of similarity 0.8 or more, each component's frontier
    taken out of what is left as in ``forest``."""
    sets = [shingles(t) for t in texts]
    size = np.array([len(s) for s in sets])
    place = np.unique(np.concatenate(sets), return_inverse=True)[1]
    at = np.split(place, np.cumsum(size)[:-1])
    mark = np.zeros(len(place), bool)
    left = np.flatnonzero(size)
    while len(left) > 1:
        root, todo, left = left[0], [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = left[(5 * size[left] >= FIFTHS * size[x]) & (5 * size[x] >= FIFTHS * size[left])]
            if not len(near):
                continue
            mark[at[x]] = True
            both = np.add.reduceat(mark[np.concatenate([at[i] for i in near])], np.r_[0, np.cumsum(size[near])[:-1]], dtype=np.int64)
            mark[at[x]] = False
            hit = near[5 * both >= FIFTHS * (size[near] + size[x] - both)]
            todo.extend(hit)
            for v in hit:
                yield v, root
            left = left[~np.isin(left, hit)]


def _alike_edges(batches):
    """Edges between fingerprints of texts of equal key; rows come sorted by key."""
    last, fp, texts = None, [], []

    def work():
        pairs = [(fp[a], fp[b]) for a, b in alike(texts) if fp[a] != fp[b]] if len(texts) > 1 else []
        return pa.record_batch([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    for batch in batches:
        for k, f, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch, "text")):
            if k != last:
                yield work()
                last, fp, texts = k, [], []
            fp.append(f)
            texts.append(t)
    yield work()


def similar(docs: DataFrame, fps: DataFrame, work: Workspace, chunk: int = TEXTS) -> DataFrame:
    """Edges (a, b) between fingerprints that join all texts of similarity 0.8 or more to their components.

    ``docs`` has ``rid``, text, and buckets by ``rid``.

    Scale: rows of the same words are one text. Bands that hold the same texts are verified once; only texts that
    share a band move, and a band of many is dealt out in pairs of chunks.
    """
    first = work.put(fps.groupBy("txt").agg(F.first("fp").alias("fp"), F.min("rid").alias("rid"), F.first("bands").alias("bands")))
    keyed = first.select("txt", F.explode("bands").alias("key"))
    counted = keyed.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("txt", F.lit(5))).alias("x")).filter("n > 1")
    once = counted.groupBy("n", "x").agg(F.min("key").alias("key"))
    met = work.put(keyed.join(once.select("key", "n"), "key"))
    some = first.join(met.select("txt").distinct(), "txt").select("txt", "fp", "rid")
    texts = work.put(docs.select("rid", "text").join(some.hint("shuffle_hash"), "rid").select("txt", "fp", "text"))
    g = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("txt", F.lit(3)), g).cast("int")
    pairs = met.filter(F.col("n") > chunk).select("key", "txt", g.alias("g"), mine.alias("c")).select("key", "txt", "c", F.explode(F.expr("sequence(0, g - 1)")).alias("d"))
    hot = pairs.select(F.xxhash64("key", F.least("c", "d"), F.greatest("c", "d")).alias("key"), "txt")
    whole = met.filter(F.col("n") <= chunk).select("key", "txt")
    dealt = whole.union(hot).join(texts, "txt").select("key", "fp", "text").repartition("key").sortWithinPartitions("key")
    got = work.put(dealt.mapInArrow(_alike_edges, "a long, b long"))
    work.drop(first, met, texts)
    return got


def near_duplicates(docs: DataFrame, work: Workspace | None = None, by_words: bool = False) -> DataFrame:
    """Every row of ``docs`` with its fingerprint, component_id, the smallest doc_id reachable over links of at most
    3 bits, and ``root``, which names the component. ``by_words`` adds links of similarity 0.8 or more over 5-word
    shingles; ``docs`` then has a column ``rid`` that names its rows, and buckets by it.

    Scale: equal fingerprints are one node, summed on the map side. A value that many fingerprints share is
    split by further bits, and a task returns a forest of what it linked, never all pairs.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "simhash")
    fps = work.put(banded(docs) if by_words else fingerprints(docs))
    nodes = work.put(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = links(nodes.select("fp"), plan(nodes), work)
    alike_ = similar(docs, fps, work) if by_words else None
    root = components(work, found.union(alike_) if by_words else found)
    named = nodes.join(root, nodes.fp == root.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    label = work.put(named.join(ids, "root").select("fp", "root", "component_id"))
    work.drop(found, alike_, nodes)
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return fps.join(label, "fp").select("doc_id", shown, "component_id", "root", *["rid"] * by_words)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "fingerprint", "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: that of the smallest doc_id, an id before none, and of equal ids any one.
    Links are those of op3 and those of similarity 0.8 or more over 5-word shingles.

    Whole texts move once, into buckets by row: what is verified and what stays are found there."""
    work = Workspace(spark, "simhash")
    rows = work.put_bucketed(docs.select(F.monotonically_increasing_id().alias("rid"), boxed(docs)), "rid")
    got = near_duplicates(rows.select("rid", "row.doc_id", "row.text"), work, by_words=True)
    stay = got.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("k")).select("k.rid")
    return rows.join(stay.hint("shuffle_hash"), "rid").select(*unboxed(docs))
