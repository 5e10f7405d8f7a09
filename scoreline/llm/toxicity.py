"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are hashed words, word pairs and pairs that skip one word. FTRL-proximal gives each coordinate its own
rate and, by L1, keeps most weights at zero; the rest is a short list of (index, weight) that is broadcast.

The model is fitted on at most ``MOST`` labelled rows of ``MOST_FEATURES`` features in all, those of the smallest
hash of doc_id: a documented bound that keeps fitting in the driver's memory. Scoring reads every whole text.

Defined cases: a null or empty text has no features and scores by the bias alone; a text of any length is read
whole; labels that are null are not learned from; a doc_id with several labels or rows counts each; a score of just
0.5 is predicted 1; without any label every score is 0.5; a row with a null doc_id is scored and never held out;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Workspace, arrow_map, blocks, let_workers_import, raw, table

DIM = 1 << 20
MOST, MOST_FEATURES = 12_000, 40_000_000
EPOCHS = 3
ALPHA, BETA, L2 = 2.0, 1.0, 1.0
#: L1 for each 1,000 rows learned from: a weight must be earned by a share of them.
L1 = 1.0
#: Weight of a toxic row against another: there are few of them.
POSITIVE = 2.0

_EDGE = b".,;:!?\"'()[]{}<>#*$%&|"


def indices(text: bytes, dim: int = DIM) -> np.ndarray:
    """Distinct feature indices, ascending."""
    w = [x.strip(_EDGE) for x in text.lower().split()]
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    p, q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    all_ = [h, (h[:-1] * p) ^ h[1:], (h[:-2] * q) ^ h[2:]]
    x = np.concatenate(all_) * p
    return np.unique((x >> np.uint64(64 - dim.bit_length() + 1)).astype(np.int64))


class Ftrl:
    """Binary features. A text's score is the logistic of its summed weights and a bias, which is index dim."""

    def __init__(self, dim: int = DIM, l1: float = L1):
        self.z, self.n, self.dim, self.l1 = np.zeros(dim + 1), np.zeros(dim + 1), dim, l1

    def weights(self, i: np.ndarray) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * self.l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, i: np.ndarray, y: int) -> None:
        i = np.append(i, self.dim)
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        g *= POSITIVE if y else 1.0
        s = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / ALPHA
        self.z[i] += g - s * w
        self.n[i] += g * g

    def compact(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Indices and weights that are not zero, and the bias."""
        w = self.weights(np.arange(self.dim + 1))
        at = np.flatnonzero(w[:-1])
        return at, w[at], float(w[-1])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST, epochs: int = EPOCHS, most_features: int = MOST_FEATURES) -> tuple[np.ndarray, np.ndarray, float]:
    """Learns from labelled rows that are not held out: ``most`` of them and ``most_features`` features at most."""
    known = labels.filter("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("y")).filter(~held_out())
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", "y").limit(most)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, 512):
            x = [indices(t).astype("<u4").tobytes() for t in raw(b, "text")]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(x, pa.binary())], ["doc_id", "y", "x"])

    work, key = Workspace(docs.sparkSession, "toxicity"), ["h", "doc_id", "y", "n"]
    rows = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y"), run, "doc_id long, y int, x binary")
    held = work.put(rows.select(F.xxhash64("doc_id", F.lit(5)).alias("h"), "doc_id", "y", (F.octet_length("x") / 4).cast("long").alias("n"), "x"))
    sizes = held.select(*key).orderBy(*key).limit(most).collect()
    fits = int(np.searchsorted(np.cumsum([r.n for r in sizes]), most_features, "right"))
    some = held.filter(F.col("h") <= sizes[fits - 1].h) if fits else held.limit(0)
    got = sorted(some.toLocalIterator(), key=lambda r: (*(r[k] for k in key), r.x))[:fits]
    got.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r.doc_id)), r.doc_id, r.y, r.x))
    work.drop(held)
    model = Ftrl(l1=L1 * (1 + len(got) / 1000))
    data = [(np.frombuffer(r.x, "<u4").astype(np.int64), r.y) for r in got]
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            model.learn(*data[k])
    return model.compact()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """``score`` and ``predicted`` for every row; no shuffle, the weights are broadcast: at most DIM pairs."""
    at, w, bias = model
    let_workers_import(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), w.astype(np.float32), bias))

    def run(batches) -> Iterator[pa.RecordBatch]:
        i, v, b0 = sent.value
        full = np.zeros(DIM, np.float32)
        full[i] = v
        for batch in batches:
            for b in blocks(batch, 512):
                s = np.array([b0 + float(full[indices(t)].sum(dtype=np.float64)) for t in raw(b, "text")])
                p = 1 / (1 + np.exp(-np.clip(s, -35, 35)))
                yield pa.record_batch([b.column(0), b.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))
