"""Embedding whitening by a one-sided Jacobi SVD.

The rows, centred on their exact means, go through a blockwise QR decomposition: each task folds its blocks into one
triangular R, and the tasks' Rs are stacked and folded again up a tree, until one is left that has the whole table's
singular values and right vectors. Plane rotations make R's columns orthogonal, pair by pair, until no pair is left
that is not; their lengths are the standard deviations (times the root of the rows' number), and the rotations,
accumulated, the components. No covariance is formed on the way, so that small deviations keep their digits.

Defined cases: vectors that are null or empty or hold null or non-finite components, or one whose number does not fit a
long, take no part; vectors of each dimension are fitted among themselves; rows of one id, of none, and equal vectors are
rows of their own; a component along which nothing varies (one row, equal rows, fewer rows than dimensions) has a
null ``whitened``, and an ``explained`` of 0, or null where nothing varies at all; ``identity_error`` is over the
others, 0 if there are none; components of equal deviation come in any order, but the same for all rows;
deviations beyond 64 bits are given as the greatest long; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Workspace, let_workers_import, table, vectors

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Partial results that meet in one task on the way up the tree.
FANIN = 64
#: Rows that are folded into R at once.
BLOCK = 4096
HIGH = (1 << 63) - 1


def numbers(batch: pa.RecordBatch, scale: float = SCALE, shift: int = SHIFT) -> dict[int, tuple[pa.Array, np.ndarray]]:
    """The kept rows of a batch (vec_id, embedding) by dimension: ids, and floor(scale * c) + shift of the components."""
    found = {}
    for places, c in vectors(batch.column(1)):
        fits = np.abs(c).max(1, initial=0) * scale < 2.0**62
        if c.shape[1] and fits.any():
            found[c.shape[1]] = batch.column(0).take(pa.array(places[fits])), np.floor(scale * c[fits]).astype(np.int64) + shift
    return found


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By dimension: the number of rows and the exact sums, which a task adds up before they are shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for b in batches:
            for d, (ids, x) in numbers(b).items():
                safe = int(np.abs(x).max(initial=0)) * len(x) < HIGH
                sums = x.sum(0).tolist() if safe else [sum(c) for c in x.T.tolist()]
                for k, s in enumerate([len(ids), *sums]):
                    total[d, k] = total.get((d, k), 0) + s
        keys = list(total)
        cols = [pa.array([d for d, _ in keys], pa.int32()), pa.array([k for _, k in keys], pa.int32()), pa.array([Decimal(total[k]) for k in keys], pa.decimal128(38, 0))]
        yield pa.record_batch(cols, ["dim", "k", "s"])

    out: dict[int, list] = {}
    parts = rows.mapInArrow(run, "dim int, k int, s decimal(38,0)")
    for r in parts.groupBy("dim", "k").agg(F.sum("s").alias("s")).collect():
        out.setdefault(r.dim, []).append((r.k, int(r.s)))
    return {d: (sorted(got)[0][1], [s for _, s in sorted(got)[1:]]) for d, got in out.items()}


@dataclass
class Centre:
    """The exact mean of n rows, as their sums."""

    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S of each row, exact: as longs, or as Python's integers where those don't hold them."""
        most = max(map(abs, self.sums), default=0)
        if self.n * int(np.abs(x).max(initial=0)) + most < HIGH:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, each rounded once."""
        d = self.deviations(x)
        return d / self.n if d.dtype != object else np.array([[a / self.n for a in r] for r in d.tolist()], np.float64).reshape(d.shape)

    def squares(self, x: np.ndarray) -> list[int]:
        """The sum of each row's squared deviations."""
        d = self.deviations(x)
        if d.dtype != object and x.shape[1] * int(np.abs(d).max(initial=0)) ** 2 < HIGH:
            return (d * d).sum(1).tolist()
        return [min(HIGH, sum(a * a for a in r)) for r in d.tolist()]


def fold(r: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The triangular factor of rows stacked on an earlier one."""
    return np.linalg.qr(np.vstack([r, y]), mode="r")


def jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, V): r V has orthogonal columns of those lengths, longest first. A sweep rotates every pair of columns
    once, in rounds of pairs that share none, as in a tournament; sweeps go on until no pair needs a rotation."""
    d = r.shape[1]
    a, v = r.astype(np.float64).copy(), np.eye(d)
    ring = np.arange(d + d % 2)  # the last may stand for no column
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            p, q = ring[:half], ring[half:][::-1]
            ring = np.r_[ring[:1], ring[-1:], ring[1:-1]]
            real = (p < d) & (q < d)
            p, q = p[real], q[real]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            far = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if not far.any():
                continue
            turned = True
            p, q, xx, yy, xy = p[far], q[far], xx[far], yy[far], xy[far]
            with np.errstate(over="ignore"):  # an infinite zeta is no rotation
                zeta = (yy - xx) / (2 * xy)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cos = 1 / np.hypot(1, t)
            sin = cos * t
            for m in (a, v):
                x, y = m[:, p], m[:, q]
                m[:, p], m[:, q] = cos * x - sin * y, sin * x + cos * y
        if not turned:
            break
    length = np.sqrt((a * a).sum(0))
    order = np.argsort(-length, kind="stable")
    return length[order], v[:, order]


def _tree(parts: DataFrame, merge: Callable[[list[bytes]], bytes], work: Workspace) -> dict[int, bytes]:
    """One value for each dimension of many (dim, part, value): ``FANIN`` parts meet at a time, level by level."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dim": group.dim.iloc[:1], "part": group.part.iloc[:1] // FANIN, "value": [merge(group.sort_values("part").value.tolist())]})

    schema = "dim int, part long, value binary"
    level = work.put(parts)
    while (most := level.agg(F.max("part")).first()[0]) is not None and most > 0:
        last, level = level, work.put(level.groupBy("dim", F.floor(F.col("part") / FANIN).alias("_up")).applyInPandas(run, schema))
        work.drop(last)
    got = {r.dim: bytes(r.value) for r in level.collect()}  # one triangle for each dimension
    work.drop(level)
    return got


def _per_task(rows: DataFrame, fits: dict, start: Callable, add: Callable, finish: Callable[..., bytes]) -> DataFrame:
    """(dim, part, value): what a task makes of its rows of each dimension, block by block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict = {}
        for b in batches:
            for d, (_, x) in numbers(b).items():
                for lo in range(0, len(x), BLOCK):
                    held[d] = add(held[d] if d in held else start(d), fits[d], x[lo : lo + BLOCK])
        part = TaskContext.get().partitionId()
        cols = [pa.array(list(held), pa.int32()), pa.array([part] * len(held), pa.int64()), pa.array([finish(h) for h in held.values()], pa.binary())]
        yield pa.record_batch(cols, ["dim", "part", "value"])

    return rows.mapInArrow(run, "dim int, part long, value binary")


def _triangle(v: bytes) -> np.ndarray:
    d = int(np.frombuffer(v[:8], "<i8")[0])
    return np.frombuffer(v[8:], "<f8").reshape(-1, d)


def _packed(r: np.ndarray) -> bytes:
    return np.array([r.shape[1]], "<i8").tobytes() + np.ascontiguousarray(r, "<f8").tobytes()


def _folded(values: list[bytes]) -> bytes:
    r = _triangle(values[0])
    for v in values[1:]:
        r = fold(r, _triangle(v))
    return _packed(r)


@dataclass
class Whitener:
    """What a dimension's fit has found: components in columns, their standard deviations, shares of the variance."""

    centre: Centre
    components: np.ndarray
    deviation: np.ndarray
    explained: list[float | None]
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """The rows' whitened coordinates along the components that vary."""
        live = self.deviation > 0
        return self.centre.centred(x) @ (self.components[:, live] / self.deviation[live])


def _fit(centre: Centre, r: np.ndarray, most: int) -> Whitener:
    length, v = jacobi(r)
    # rounding alone leaves lengths of this size where there is no variance
    length = np.where(length > 1e-13 * max(len(length), 1) * length.max(initial=0), length, 0.0)
    total = float((length**2).sum())
    shares = [float(s**2) / total if total else None for s in length[:most]]
    return Whitener(centre, v[:, :most], length[:most] / np.sqrt(centre.n), shares)


#: (rows, mean, squares about it) of blocks of whitened rows.
Moments = tuple[int, np.ndarray, np.ndarray]


def _joined(a: Moments, b: Moments) -> Moments:
    """The moments of two sets of rows from those of each, none of them about a far point."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / max(n, 1)), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / max(n, 1))


def _moments(z: np.ndarray) -> Moments:
    mean = z.mean(0)
    return len(z), mean, (z - mean).T @ (z - mean)


def _pack_moments(m: Moments) -> bytes:
    return np.array([m[0]], "<i8").tobytes() + m[1].astype("<f8").tobytes() + m[2].astype("<f8").tobytes()


def _unpack_moments(v: bytes) -> Moments:
    k = int(np.sqrt((len(v) - 8) // 8 + 0.25))  # k + k * k numbers
    x = np.frombuffer(v[8:], "<f8")
    return int(np.frombuffer(v[:8], "<i8")[0]), x[:k], x[k:].reshape(k, k)


def _joined_all(values: list[bytes]) -> bytes:
    m = _unpack_moments(values[0])
    for v in values[1:]:
        m = _joined(m, _unpack_moments(v))
    return _pack_moments(m)


def fit(rows: DataFrame, most: int = COMPONENTS, work: Workspace | None = None) -> dict[int, Whitener]:
    """A whitener for each dimension that occurs among the vectors (vec_id, embedding).

    Scale: three passes over the vectors as they are, for the sums, the triangles and the check of the result; a
    task returns one row of dim or dim * dim numbers, and these are added or folded up a tree of fan-in ``FANIN``.
    The driver sees one triangle for each dimension.
    """
    spark = rows.sparkSession
    let_workers_import(spark)
    work = work or Workspace(spark, "whitening")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centres = {d: Centre(n, sums) for d, (n, sums) in _sums(rows).items()}
    triangles = _tree(_per_task(rows, centres, lambda d: np.zeros((0, d)), lambda r, c, x: fold(r, c.centred(x)), _packed), _folded, work)
    fits = {d: _fit(centres[d], _triangle(v), most) for d, v in triangles.items()}

    def add(m: Moments | None, w: Whitener, x: np.ndarray) -> Moments:
        new = _moments(w.whiten(x))
        return new if m is None else _joined(m, new)

    for d, v in _tree(_per_task(rows, fits, lambda d: None, add, _pack_moments), _joined_all, work).items():
        n, _, squares = _unpack_moments(v)
        fits[d].identity_error = float(np.abs(squares / n - np.eye(len(squares))).max(initial=0.0))
    return fits


def whiten(rows: DataFrame, fits: dict[int, Whitener]) -> DataFrame:
    """A row for each vector and component."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, (ids, x) in numbers(b).items():
                w = fits[d]
                k, n = len(w.deviation), len(ids)
                z = np.full((n, k), np.nan)
                z[:, w.deviation > 0] = w.whiten(x)
                yield pa.record_batch(
                    [
                        ids.take(pa.array(np.repeat(np.arange(n), k))),
                        pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                        pa.array(np.full(n * k, w.centre.n), pa.int64()),
                        pa.array(np.repeat(np.array(w.centre.squares(x), np.int64), k)),
                        pa.array(z.ravel(), pa.float64(), from_pandas=True),
                        pa.array(w.explained * n, pa.float64()),
                        pa.array(np.full(n * k, w.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    let_workers_import(rows.sparkSession)
    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return whiten(rows, fit(rows))
