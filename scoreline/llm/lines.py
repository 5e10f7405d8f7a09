"""Line deduplication over levelled sorted runs of line hashes.

A run is a written table of line hashes with the number of documents that hold them, in buckets by hash, each
sorted. Batches of documents come one after the other: a batch's hashes are merge-anti-joined with the runs of
frequent lines, what is left is counted and added as a run of level 0. Once a level has ``fanout`` runs they are
compacted into one run of the next level, and lines that have reached the threshold move to a frequent run. The
runs lie in a folder of the caller's and outlive the session: a later batch goes on with them.

Defined cases: a null or empty text is one empty line; a line of white space alone has an empty key and always
stays; a text of any length is read whole; a document counts once for a line however often it holds it; rows
equal in doc_id and text are documents of their own; a key found in just as many documents as the threshold is
frequent; other columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import BLANKS, KEY, Workspace, arrow_map, boxed, bucketed, drop_tables, raw, read_text, reopened, row_key, table, unboxed, write_text


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def line_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


class LineRuns:
    """The runs under the folder ``root``, by level, and the frequent runs."""

    SCHEMA = "h BINARY, n BIGINT"

    def __init__(self, spark: SparkSession, root: str, threshold: int, fanout: int = 3):
        self.spark, self.root, self.threshold, self.fanout = spark, root, threshold, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.made, self.levels, self.frequent = 0, [], []
        if known := read_text(spark, f"{root}/runs.json"):
            k = json.loads(known)
            self.made = k["made"]
            again = lambda x: reopened(spark, f"{root}/{x[0]}", self.SCHEMA, "h", x[1])
            self.levels, self.frequent = [[again(x) for x in level] for level in k["levels"]], [again(x) for x in k["frequent"]]

    def _save(self, *gone: DataFrame) -> None:
        """The list of runs is replaced first; runs that it no longer names are removed after it."""
        named = lambda r: (r._staged_at.rsplit("/", 1)[1], int(r._staged_at.rsplit("-", 1)[1]))
        now = {"made": self.made, "levels": [[named(r) for r in level] for level in self.levels], "frequent": [named(r) for r in self.frequent]}
        write_text(self.spark, f"{self.root}/runs.json", json.dumps(now))
        drop_tables(self.spark, *gone)

    def _write(self, run: DataFrame) -> DataFrame:
        self.made += 1
        return bucketed(run.select("h", "n"), "h", f"{self.root}/run-{self.made}-{self.buckets}")

    def without(self, hashes: DataFrame, runs: list[DataFrame]) -> DataFrame:
        for r in runs:
            hashes = hashes.join(r.hint("merge"), "h", "left_anti")
        return hashes

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """Hashes that no batch has had so far: for deduplication of a stream of batches, first one wins."""
        return self.without(hashes, [r for level in [*self.levels, self.frequent] for r in level])

    def fresh(self, hashes: DataFrame) -> DataFrame:
        """A batch's hashes, counted, without those known to be frequent."""
        return self.without(hashes.groupBy("h").agg(F.count("*").alias("n")), self.frequent)

    def add(self, hashes: DataFrame) -> None:
        """``hashes``: a row (h) for each document and distinct line of the batch."""
        gone = self._insert(0, self._write(self.fresh(hashes)))
        self._save(*gone)

    def _insert(self, level: int, run: DataFrame) -> list[DataFrame]:
        """Adds a run to a level and compacts what is full; returns the runs that are gone."""
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) < self.fanout:
            return []
        old, self.levels[level] = self.levels[level], []
        summed = self._sum(old)
        self.frequent.append(self._write(summed.filter(F.col("n") >= self.threshold)))
        rest = self._write(summed.filter(F.col("n") < self.threshold))
        return [*old, *self._insert(level + 1, rest)]

    def _sum(self, runs: list[DataFrame]) -> DataFrame:
        """Runs are read as plain files here: a union of bucketed tables may lose their buckets once it is planned."""
        both = self.spark.read.schema(self.SCHEMA).parquet(*(r._staged_at for r in runs))
        return both.groupBy("h").agg(F.sum("n").alias("n"))

    def found(self) -> DataFrame:
        """All hashes that are frequent by now, once each; the runs stay as they are."""
        runs = [r for level in self.levels for r in level]
        out = self._sum(runs).filter(F.col("n") >= self.threshold).select("h") if runs else None
        if self.frequent:
            known = self.spark.read.schema(self.SCHEMA).parquet(*(r._staged_at for r in self.frequent)).select("h")
            out = known.union(out) if out is not None else known
        return out.distinct()


def _hashes(docs: DataFrame, batches: int) -> DataFrame:
    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [sorted({line_hash(k) for x in t.split(b"\n") if (k := line_key(x))}) for t in raw(b, "text")]
        yield pa.record_batch([b.column(1), b.column(2), b.column(3), pa.array(got, pa.list_(pa.binary()))], [*KEY, "batch", "hs"])

    batch = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(batches)).cast("int").alias("batch")
    return arrow_map(docs.select("text", *row_key("doc_id", "text"), batch), run, "rk1 long, rk2 int, batch int, hs array<binary>")


def drop_frequent(docs: DataFrame, threshold: int = 10, batches: int = 9, work: Workspace | None = None, fanout: int = 3, root: str | None = None) -> DataFrame:
    """A struct ``row`` of the columns of ``docs`` but the text, with ``kept`` (the text without frequent lines),
    ``n_lines`` and ``n_dropped``.

    Lines whose key is found in ``threshold`` or more documents go from all of them. From the ``fanout``-th batch on
    a batch meets the frequent runs of the earlier ones. With ``root``, a folder of runs, documents that were added to
    it before count as well, and these are added.

    Scale: only 16-byte hashes are shuffled to count lines, summed on the map side first; a run is read where it
    lies. Whole texts move once, to meet the list of their own frequent hashes. Frequent lines are joined, never
    broadcast on trust.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "lines")
    held = work.put(_hashes(docs, batches), partition_by="batch")
    runs = LineRuns(spark, root or work.path(), threshold, fanout)
    for i in range(batches):
        runs.add(held.filter(F.col("batch") == i).select(F.explode("hs").alias("h")))
    gone = work.put(runs.found())
    if root is None:
        drop_tables(spark, *runs.frequent, *(r for level in runs.levels for r in level))
    hits = held.select(*KEY, F.explode("hs").alias("h")).join(gone, "h").groupBy(*KEY).agg(F.collect_set("h").alias("gone"))
    met = docs.select(boxed(docs, "text"), "text", *row_key("doc_id", "text")).join(hits.hint("shuffle_hash"), KEY, "left").select("row", "text", "gone")

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept, n, m = [], [], []
        for t, g in zip(raw(b, "text"), b.column(2).to_pylist()):
            lines = t.split(b"\n")
            n.append(len(lines))
            if g:
                g = set(g)
                lines = [x for x in lines if not (k := line_key(x)) or line_hash(k) not in g]
            m.append(n[-1] - len(lines))
            kept.append(b"\n".join(lines))
        yield pa.record_batch([b.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(m, pa.int64())], ["row", "kept", "n_lines", "n_dropped"])

    counts = StructType.fromDDL("kept string, n_lines long, n_dropped long")
    return arrow_map(met, run, StructType([met.schema["row"], *counts]))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = drop_frequent(table(spark, sf_dir, "documents", "doc_id", "text"))
    return got.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the text that is left and its length; other columns as they were."""
    return drop_frequent(docs).select(*unboxed(docs, text=F.col("kept"), n_chars=F.char_length("kept").cast("long")))


SQL = {
    "op4_lines": r"""
with d as (select row_number() over () as rid, doc_id, text from documents),
l as (select rid, doc_id, i, s, translate(trim(s, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as s, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i from d) x),
f as (select k from l where k <> '' group by k having count(distinct rid) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (f.k is not null) as n_dropped,
  sha256(coalesce(string_agg(s, chr(10) order by i) filter (f.k is null), '')) as kept_sha256
from l left join f on l.k = f.k group by rid, doc_id""",
}
