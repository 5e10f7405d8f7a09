"""Best-fit packing of token sequences by hierarchical residual packing.

Each partition packs its own pieces best-fit, longest first, and emits the bins that are nearly full. Bins that
are not become items themselves and go up a tree: a few partitions' bins meet in one, are packed best-fit again,
and so on up to the root, where all bins are emitted. A bin that no open bin fits into is emitted at once, and
the tree ends where no bin is left that could go into another.

Tokens are the ids that ``tokenizers`` gives for the public byte-level vocabulary ``byte_bpe_50k``, its special
token in a text included. They are made by tiktoken from that same file, as it needs a fifth of the time (tested
to be equal); a text that it gives up on is encoded by tokenizers. Each document ends with id 0.

Defined cases: a null or empty text is the one token 0; a document longer than a sequence is cut from its end,
so that only its first piece may be shorter; a text of any length is encoded whole; pieces of one length go in
the order in which they come; rows of one doc_id are documents of their own; columns but doc_id and text are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Workspace, arrow_map, blocks, table

LENGTH = 2048
#: A bin with this many tokens is emitted before the root.
FULL = 2040
#: Partitions whose open bins meet in one at the next level.
FANIN = 8
#: Pieces of a partition that are packed at once; a partition of more packs several such groups, whose bins meet at
#: the next level like those of several partitions.
GROUP = 200_000
ITEM = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"
BIN = f"used int, home int, items array<{ITEM}>"


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others
    in order by characters from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def encoder(vocabulary: str = "byte_bpe_50k"):
    """A function from texts to lists of ids."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as f:
        found = json.load(f)
    special = {t["content"]: t["id"] for t in found["added_tokens"]}
    byte = byte_of()
    ranks = {bytes(byte[c] for c in t): i for t, i in found["model"]["vocab"].items() if t not in special}
    e = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def one(text: str) -> list[int]:
        try:
            return e.encode(text, allowed_special="all")
        except ValueError:  # its splitting gives up in a run of about a million white spaces
            return _library(vocabulary).encode(text, add_special_tokens=False).ids

    return lambda texts: list(map(one, texts))


@cache
def _library(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; all but the first are full."""
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def best_fit(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    """Items by index, longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(length + 1)]  # open bins by what is free in them
    some = 0  # bit f is set if room[f] has a bin
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if fits := some >> sizes[i]:
            free = sizes[i] + (fits & -fits).bit_length() - 1
            b = room[free].pop()
            some ^= (not room[free]) << free
            bins[b].append(i)
        else:
            free, b = length, len(bins)
            bins.append([i])
        if free > sizes[i]:
            room[free - sizes[i]].append(b)
            some |= 1 << (free - sizes[i])
    return bins


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A bin of one piece for each piece of every document."""
    encode = encoder()
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
    for batch in batches:
        for b in blocks(batch, 256):
            used, items = [], []
            for doc, ids in zip(b.column(0).to_pylist(), encode([t or "" for t in b.column(1).to_pylist()])):
                ids = np.array([*ids, 0], "<u4")
                for k, (s, n) in enumerate(cut(len(ids), length)):
                    used.append(n)
                    items.append([{"doc_id": doc, "piece": k, "start": s, "length": n, "ids_crc32": zlib.crc32(ids[s : s + n].tobytes())}])
            yield pa.record_batch([pa.array(used, pa.int32()), pa.array([0] * len(used), pa.int32()), pa.array(items, kind)], ["used", "home", "items"])


def _pack(t: pa.Table, home: int, length: int, full: int, keep: int | None) -> pa.RecordBatch:
    """One group packed best-fit. At most one bin of the result is half empty, as two such would be one. ``keep``:
    so many half-empty bins there can be in all groups together; as each goes into one bin at most, of the other
    open bins only the ``keep`` with most room are of use further up."""
    t = t.combine_chunks()
    sizes, items = t.column("used").to_pylist(), t.column("items").chunk(0)
    groups = best_fit(sizes, length)
    used = np.array([sum(sizes[i] for i in g) for g in groups], np.int32)
    flat = items.take(pa.array([i for g in groups for i in g], pa.int64()))
    ends = np.cumsum([len(g) for g in groups])
    offs = np.r_[0, np.asarray(flat.offsets)[ends]] - np.asarray(flat.offsets)[0]
    whole = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), flat.flatten())
    done = used >= full
    if keep is not None:
        takers = np.flatnonzero(~done & (2 * used > length))
        done[takers[np.argsort(used[takers], kind="stable")[keep:]]] = True
    return pa.record_batch([pa.array(used), pa.array(np.full(len(groups), home, np.int32)), whole, pa.array(done)], ["used", "home", "items", "done"])


def _pack_pieces(length: int, full: int):
    """The first level: what a partition has, in groups of at most ``GROUP``, so that memory has a bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        home, held, n = TaskContext.get().partitionId(), [], 0
        for b in _pieces(batches, length):
            held.append(b)
            n += b.num_rows
            if n >= GROUP:
                yield _pack(pa.Table.from_batches(held), home, length, full, None)
                held, n = [], 0
        if n:
            yield _pack(pa.Table.from_batches(held), home, length, full, None)

    return run


def _pack_bins(length: int, full: int, groups: int):
    """The levels above: all bins that meet in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield _pack(pa.Table.from_batches(held), held[0].column("home")[0].as_py(), length, full, groups)

    return run


def _numbered(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A row for each piece of bins (sequence_id, items), with its place."""
    items = b.column(1)
    n = np.diff(np.asarray(items.offsets))
    x = items.flatten()
    size = x.field("length").to_numpy(zero_copy_only=False)
    ends = np.cumsum(size) - size
    first = np.repeat(ends[np.cumsum(n) - n] if len(n) else ends, n)
    fields = [x.field(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    seq = pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), n))
    yield pa.record_batch([*fields, seq, pa.array(ends - first, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, length: int = LENGTH, full: int = FULL, work: Workspace | None = None) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there.

    Scale: texts are read once, in place; what moves is open bins, a row each with what is in it. Of a group at
    most one bin is half empty, and above the first level each sends up no more bins than there are groups, so that
    the upper levels get fewer the fewer they are. The levels' number is the logarithm of the partitions'.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "packing")
    schema = f"{BIN}, done boolean"
    level = work.put(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack_pieces(length, full), schema))
    packed = level.filter("done")
    while True:
        open_ = level.filter("not done")
        half = F.count(F.when(F.col("used") * 2 <= length, 1))
        homes, least, halves = open_.agg(F.max("home") + 1, F.min("used"), half).first()
        if not halves or homes == halves == 1:
            packed = packed.union(open_)
            break
        alone = F.col("used") > length - least
        packed = packed.union(open_.filter(alone))
        parts = -(-homes // FANIN)
        met = open_.filter(~alone).select("used", F.floor(F.col("home") / FANIN).cast("int").alias("home"), "items")
        level = work.put(met.repartition(parts, "home").mapInArrow(_pack_bins(length, full, parts), schema))
        packed = packed.union(level.filter("done"))
    seq = packed.select(F.monotonically_increasing_id().alias("sequence_id"), "items")
    return arrow_map(seq, _numbered, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)
