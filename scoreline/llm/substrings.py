"""Substring deduplication by repeated-phrase automata.

A window is 35 consecutive words. Windows that recur are found without comparing all of them: of the 8-word
phrases in a window the one of the smallest hash is its anchor, so equal windows have equal anchors; consecutive
windows of one anchor form a segment, and only segments whose anchor recurs are looked at. Those of one anchor are
compared, equal ones by a digest, others word for word, which confirms the windows that recur; runs of them are the
passages, their words taken from one of the documents that hold them. Each shard of documents compiles the passages
that its segments name into an Aho-Corasick automaton over word symbols and streams its whole documents through it,
which locates every occurrence; each word covered by one is removed.

Defined cases: a null or empty text has no words; texts of fewer than 35 words stay; a text of any length is
read whole; windows of one text may overlap each other and still recur; rows equal in doc_id and text are
documents of their own; ties of anchors go to the first place; columns but doc_id and text are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import Workspace, arrow_map, blocks, raw, table

WINDOW, ANCHOR = 35, 8
#: Distinct segments of one anchor that are compared in one task; those of a more common anchor are dealt out by window.
COMMON = 2_000
#: Windows in a piece of words that moves, and pieces that one automaton takes, the last document's on top.
PIECE, SHARD = 64, 2_000

_MIX = np.array([0x9E3779B97F4A7C15 * (2 * j + 1) % 2**64 | 1 for j in range(64)], np.uint64)


def segments(words: list[bytes], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows) of each run of windows with the same anchor place."""
    n = len(words) - window + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    m = len(words) - anchor + 1
    g = np.zeros(m, np.uint64)
    for j in range(anchor):
        g += h[j : j + m] * _MIX[j]
    g ^= g >> np.uint64(31)
    g *= _MIX[11]
    span = window - anchor + 1
    at = np.empty(n, np.int64)
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        at[lo:hi] = np.arange(lo, hi) + np.lib.stride_tricks.sliding_window_view(g[lo : hi + span - 1], span).argmin(1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return g[at[first]].view(np.int64), first, np.diff(np.r_[first, n])


def _anchors(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for c in blocks(b, 512):
        got = [segments(t.split())[0] for t in raw(c, "text")]
        offs = np.r_[0, np.cumsum([len(x) for x in got])].astype(np.int32)
        flat = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(got)))
        yield pa.record_batch([c.column(0), c.column(1), c.column(2), flat], ["row", "doc_id", "text", "anchors"])


def _segments(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(row, anchor, digest, place, windows) of segments of recurring anchors; the digest stands for the words."""
    for c in blocks(b, 256):
        row, a, dg, at, nw = [], [], [], [], []
        for t, r, keep in zip(raw(c, "text"), c.column(0).to_pylist(), c.column(2)):
            words = t.split()
            anchor, first, n = segments(words)
            for i in np.flatnonzero(np.isin(anchor, keep.values.to_numpy(zero_copy_only=False))):
                row.append(r)
                a.append(anchor[i])
                dg.append(xxhash.xxh3_64_intdigest(b" ".join(words[first[i] : first[i] + n[i] + WINDOW - 1])))
                at.append(first[i])
                nw.append(n[i])
        digest = pa.array(np.array(dg, np.uint64).view(np.int64))
        yield pa.record_batch([pa.array(row, pa.int64()), pa.array(a, pa.int64()), digest, pa.array(at, pa.int32()), pa.array(nw, pa.int32())], ["row", "anchor", "digest", "place", "windows"])


def _words(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Asked segments of documents, with their words."""
    for c in blocks(b, 256):
        out = []
        for t, r, asked in zip(raw(c, "text"), c.column(0).to_pylist(), c.column(2).to_pylist()):
            words = t.split()
            out += [{**x, "row": r, "words": b" ".join(words[x["place"] : x["place"] + x["windows"] + WINDOW - 1])} for x in asked]
        cols = {"anchor": pa.int64(), "digest": pa.int64(), "n": pa.int64(), "m": pa.int64(), "row": pa.int64(), "place": pa.int32(), "words": pa.binary()}
        yield pa.record_batch([pa.array([x[k] for x in out], kind) for k, kind in cols.items()], list(cols))


def confirm(units: list[tuple[bytes, int]]) -> list[list[bool]]:
    """One anchor's distinct segments, as (words, count): for each, which of its windows recur, word for word."""
    seen: Counter[tuple[bytes, ...]] = Counter()
    split = []
    for words, n in units:
        w = words.split(b" ")
        split.append([tuple(w[i : i + WINDOW]) for i in range(len(w) - WINDOW + 1)])
        for x in split[-1]:
            seen[x] += n
    return [[seen[x] > 1 for x in windows] for windows in split]


MASKS = "anchor long, digest long, row long, place int, lo int, hi int, mask long"


def _confirm_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, digest, row, place, n, words) come sorted by anchor, a bounded number of each. What stands once
    is told by its windows; what stands twice recurs as a whole and only serves to compare."""
    held, out = [], []

    def flush():
        for (a, d, r, p, n, _), recurs in zip(held, confirm([(x[5], x[4]) for x in held])):
            if n == 1 and any(recurs):
                at = np.flatnonzero(recurs)
                out.append((a, d, r, p, at[0], at[-1], sum(1 << int(k) for k in at)))
        held.clear()

    def made():
        cols = list(zip(*out)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], ["anchor", "digest", "row", "place", "lo", "hi", "mask"])

    for b in batches:
        for x in zip(*(b.column(i).to_pylist() for i in range(6))):
            if held and x[0] != held[0][0]:
                flush()
            held.append(x)
        yield made()
        out.clear()
    flush()
    yield made()


def _windows(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The windows of segments, each for itself, as hashes of 128 bits."""
    for c in blocks(b, 512):
        at, k, wd = [], [], []
        for j, words in enumerate(c.column(5).to_pylist()):
            w = words.split(b" ")
            for i in range(len(w) - WINDOW + 1):
                at.append(j)
                k.append(i)
                wd.append(xxhash.xxh3_128_digest(b" ".join(w[i : i + WINDOW])))
        own = [c.column(i).take(pa.array(at, pa.int64())) for i in range(5)]
        yield pa.record_batch([*own, pa.array(k, pa.int32()), pa.array(wd, pa.binary())], ["anchor", "digest", "row", "place", "n", "k", "window"])


def _pieces(b: pa.RecordBatch, piece: int) -> Iterator[pa.RecordBatch]:
    """The words that documents' confirmed windows cover, cut at every ``piece``-th window, so that who needs some of
    them gets little more: (from, cell, base, words), base the first window in it."""
    for c in blocks(b, 256):
        row, cell, base, out = [], [], [], []
        for t, r, masks in zip(raw(c, "text"), c.column(0).to_pylist(), c.column(2).to_pylist()):
            words = t.split()
            ends: dict[int, list[int]] = {}
            for x in masks:
                for lo, hi in _runs(x["place"], x["mask"]):
                    for k in range(lo // piece, (hi - 1) // piece + 1):
                        e = ends.setdefault(k, [hi, lo])
                        e[0], e[1] = min(e[0], max(lo, k * piece)), max(e[1], min(hi, (k + 1) * piece))
            for k, (lo, hi) in ends.items():
                row.append(r)
                cell.append(k)
                base.append(lo)
                out.append(b" ".join(words[lo : hi - 1 + WINDOW]))
        yield pa.record_batch([pa.array(row, pa.int64()), pa.array(cell, pa.int32()), pa.array(base, pa.int32()), pa.array(out, pa.binary())], ["from", "cell", "base", "words"])


def _runs(place: int, mask: int) -> Iterator[tuple[int, int]]:
    """Runs of set bits as (first, end), counted from ``place``."""
    while mask:
        low = (mask & -mask).bit_length() - 1
        n = (~(mask >> low) & ((mask >> low) + 1)).bit_length() - 1
        yield place + low, place + low + n
        mask &= -1 << low + n


def passages(named: list[dict], piece: int) -> set[bytes]:
    """The passages that a document's segments name: the words of each run of confirmed windows of a segment, out of
    the pieces that hold them."""
    out = set()
    for x in named:
        words, base, k = x["words"].split(b" "), x["base"], x["cell"]
        for seg in x["segs"]:
            for lo, hi in _runs(seg["place"], seg["mask"]):
                lo, hi = max(lo, k * piece), min(hi, (k + 1) * piece)
                if lo < hi:
                    out.add(b" ".join(words[lo - base : hi - base - 1 + WINDOW]))
    return out


class PhraseAutomaton:
    """Aho-Corasick over word symbols: a word of some passage is one character, any other word is one that no
    passage has."""

    def __init__(self, passages: set[bytes]):
        import ahocorasick

        self.symbol: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in passages:
            self.automaton.add_word("".join(map(self._known, p.split(b" "))))
        if passages:
            self.automaton.make_automaton()

    def _known(self, word: bytes) -> str:
        if (c := self.symbol.get(word)) is None:
            k = len(self.symbol) + 1
            c = self.symbol[word] = chr(k if k < 0xD800 else k + 0x800)
        return c

    def cover(self, words: list[bytes]) -> np.ndarray:
        """Which words lie in a passage, wherever one stands in the text."""
        edge = np.zeros(len(words) + 1, np.int64)
        if len(self.automaton):
            get = self.symbol.get
            for end, length in self.automaton.iter("".join([get(w, "\0") for w in words])):
                edge[end - length + 1] += 1
                edge[end + 1] -= 1
        return np.cumsum(edge[:-1]) > 0


def _shards(b: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive documents with about ``most`` pieces, or one document with more."""
    n = np.diff(np.asarray(b.column(3).offsets)) if b.num_rows else np.empty(0, int)
    shard = np.cumsum(n) // most
    cut = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)]
    for lo, hi in zip(cut[:-1], cut[1:]):
        yield b.slice(int(lo), int(hi - lo))


def _remove(b: pa.RecordBatch, shard: int = SHARD, piece: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Compiles each shard's passages and streams its documents through; a document that names none can hold none."""
    for c in _shards(b, shard):
        named = c.column(3).to_pylist()
        automaton = PhraseAutomaton(set().union(*(passages(x, piece) for x in named if x)))
        total, gone, kept = [], [], []
        for t, x in zip(raw(c, "text"), named):
            words = t.split()
            total.append(len(words))
            if x:
                words = [w for w, covered in zip(words, automaton.cover(words).tolist()) if not covered]
            gone.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.record_batch([c.column(1), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def _at(texts: DataFrame, asked: DataFrame, by: str, *fields: str) -> DataFrame:
    """(row, text, list of ``fields``) of the documents that ``asked`` names, texts where they lie."""
    lists = asked.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias(by))
    return texts.select("row", "text").join(lists.hint("shuffle_hash"), "row").select("row", "text", by)


def confirmed(texts: DataFrame, distinct: DataFrame, work: Workspace, common: int) -> DataFrame:
    """Of each distinct segment (anchor, digest) that recurs, whole or in part, one place where it stands and the
    windows in it that recur."""
    whole = distinct.filter("n > 1").selectExpr("anchor", "digest", "row", "place", "0 as lo", "windows - 1 as hi", "shiftleft(1L, windows) - 1 as mask")
    several = distinct.groupBy("anchor").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 and least = 1")
    asked = distinct.join(several.select("anchor", "m"), "anchor")
    fields = ("anchor", "digest", "n", "m", "place", "windows")
    compared = work.put(arrow_map(_at(texts, asked, "asked", *fields), _words, "anchor long, digest long, n long, m long, row long, place int, words binary"))
    cols = ("anchor", "digest", "row", "place", "n", "words")
    dealt = compared.filter(F.col("m") <= common).select(*cols).repartition("anchor").sortWithinPartitions("anchor")
    single = arrow_map(compared.filter(F.col("m") > common).select(*cols), _windows, "anchor long, digest long, row long, place int, n long, k int, window binary")
    hot = single.groupBy("window").agg(F.sum("n").alias("n")).filter("n > 1").select("window")
    spread = single.filter("n = 1").join(hot, "window").groupBy("anchor", "digest").agg(F.first("row").alias("row"), F.first("place").alias("place"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.expr("bit_or(shiftleft(1L, k))").alias("mask"))
    out = work.put(whole.union(dealt.mapInArrow(_confirm_sorted, MASKS)).union(spread))
    work.drop(compared)
    return out


def remove_repeats(docs: DataFrame, work: Workspace | None = None, common: int = COMMON, piece: int = PIECE, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): texts without the words of windows that also start elsewhere.

    Scale: whole texts move once, into buckets by row, with their anchors: one word in fourteen has one. All later
    steps that need texts read them in their buckets; what moves is anchors, digests of segments, and the words of
    passages, once to each document that holds some of them. Equal segments are summed on the map side; an anchor of
    more than ``common`` different segments is dealt out by window. An automaton holds about ``shard`` pieces, or
    those of one document.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "substrings")
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = work.put_bucketed(arrow_map(keyed, _anchors, "row long, doc_id long, text string, anchors array<bigint>"), "row")
    twice = texts.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    once = texts.select("row", F.explode(F.array_distinct("anchors")).alias("anchor"))
    mine = once.join(twice.hint("shuffle_hash"), "anchor")
    found = work.put(arrow_map(_at(texts, mine, "keep", "anchor").withColumn("keep", F.col("keep.anchor")), _segments, "row long, anchor long, digest long, place int, windows int"))
    first = F.min(F.struct("row", "place", "windows")).alias("x")
    distinct = work.put(found.groupBy("anchor", "digest").agg(F.count("*").alias("n"), first).select("anchor", "digest", "n", "x.*"))
    masks = confirmed(texts, distinct, work, common)
    work.drop(distinct)
    pieces = work.put(arrow_map(_at(texts, masks, "masks", "place", "mask"), lambda b: _pieces(b, piece), "from long, cell int, base int, words binary"))
    cells = F.expr(f"explode(sequence(int((place + lo) div {piece}), int((place + hi) div {piece})))").alias("cell")
    held = masks.select("anchor", "digest", F.col("row").alias("from"), "place", "mask", cells)
    named = found.select("row", "anchor", "digest").distinct().join(held, ["anchor", "digest"])
    named = named.groupBy("row", "from", "cell").agg(F.collect_list(F.struct("place", "mask")).alias("segs"))
    hits = work.put(named.join(pieces, ["from", "cell"]).groupBy("row").agg(F.collect_list(F.struct("cell", "base", "words", "segs")).alias("named")))
    work.drop(found, masks, pieces)
    last = texts.select("row", "doc_id", "text").join(hits.hint("shuffle_hash"), "row", "left").select("row", "doc_id", "text", "named")
    return arrow_map(last, lambda b: _remove(b, shard, piece), "doc_id long, n_words long, n_removed long, kept string")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = {
    "op10_substrings": r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select rid, i, md5(array_to_string(w[i : i + 34], ' ')) as h from (select rid, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35) x),
r as (select rid, i from (select rid, i, count(*) over (partition by h) as n from g) x where n > 1),
c as (select distinct rid, i + j as p from r, (select unnest(range(35)) as j) k),
p as (select rid, unnest(range(1, len(w) + 1)) as p, unnest(w) as s from d)
select d.doc_id, len(d.w) as n_words, count(c.p) as n_removed, sha256(coalesce(string_agg(p.s, ' ' order by p.p) filter (c.p is null), '')) as kept_sha256
from d left join p on d.rid = p.rid left join c on p.rid = c.rid and p.p = c.p group by d.rid, d.doc_id, d.w""",
}
