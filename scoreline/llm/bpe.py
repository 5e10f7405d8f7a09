"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled, one merge gadget after another, into a deterministic automaton over tokens that accepts a
sequence of tokens just if it is what the merges make of its bytes. It begins as one state with a loop for each
byte. The gadget for the merge of a and b takes the state q that a's arcs lead to: a copy of q without the arc b
becomes where they lead now, and from wherever a could be read, ab can be read too and leads where b led. As all
arcs of one label lead to one state, a state is a label and a time: the copies that had been made when the label
came to lead there. An arc is kept as where it was dropped, not once for each state; the arcs that encoding meets
fill a transition table.

A text is split into words as the vocabulary says, and a word is read once from left to right: from the state at
each place go the arcs whose bytes come next. Exactly one sequence of arcs reaches each place. Decoding emits the
bytes of the arcs.

Defined cases: a null or empty text has no tokens and decodes to the empty text; the vocabulary's special tokens are
found in texts, as the library's default is; a text or word of any length is encoded whole, in time in proportion to
its length; a text with characters that the splitting pattern's library and the vocabulary's may class unlike (those
unknown to Python's own tables) is split by the vocabulary's library; ids that the vocabulary lacks decode to nothing,
and bytes that are no UTF-8 to U+FFFD; rows that repeat an id are rows of their own; other columns are ignored; an
empty table gives no rows. Merges whose parts are made by later merges are refused, as then the order of merging
would matter.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, blocks, table
from .packing import byte_of

VOCABULARY = "byte_bpe_50k.json"
#: White space as the splitting pattern understands it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Words and chunks that a Python worker remembers, at most; one of over ``WORD`` characters is not remembered.
REMEMBERED, WORD = 1 << 18, 48
#: Transitions that a worker's table holds, at most.
ARCS = 1 << 20
#: Characters of a text that are split at once, or more up to the next end of a word.
SEGMENT = 1 << 18


class Automaton:
    """``byte``: the id of each byte's token; ``merges``: (left, right, merged) ids in order."""

    def __init__(self, byte: dict[int, int], merges: list[tuple[int, int, int]]):
        self.label = {i: bytes([b]) for b, i in byte.items()}
        self.born, self.left, self.right = dict.fromkeys(self.label, 0), {}, {}
        self.dropped: dict[tuple[int, int], int] = {}
        self.now = 0
        #: Where a label's arcs lead: the label whose copies count, and up to when they do.
        self.leads: dict[int, tuple[int, int]] = {}
        waiting = set()
        for a, b, ab in merges:
            if ab in self.label or ab in waiting:
                raise ValueError(f"two merges make token {ab}")
            if a in self.label and b in self.label:
                self._merge(a, b, ab)
            elif {a, b} <= {*self.label, *waiting}:
                waiting.add(ab)  # a part of it can never be read
            else:
                raise ValueError(f"the merge that makes token {ab} comes before one that makes its part")
        states = dict.fromkeys([None])  # the first state; then those that arcs lead to
        for x in self.label:
            states[self._target(x)] = None
        self.states = list(states)
        number = {s: k for k, s in enumerate(self.states)}
        self.target = {x: number[self._target(x)] for x in self.label}
        self.arcs: dict[int, int] = {}
        self.width = max(self.label, default=0) + 1
        self.root = self._trie()
        self.length = {x: len(s) for x, s in self.label.items()}
        self.longest = max(self.length.values(), default=0)

    def _merge(self, a: int, b: int, ab: int) -> None:
        """The gadget: nothing to do if b cannot follow a; else b is dropped after a, and ab leads where b leads now."""
        self.now += 1
        if not self._has((a, self.now - 1), b):
            return
        self.label[ab] = self.label[a] + self.label[b]
        self.born[ab], self.left[ab], self.right[ab] = self.now, a, b
        self.dropped[a, b] = self.now

    def _target(self, x: int) -> tuple[int, int] | None:
        """The state that x leads to, under the name of the last copy it consists of; None for the first state."""
        time, last = self.now, self._last_copy()
        while x is not None:
            if (k := max((t for t in last.get(x, ()) if t <= time), default=0)) > 0:
                return x, k
            time, x = min(time, self.born[x] - 1), self.right.get(x)
        return None

    def _last_copy(self) -> dict[int, list[int]]:
        if getattr(self, "_copies_at", None) != self.now:
            self._copies: dict[int, list[int]] = {}
            for (a, _), t in self.dropped.items():
                self._copies.setdefault(a, []).append(t)
            self._copies_at = self.now
        return self._copies

    def _has(self, state: tuple[int, int] | None, x: int) -> bool:
        """Whether the state has an arc x: not if a copy that it consists of has dropped x; else x came to be with the
        arc of its left part, so that this one tells, in the state as it was then."""
        dropped, born, right = self.dropped, self.born, self.right
        while state is not None:
            o, t = state
            while o is not None:
                if dropped.get((o, x), t + 1) <= t:
                    return False
                t, o = min(t, born[o] - 1), right.get(o)
            o, t = state
            if not born[x]:
                return True
            t = min(t, born[x])
            while o is not None and born[o] > t:
                o = right.get(o)
            state, x = None if o is None else (o, t), self.left[x]
        return True

    def step(self, state: int, x: int) -> int:
        """The state after the arc x; -1 if there is none."""
        key = state * self.width + x
        if (to := self.arcs.get(key)) is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            to = self.arcs[key] = self.target[x] if self._has(self.states[state], x) else -1
        return to

    def _trie(self) -> dict:
        """The labels by byte: a node is the token that ends there, or -1, and what comes below."""
        root: dict[int, tuple[int, dict]] = {}
        for x, label in sorted(self.label.items(), key=lambda i: len(i[1])):  # no label comes after one that it begins
            node = root
            for c in label[:-1]:
                if c not in node:
                    node[c] = (-1, {})
                node = node[c][1]
            node[label[-1]] = (x, node[label[-1]][1] if label[-1] in node else {})
        return root

    def encode(self, word: bytes) -> list[int]:
        """The one way through the automaton, longer arcs tried first. A place that has been left again is not entered
        twice, as one sequence of arcs alone leads there."""
        root, arcs, width, longest, length = self.root, self.arcs, self.width, self.longest, self.length
        n, at, state, ids, way, dead = len(word), 0, 0, [], [], set()
        tries: list[int] | None = None
        while at < n:
            if tries is None:
                below, tries = root, []
                for c in word[at : at + longest]:
                    if (node := below.get(c)) is None:
                        break
                    x, below = node
                    if x >= 0:
                        tries.append(x)
            while tries:
                x = tries.pop()
                if (to := arcs.get(state * width + x)) is None:
                    to = self.step(state, x)
                if to >= 0 and (not dead or at + length[x] not in dead):
                    way.append((state, tries))
                    ids.append(x)
                    at, state, tries = at + length[x], to, None
                    break
            else:
                dead.add(at)
                at -= length[ids.pop()]
                state, tries = way.pop()
        return ids


class Unsure(Exception):
    """A chunk has characters that libraries may class unlike."""


class Remembered(dict):
    """What a function makes of strings, made when they are first met. When it is full, what it holds becomes the older
    half, from which strings that are met again come back."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        if (got := self.older.get(key)) is None:
            got = self.make(key)
        if len(key) <= WORD:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[key] = got
        return got


class Codec:
    """Encoder and decoder of one vocabulary file, a path."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        model = found["model"]
        plain = {"dropout": None, "unk_token": None, "ignore_merges": False, "byte_fallback": False}
        kind, split = model.get("type", "BPE"), found["pre_tokenizer"] or {}
        unlike = [k for k, v in plain.items() if model.get(k, v) != v]
        if kind != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or found["normalizer"] or unlike:
            raise ValueError(f"{path} is no plain byte-level BPE")
        byte, vocab = byte_of(), model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = Automaton({b: vocab[c] for c, b in byte.items()}, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        special = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.label = self.automaton.label | {i: s.encode() for s, i in special.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.label}
        self.special = {s: self.packed[i] for s, i in special.items()}
        by_length = sorted(map(regex.escape, special), key=len, reverse=True)
        self.specials = regex.compile("|".join(by_length)) if special else None
        self.split, self.end = regex.compile(pattern).findall, re.compile(f"[^{WHITE}](?=[{WHITE}])")
        self.chunks = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+").findall
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.of_word, self.of_chunk = Remembered(self._word), Remembered(self._chunk)

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.automaton.encode(word.encode())))

    def _chunk(self, chunk: str) -> bytes:
        """What lies between two white spaces, the one before it included: words never go beyond."""
        if (chunk[1:] if chunk[0] == " " else chunk).isalpha():  # one word
            return self._word(chunk)
        if not chunk.isascii() and any(unicodedata.category(c) == "Cn" for c in chunk):
            raise Unsure
        return b"".join(map(self.of_word.__getitem__, self.split(chunk)))

    def _segments(self, text: str) -> Iterator[str]:
        """A long text in parts that end where a word does: before white space that follows something else."""
        at = 0
        while len(text) - at > SEGMENT and (m := self.end.search(text, at + SEGMENT)):
            yield text[at : m.end()]
            at = m.end()
        yield text[at:] if at else text

    def _ordinary(self, text: str) -> Iterator[bytes]:
        for part in self._segments(text):
            try:
                yield b"".join(map(self.of_chunk.__getitem__, self.chunks(part)))
            except Unsure:
                spans = (span for _, span in self.library.pre_tokenize_str(part))
                yield b"".join(self.of_word[part[a:b]] for a, b in spans)

    def encode(self, text: str) -> bytes:
        """The ids, each as a little-endian unsigned 32-bit number."""
        if self.specials is None or not (found := list(self.specials.finditer(text))):
            return b"".join(self._ordinary(text))
        out, at = [], 0
        for m in found:
            out += [*self._ordinary(text[at : m.start()]), self.special[m.group()]]
            at = m.end()
        return b"".join([*out, *self._ordinary(text[at:])])

    def decode(self, ids: bytes) -> str:
        label = self.label
        return b"".join([label.get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@cache
def codec(path: str, pattern: str | None = None) -> Codec:
    """One codec for each file and Python worker. ``path`` is a file, or the name of a public vocabulary."""
    import public_tokenizers

    return Codec(path if "/" in path else public_tokenizers.path(path), pattern or public_tokenizers.PATTERN)


def _mapped(df: DataFrame, name: str, new: str, kind: pa.DataType, fn: Callable) -> DataFrame:
    """``fn`` of the column ``name`` as a further column ``new``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, 256):
            at = b.schema.get_field_index(name)
            made = pa.array([fn(x) for x in b.column(at).to_pylist()], kind)
            yield pa.record_batch([*b.columns, made], [*b.schema.names, new])

    from pyspark.sql.types import BinaryType, StringType, StructType

    schema = StructType([*df.schema.fields]).add(new, BinaryType() if kind == pa.binary() else StringType())
    return arrow_map(df, run, schema)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids): a document's tokens, each a little-endian unsigned 32-bit number, as token files hold them.

    Scale: no shuffle. A Python worker compiles the automaton once and remembers a bounded number of words; what a
    task holds besides is a block of 256 texts and their ids.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return _mapped(rows, "text", "ids", pa.binary(), lambda t: codec(vocabulary).encode(t)).drop("text")


def decode(coded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, text) of the tokens that ``encode`` has made; null is the empty text."""
    rows = coded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return _mapped(rows, "ids", "text", pa.string(), lambda x: codec(vocabulary).decode(x))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode(encode(table(spark, sf_dir, "documents", "doc_id", "text")))
    n_tokens = F.octet_length("ids").cast("long") / 4
    return done.select(
        "doc_id",
        n_tokens.cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
