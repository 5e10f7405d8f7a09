import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreline.llm import bpe as X

HARD = ["", " ", "<|endoftext|> a", "a<|endoftext|><|endoftext|>b <|endoftext", "​ \x85 x\r\n\n  y ", "don't I'LL 12345 \xbd\xb3", "日本語 한국어 عربى", "\U0001f468‍\U0001f469 ok", "\x00\x01\x1c\x1f x", "İıſK", "a ՘b \U00010940 c", "x   y\xa0 \xa0z"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(X.VOCABULARY))


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def merged(word, merges):
    """Merges as they are defined: again and again the first of them that applies, at the leftmost place."""
    ts = list(word)
    while hits := [(k, i) for i in range(len(ts) - 1) for k, (a, b, _) in enumerate(merges) if (ts[i], ts[i + 1]) == (a, b)]:
        k, i = min(hits)
        ts[i : i + 2] = [merges[k][2]]
    return ts


def trained(rng, letters, n):
    """Merges in the order in which training could have found them: each is of two tokens that follow each other."""
    byte, merges = {97 + i: i for i in range(letters)}, []
    while len(merges) < n:
        ts = merged([byte[97 + rng.randrange(letters)] for _ in range(14)], merges)
        pairs = [p for p in itertools.pairwise(ts) if p not in {m[:2] for m in merges}]
        new = {m[2]: m for m in merges}
        if pairs:
            a, b = rng.choice(pairs)
            spell = lambda t: spell(new[t][0]) + spell(new[t][1]) if t in new else [t]
            if spell(a) + spell(b) not in [spell(t) for t in new]:
                merges.append((a, b, letters + len(merges)))
    return byte, merges


@pytest.mark.parametrize("seed", range(12))
def test_automaton_accepts_what_merging_gives_and_nothing_else(seed):
    rng = random.Random(seed)
    letters = rng.choice([1, 2, 3])
    byte, merges = trained(rng, letters, {1: 3, 2: 8, 3: 14}[letters])
    a = X.Automaton(byte, merges)
    ways = {b"": [((), 0)]}  # all accepted sequences of a word
    for n in range(1, 9 if letters < 3 else 7):
        for word in map(bytes, itertools.product(byte, repeat=n)):
            ways[word] = [(w + (x,), to) for k in range(n) for w, s in ways[word[:k]] for x, label in a.label.items() if label == word[k:] and (to := a.step(s, x)) >= 0]
            want = merged([byte[c] for c in word], merges)
            assert [list(w) for w, _ in ways[word]] == [want] == [a.encode(word)]


def test_equal_halves_merge_from_the_left():
    a = X.Automaton({97: 0}, [(0, 0, 1), (1, 1, 2)])
    assert a.encode(b"a" * 7) == [2, 1, 0] and len(a.states) <= 3


def test_improper_merges_are_refused():
    with pytest.raises(ValueError, match="before"):
        X.Automaton({97: 0, 98: 1}, [(2, 1, 3), (0, 0, 2)])
    with pytest.raises(ValueError, match="two merges"):
        X.Automaton({97: 0}, [(0, 0, 1), (1, 0, 2), (0, 1, 2)])


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text_encodes_and_decodes_as_the_library_does(library, text):
    got, want = X.codec(X.VOCABULARY).encode(text), library.encode(text, add_special_tokens=False).ids
    assert ids(got) == want and X.codec(X.VOCABULARY).decode(got) == library.decode(want, skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50_300), max_size=12))
def test_any_ids_decode_as_the_library_does(library, some):
    known = [i for i in some if i <= 50_256]
    assert X.codec(X.VOCABULARY).decode(np.array(some, "<u4").tobytes()) == library.decode(known, skip_special_tokens=False)


@pytest.mark.parametrize("text", [*HARD, *(c * 2_000_000 for c in " \n\t\xa0"), "a" * 100_000, "=-" * 50_000, "\U0001f600" * 20_000])
def test_hard_texts(library, text):
    assert ids(X.codec(X.VOCABULARY).encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_every_assigned_character_is_classed_as_the_library_does():
    """Chunks and segments end where words do, so that all of them together are words of the whole text."""
    c = X.codec(X.VOCABULARY)
    for lo in range(0, 0x30000, 512):
        text = "".join(f"a{chr(i)}1{chr(i)}! {chr(i)}" for i in range(lo, lo + 512) if not 0xD800 <= i < 0xE000 and X.unicodedata.category(chr(i)) != "Cn")
        assert [w for k in c.chunks(text) for w in c.split(k)] == c.split(text) == [text[a:b] for _, (a, b) in c.library.pre_tokenize_str(text)]


def test_long_texts_in_segments(monkeypatch):
    monkeypatch.setattr(X, "SEGMENT", 7)
    c, rng = X.codec(X.VOCABULARY), random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("ab1'! \n՘\xa0") for _ in range(40))
        parts = list(c._segments(text))
        assert "".join(parts) == text and [w for p in parts for w in c.split(p)] == c.split(text)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(X, "REMEMBERED", 3)
    monkeypatch.setattr(X, "ARCS", 5)
    import public_tokenizers

    c = X.Codec(public_tokenizers.path(X.VOCABULARY), public_tokenizers.PATTERN)
    text = "some words that are met again and again, and some words that are not"
    assert c.decode(c.encode(text)) == text and len(c.of_word) <= 3 and len(c.of_chunk) <= 3 and len(c.automaton.arcs) <= 5


def test_query(spark, docs, table_dir, library):
    texts = [None, "", *HARD, "word " * 60_000, "same", "same"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "again")]
    got = X.op12_bpe(spark, table_dir(documents=docs(*rows, clash=True))).collect()
    want = []
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        sha = hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()
        want.append((i, len(e), sha, hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_table(spark, docs, table_dir):
    assert X.op12_bpe(spark, table_dir(documents=docs())).collect() == []


def test_round_trip_through_both_operators(docs):
    rows = [(1, "a b"), (2, None), (3, "x<|endoftext|>y")]
    coded = X.encode(docs(*rows))
    assert {r.doc_id: r.text for r in X.decode(coded).collect()} == {1: "a b", 2: "", 3: "x<|endoftext|>y"}
    assert {r.doc_id: len(r.ids) // 4 for r in coded.collect()} == {1: 2, 2: 0, 3: 3}
