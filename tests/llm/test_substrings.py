import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scoreline.llm import substrings as X


def brute(rows):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone |= set(range(i, i + 35))
        out.append((str(d), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out)


def run(df, **how):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in X.remove_repeats(df, **how).collect())


def corpus(seed):
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    shared = [word(n) for n in (34, 35, 36, 50, 120, 400)]
    rows = []
    for i in range(60):
        w = word(int(rng.integers(0, 120)))
        for _ in range(int(rng.integers(0, 3))):
            s = shared[int(rng.integers(0, 6))]
            a = int(rng.integers(0, max(1, len(s) - 40)))
            w = w + s[a : a + int(rng.integers(30, 90))] + word(int(rng.integers(0, 50)))
        rows.append((i, " ".join(w)))
    rows += [(100 + k, rows[k][1]) for k in range(5)]
    return rows


@pytest.mark.parametrize("seed, how", [(0, {}), (1, {"common": 2, "piece": 7, "shard": 5}), (2, {"common": 0, "piece": 1, "shard": 1})])
def test_against_brute_force(docs, seed, how):
    """Also with anchors dealt out by window, short pieces and automata of a few passages."""
    rows = corpus(seed)
    assert run(docs(*rows, clash=True), **how) == brute(rows)


@pytest.mark.parametrize("compiled, gone", [(True, [40, 0, 0]), (False, [0, 0, 0])])
def test_automata_alone_locate(monkeypatch, compiled, gone):
    """Nothing but the automaton says where a passage stands: without it no document loses a word."""
    if not compiled:
        monkeypatch.setattr(X.PhraseAutomaton, "cover", lambda self, words: np.zeros(len(words), bool))
    w = [f"w{i}" for i in range(100)]
    named = [{"cell": 0, "base": 30, "words": " ".join(w[30:70]).encode(), "segs": [{"place": 30, "mask": 0b111111}]}]
    b = pa.record_batch([pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array([" ".join(w), " ".join(w[:60]), None]), pa.array([named, named, None])], ["row", "doc_id", "text", "named"])
    assert [x for r in X._remove(b) for x in r.column(2).to_pylist()] == gone


@pytest.mark.parametrize("mask", [0, 1, 0b1011, 0b110, (1 << 28) - 1, 0b101 << 25])
def test_runs(mask):
    assert sum(1 << k for lo, hi in X._runs(5, mask) for k in range(lo - 5, hi - 5)) == mask
    assert all(b < c for (_, b), (c, _) in zip(list(X._runs(5, mask)), list(X._runs(5, mask))[1:]))


def test_automaton_covers_every_place():
    w = [f"w{i}".encode() for i in range(200)]
    passage = b" ".join(w[50:90])
    text = w[:10] + w[50:90] + w[10:20] + w[50:90] + w[50:70]
    assert X.PhraseAutomaton({passage}).cover(text).tolist() == [False] * 10 + [True] * 40 + [False] * 10 + [True] * 40 + [False] * 20
    assert not X.PhraseAutomaton(set()).cover(text).any()


def test_texts_move_once(spark, docs):
    """Texts are put into buckets once; what later reads them has no exchange on that side."""
    got = X.remove_repeats(docs(*corpus(2)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = [x for x in plan.split("\n") if "text#" in x and "Exchange" in x]
    assert "Bucketed: true" in plan and not scan


def test_overlapping_and_repeating_words(docs):
    rows = [(1, "a " * 35), (2, "a " * 36), (3, "b " * 35), (4, "a b " * 40), (5, " ".join(map(str, range(34)))), (6, "c\t" * 20 + "\n" + "c  " * 20)]
    assert run(docs(*rows)) == brute(rows)


def test_edge_cases(docs):
    assert run(docs()) == []
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(1, None), (2, ""), (None, text), (None, text), (3, "one two"), (4, " ".join(f"y{i}" for i in range(100_000)) + " " + text)]
    assert run(docs(*rows)) == brute(rows)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    a = [b"w%d" % x for x in rng.integers(0, 50, 300)]
    at = {}
    for text in (a, [b"pre"] * 7 + a[20:200] + [b"post"] * 9):
        g, first, n = X.segments(text)
        assert n.sum() == len(text) - 34 and (n <= 28).all()
        for h, s, c in zip(g, first, n):
            for i in range(s, s + c):
                assert at.setdefault(tuple(text[i : i + 35]), h) == h


def test_query(spark, docs, table_dir):
    rows = corpus(4)
    got = {r.doc_id: r for r in X.op10_substrings(spark, table_dir(documents=docs(*rows))).collect()}
    for d, n, m, kept in brute(rows):
        r = got[int(d)]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, m, hashlib.sha256(kept.encode()).hexdigest())
