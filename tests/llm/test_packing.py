import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreline.llm import packing as X


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda s: t.encode(s, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_both_libraries_encode_alike(reference, text):
    assert X.encoder()([text])[0] == reference(text)


@pytest.mark.parametrize("text", ["<|endoftext|> a", "end <|endoftext|> of text", "a<|endoftext|><|endoftext|>b <|endoftext", "​ \x85 x\r\n\n  y ", "don't I'LL 12345 ½³", "日本語 한국어 عربى", "\U0001f468‍\U0001f469‍\U0001f467 ok", "a" * 5000, " " * 3000, "\x00\x01", "İıſK"])
def test_hard_texts_encode_alike(reference, text):
    assert X.encoder()([text])[0] == reference(text)


@pytest.mark.parametrize("space", [" ", "\n", "\t", "\xa0", "\r\n", "\u3000"])
def test_long_runs_of_white_space_encode_alike(reference, space):
    text = "a" + space * 2_000_000 + "b"
    assert X.encoder()([text, "c"]) == [reference(text), reference("c")]


def test_a_long_run_stops_no_job(docs):
    rows = [(i, "some words") for i in range(29)] + [(29, "x" + "\n" * 1_200_000)]
    got = X.pack(docs(*rows)).groupBy("doc_id").sum("length").collect()
    assert len(got) == 30 and min(r[1] for r in got) == 3


@given(st.integers(1, 10_000))
def test_cut(n):
    got = X.cut(n)
    assert sum(k for _, k in got) == n and all(k == 2048 for _, k in got[1:]) and 0 < got[0][1] <= 2048
    assert [s for s, _ in got] == list(np.cumsum([0, *[k for _, k in got[:-1]]]))


@given(st.lists(st.integers(1, 100), max_size=60))
def test_best_fit(sizes):
    bins = X.best_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= 1.5 * math.ceil(sum(sizes) / 100) + 1


@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_best_fit_against_the_optimum(sizes):
    """At most one bin above what trying all ways gives."""

    def least(left, bins):
        if not left:
            return len(bins)
        tries = {b for b in bins if b + left[0] <= 12}
        ways = [least(left[1:], [*[x for k, x in enumerate(bins) if k != bins.index(b)], b + left[0]]) for b in tries]
        return min([*ways, least(left[1:], [*bins, left[0]])])

    assert len(X.best_fit(sizes, 12)) <= least(sorted(sizes, reverse=True), []) + 1


def test_lone_large_pieces_leave_at_the_first_level(spark, docs, monkeypatch):
    """Pieces of 1,025 to 2,039 tokens never share a bin: none goes up the tree, with or without a short one."""
    met, plain = [], X._pack_bins
    monkeypatch.setattr(X, "_pack_bins", lambda length, full, groups: met.append(groups) or plain(length, full, groups))
    texts = [(i, " a" * (1024 + i)) for i in range(1000)]
    assert len({r.sequence_id for r in X.pack(docs(*texts).repartition(20)).collect()}) == 1000 and not met
    rows = X.pack(docs(*texts, (5000, "b"), (5001, "c d")).repartition(20)).collect()
    assert len({r.sequence_id for r in rows}) == 1000


def test_few_bins_go_up(spark):
    """A group sends up its one half-empty bin and no more others than there are groups."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    sizes = [int(x) for x in rng.integers(1100, 2000, 500)] + [40, 700]
    items = [[{"doc_id": i, "piece": 0, "start": 0, "length": n, "ids_crc32": 0}] for i, n in enumerate(sizes)]
    t = pa.table({"used": pa.array(sizes, pa.int32()), "home": pa.array([3] * len(sizes), pa.int32()), "items": items})
    got = X._pack(t, 3, 2048, 2040, 8).to_pydict()
    assert got["done"].count(False) <= 9 and sorted(x["doc_id"] for b in got["items"] for x in b) == list(range(502))


def test_groups_of_a_partition_meet(spark, docs, monkeypatch):
    monkeypatch.setattr(X, "GROUP", 5)
    rows = X.pack(docs(*[(i, "a b c d") for i in range(103)]).coalesce(1)).collect()
    assert len(rows) == 103 and len({r.sequence_id for r in rows}) == 1


def verify(rows, texts, reference):
    """Exact round trip: each text's ids come back, whole, from its pieces; sequences have no gaps."""
    seqs, per = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
        per[r.doc_id].append(r)
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= X.LENGTH
    for doc, t in texts:
        ids = np.array([*reference(t or ""), 0], "<u4")
        mine = sorted((r for r in per[doc]), key=lambda r: r.piece)
        assert [(r.start, r.length) for r in mine] == X.cut(len(ids)) and [r.piece for r in mine] == list(range(len(mine)))
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine]
    return len(seqs)


def test_round_trip(spark, docs, reference):
    rng = np.random.default_rng(0)
    texts = [(i, " ".join(rng.choice(["alpha", "beta", "Gamma!", "12"], int(n)))) for i, n in enumerate(rng.exponential(600, 300))]
    texts += [(1000, None), (1001, ""), (1002, "long words " * 20_000)]
    rows = X.pack(docs(*texts, clash=True).repartition(4)).collect()
    n = verify(rows, texts, reference)
    total = sum(r.length for r in rows)
    assert n <= math.ceil(total / X.LENGTH) * 1.02 + 1


def test_few_sequences_on_the_table(spark):
    rows = X.op7_packing(spark, "/root/testdata/sf0.01").collect()
    assert len({r.sequence_id for r in rows}) <= math.ceil(sum(r.length for r in rows) / X.LENGTH) * 1.01 + 1


def test_edge_cases(spark, docs):
    assert X.pack(docs()).count() == 0
    got = X.pack(docs((1, "a"), (1, "a"), (None, "b"))).collect()
    assert len(got) == 3 and len({r.sequence_id for r in got}) == 1
