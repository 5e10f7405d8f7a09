import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreline.llm import mixing as X


def test_targets_share_by_weight_up_to_the_limit():
    got = X.targets([1000, 100, 10], [5, 2, 1])
    assert got[1:] == [300.0, 30.0] and got[0] == 780.0
    assert sum(X.targets([10, 10, 10], [5, 2, 1])) == pytest.approx(30)
    assert X.targets([0, 0], [5, 2]) == [0.0, 0.0] and X.targets([], []) == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 6), min_size=1, max_size=8), st.integers(0, 400), st.sampled_from([0, 40, 1 << 16]))
def test_fit_against_all_sums(counts, budget, window):
    """With the whole budget in the dynamic program the best sum not above it is reached; else it comes near."""
    sizes, n = np.array(sorted(counts)), np.array([counts[s] for s in sorted(counts)])
    reach = {0}
    for s, k in counts.items():
        reach |= {r + s * j for r in reach for j in range(k + 1)}
    take = X.fit(sizes, n, budget, window)
    total = int((take * sizes).sum())
    assert (take >= 0).all() and (take <= n).all() and total <= budget
    best = max(r for r in reach if r <= budget)
    assert total == best if window > budget else total >= best - 2 * sizes.max()


def test_mix(spark, docs):
    rng = np.random.default_rng(1)
    rows = [{"doc_id": i, "text": "w " * int(rng.integers(0, 60)), "source": ["a", "b", "c", None][min(3, int(rng.exponential(1)))]} for i in range(800)]
    df = docs(*rows, clash=True)
    got = X.mix(df).collect()
    assert sorted(r.doc_id for r in got) == list(range(800))
    src = {r["doc_id"]: r["source"] for r in rows}
    want = {s: sum(r["text"].count("w") for r in rows if r["source"] == s) for s in ("a", "b", "c", None)}
    goal = dict(zip(("a", "b", "c", None), X.targets([want[s] for s in ("a", "b", "c", None)], [5, 2, 1, 5])))
    for s in goal:
        mine = [r for r in got if src[r.doc_id] == s]
        assert {(r.source_size, round(r.target, 6)) for r in mine} == {(want[s], round(goal[s], 6))}
        assert abs(sum(r.taken for r in mine) - goal[s]) <= 1
        assert all(r.size == rows[r.doc_id]["text"].count("w") and 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0) for r in mine)
    again = {r.doc_id: r.taken for r in X.mix(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in got}


@pytest.mark.parametrize("sums", [[1000, 100, 10], [10, 10, 10, 10, 1], [0, 0], [5], [1, 2, 4, 8, 16, 32, 64, 5000, 3, 0, 9], []])
def test_goals_by_rounds_of_sums(spark, sums):
    df = spark.createDataFrame([(k, n) for k, n in enumerate(sums)], "sid long, n long")
    got = {r.sid: r.target for r in X.goals(df, (5, 2, 1), 3.0).collect()}
    want = X.targets(sums, [(5, 2, 1)[k % 3] for k in range(len(sums))])
    assert [got[k] for k in range(len(sums))] == pytest.approx(want)


def test_sources_in_code_point_order(spark):
    names = ["b", "B", "é", "z", "\U0001f600", "\uffff", "", None, *(f"n{k}" for k in range(50))]
    df = spark.createDataFrame([(n, 1) for n in names], "source string, n long").repartition(5)
    from scoreline.llm.base import Workspace

    got = {r.source: r.sid for r in X.numbered(df, Workspace(spark, "test")).collect()}
    order = sorted((n for n in names if n is not None)) + [None]
    assert [got[n] for n in order] == list(range(len(names)))


def test_many_equal_rows_are_counted_not_ranked(spark, docs):
    """Copies of one row are one narrow row until the result is written out."""
    rows = [{"doc_id": 5, "text": "a b", "source": "x"}] * 9000 + [{"doc_id": i, "text": "a b", "source": "y"} for i in range(3000)]
    got = X.mix(docs(*rows)).collect()
    assert len(got) == 12_000 and sum(r.doc_id == 5 for r in got) >= 9000
    assert abs(sum(r.taken for r in got) - 24_000) <= 4


def test_stage_takes_some_of_equal_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(X, "BUCKET", 3)
    rows = [{"doc_id": 1, "text": "a b", "source": "x"}] * 40 + [{"doc_id": i, "text": "a b", "source": "y"} for i in range(2, 32)]
    df = docs(*rows)
    want = sum(r.taken for r in X.mix(df).collect()) // 2
    assert X.mix_stage(spark, df, "").count() == want


def test_hot_sizes_are_ranked_in_buckets(spark, docs, monkeypatch):
    monkeypatch.setattr(X, "BUCKET", 5)
    got = X.mix(docs(*[{"doc_id": i, "text": "a b", "source": "x" if i < 150 else "y"} for i in range(200)])).collect()
    assert sum(r.taken for r in got) == pytest.approx(400, abs=4)


def test_edge_cases(spark, docs):
    assert X.mix(docs()).count() == 0
    got = {r.doc_id: r for r in X.mix(docs((1, None), (2, ""), (None, "a b"), (3, "x " * 200_000))).collect()}
    assert got[1].size == got[2].taken == 0 and got[3].size == 200_000 and got[None].size == 2
    same = X.mix(docs((1, "a b"), (1, "a b"))).collect()
    assert len(same) == 2 and sum(r.taken for r in same) == 4


def test_stage_repeats_and_drops(spark, docs):
    rows = [{"doc_id": i, "text": "w x", "source": "a" if i < 4 else "b"} for i in range(44)] + [{"doc_id": 99, "text": None}]
    df = docs(*rows, clash=True)
    got = X.mix_stage(spark, df, "")
    assert got.columns == df.columns
    taken = {}
    for r in got.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    want = {r.doc_id: r.taken // r.size for r in X.mix(df).collect() if r.taken}
    assert taken == want and max(taken.values()) == 3 and 99 not in taken
    assert X.mix_stage(spark, docs(), "").count() == 0
    assert X.mix_stage(spark, docs((1, "a b"), (1, "a b"), (None, "c")), "").count() >= 2
