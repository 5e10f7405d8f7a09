import hashlib

import numpy as np

from scoreline.llm import lines as X


def brute(rows, threshold):
    blank = " \t\n\x0b\x0c\r"
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(blank))
    held = {}
    for i, (_, t) in enumerate(rows):
        for s in (t or "").split("\n"):
            held.setdefault(key(s), set()).add(i)
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        kept = [s for s in all_ if not key(s) or len(held[key(s)]) < threshold]
        out.append((str(d), len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out)


def run(df, threshold, batches=3):
    return sorted((str(r.row.doc_id), r.n_lines, r.n_dropped, r.kept) for r in X.drop_frequent(df, threshold, batches).collect())


def corpus():
    rng = np.random.default_rng(0)
    pool = [f"Line {k}" for k in range(40)] + ["", "  ", "\tLINE 3 \r", "line 3", "École", "ÉCOLE"]
    return [(i, "\n".join(pool[min(45, int(rng.exponential(12)))] for _ in range(rng.integers(1, 9)))) for i in range(120)]


def test_against_brute_force(docs):
    rows = corpus()
    for batches in (1, 3, 7, 10):
        assert run(docs(*rows, clash=True), 5, batches) == brute(rows, 5)


def test_edge_cases(docs):
    assert run(docs(), 2) == []
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "a\nb"), (None, "a\nc"), (4, "a"), (4, "a"), (5, "x\n" * 50_000 + "long" * 100_000)]
    assert run(docs(*rows), 2) == brute(rows, 2)


def test_unicode_and_blank_lines_stay(docs):
    rows = [(i, " \nÉ\né") for i in range(3)]
    assert run(docs(*rows), 3) == brute(rows, 3)
    assert run(docs(*rows), 4)[0][2] == 0


def frame(spark, *h):
    return spark.createDataFrame([(bytes([x]) * 16,) for x in h], "h binary")


def test_runs_compact_by_level_and_outlive_the_session(spark, tmp_path):
    def opened():
        return X.LineRuns(spark, f"{tmp_path}/runs", threshold=4, fanout=2)

    for k in range(5):
        opened().add(frame(spark, 1, 1 if k % 2 else 2, 10 + k))
    runs = opened()
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert {r.h[0] for f in runs.frequent for r in f.collect()} == {1}
    assert {r.h[0] for r in runs.unseen(frame(spark, 1, 2, 12, 99)).collect()} == {99}
    assert [r.h[0] for r in runs.found().collect()] == [1]
    on_disk = [p for p in (tmp_path / "runs").iterdir() if p.is_dir()]
    assert len(on_disk) == sum(map(len, runs.levels)) + len(runs.frequent)


def test_batches_are_merge_joined_with_runs_where_they_lie(spark, tmp_path):
    """No exchange and no broadcast on the side of a run."""
    runs = X.LineRuns(spark, f"{tmp_path}/runs", threshold=2, fanout=2)
    for _ in range(4):
        runs.add(frame(spark, 1, 2, 3))
    assert len(runs.levels) == 3 and len(runs.frequent) == 3
    for got, n in ((runs.fresh(frame(spark, 1, 9)), 3), (runs.unseen(frame(spark, 1, 9)), 4)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == n and "BroadcastExchange" not in plan
        assert plan.count("Exchange hashpartitioning") == 1  # that of the batch itself
        assert plan.count("Bucketed: true") == n
        assert {r.h[0] for r in got.collect()} == {9}


def test_documents_added_before_count(spark, docs, tmp_path):
    X.drop_frequent(docs(*[(i, "often\nseldom" if i < 2 else "often") for i in range(8)]), 5, 2, root=f"{tmp_path}/r")
    got = X.drop_frequent(docs((9, "often\nseldom\nnew")), 5, 1, root=f"{tmp_path}/r").collect()
    assert [r.kept for r in got] == ["seldom\nnew"]


def test_stage(spark, docs):
    df = docs(*[(i, f"same\nown {i}") for i in range(12)], (99, None), clash=True)
    got = X.lines_stage(spark, df, "")
    assert got.columns == df.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[3].text == "own 3" and rows[3].n_chars == 5 and rows[99].text == "" and rows[3]["size"] == 7
    assert X.lines_stage(spark, docs(), "").count() == 0


def test_query(spark, docs, table_dir):
    rows = corpus()
    got = {r.doc_id: r for r in X.op4_lines(spark, table_dir(documents=docs(*rows))).collect()}
    for d, n, m, kept in brute(rows, 10):
        r = got[int(d)]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (n, m, hashlib.sha256(kept.encode()).hexdigest())


def test_later_batches_meet_frequent_runs(spark, docs, monkeypatch):
    """At the defaults, two levels of compaction; what is frequent by then is anti-joined from the batches that follow."""
    met, depth, plain = [], [], X.LineRuns.without
    monkeypatch.setattr(X.LineRuns, "without", lambda self, h, runs: (met.append([r.count() for r in runs]), depth.append(len(self.levels)), plain(self, h, runs))[2])
    rows = [(i, f"common\nonly {i}\nshared {i % 12}") for i in range(120)]
    got = {r.doc_id: r.kept for r in X.drop_frequent(docs(*rows)).select("row.doc_id", "kept").collect()}
    assert sum(any(n) for n in met) == 6 and max(map(len, met)) == 2 and max(depth) == 2
    assert got == {i: f"only {i}" for i, _ in rows}
