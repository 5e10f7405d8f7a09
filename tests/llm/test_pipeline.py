import os, sys
sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]
import math
from collections import defaultdict

import corpus_pipeline as P
from helpers import connect
from scoreline.llm import lines, mixing, quality, simhash
from scoreline.llm.registry import QUERIES, SQL


def test_names():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)] and set(SQL) <= set(QUERIES)
    assert [f for _, f in P.STAGES[:4]] == [quality.quality_stage, lines.lines_stage, simhash.simhash_stage, mixing.mix_stage]


def test_stages_pass_on_what_they_keep(spark, sf_dir, tmp_path):
    """Each stage, written and read again: columns stay, kept documents come from the stage before."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first, before = df.columns, {r.doc_id for r in df.collect()}
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, df, sf_dir).write.parquet(str(tmp_path / str(k)))
        df = spark.read.parquet(str(tmp_path / str(k)))
        now = {r.doc_id for r in df.collect()}
        assert df.columns == first and now <= before and now, name
        before = now


def test_run_against_brute_force(spark, sf_dir):
    """Rules by SQL, lines, links and mix by plain Python on the same small table, packing by its invariants."""
    con = connect(sf_dir)
    kept = {r[0] for r in con.sql(f"select doc_id from ({SQL['op5_quality']}) where kept").fetchall()}
    rows = [(d, t, s) for d, t, s in con.sql("select doc_id, text, source from documents").fetchall() if d in kept]
    from test_lines import brute as slow_lines
    from test_simhash import classes, slow_fingerprint

    text = {int(d): t for d, _, _, t in slow_lines([(d, t) for d, t, _ in rows], 10)}
    stay = set(classes({d: slow_fingerprint(t) for d, t in text.items()}).values())
    size = {d: len(text[d].encode().split()) for d in stay}
    src = {d: s for d, _, s in rows if d in stay}
    names = sorted(set(src.values()))
    sums = [sum(size[d] for d in stay if src[d] == s) for s in names]
    goal = dict(zip(names, mixing.targets(sums, [(5, 2, 1)[i % 3] for i in range(len(names))])))

    got = P.run(spark, sf_dir).collect()
    ends, copies = defaultdict(list), defaultdict(int)
    for r in got:
        ends[r.sequence_id].append((r.offset, r.length))
        if r.piece == 0:
            copies[r.doc_id] += 1
    assert set(copies) <= {d for d in stay if size[d]} and max(copies.values()) <= 3
    for s in names:
        assert abs(sum(copies[d] * size[d] for d in stay if src[d] == s) - goal[s]) <= max([size[d] for d in stay if src[d] == s])
    for s in ends.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert len(ends) <= math.ceil(sum(r.length for r in got) / 2048) * 1.05 + 1
