import re
from collections import Counter

import numpy as np
import pytest

from scoreline.llm import quality as X


def slow(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = Counter(zip(w, w[1:], w[2:]))
    cover = set()
    for i in range(len(w) - 2):
        if g[w[i], w[i + 1], w[i + 2]] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [s for s in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))


def texts():
    rng = np.random.default_rng(0)
    out = [None, "", " \n\t", "one", "a b", "a b c", "a a a", "a a a a", "a b c a b c", "a\x0bb\x0cc #$ <|>", "x\nx\nx \n\n", "é" * 3 + "\U0001f600 b", "    w"]
    for n in (10, 60, 200, 500):
        out += [" ".join(f"w{x}" for x in rng.integers(0, k, n)) for k in (2, 5, 30, 1000)]
    out += ["\n".join(" ".join(f"w{x}" for x in rng.integers(0, 3, 4)) for _ in range(40)), "the same line of words\n" * 3000]
    return out


def test_counts_against_brute_force(docs):
    t = texts()
    got = {r.row.doc_id: r for r in X.judge(docs(*enumerate(t), clash=True)).collect()}
    for i, x in enumerate(t):
        f, want = got[i].f, slow(x)
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words) == want, x
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got[i].kept and got[i].base_failed)


def test_native_plan(docs):
    plan = X.judge(docs((1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("text, kept", [
    (" ".join(f"the word{i} of" for i in range(40)), True),
    (" ".join(f"the$ word{i}# of&" for i in range(40)), False),
    (" ".join(f"word{i}" for i in range(100)), False),
    (" ".join(f"the {'x' * 40}{i}" for i in range(60)), False),
])
def test_rules(docs, text, kept):
    assert X.judge(docs((1, text))).first().kept is kept


def test_clean_labelled_documents_stay(spark):
    """Of the documents labelled good and long enough, none goes; of those labelled bad, none stays."""
    d = "/root/testdata/sf0.01"
    got = X.judge(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")).select("row.doc_id", "base_failed", "kept").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    assert {(r.quality, r.kept) for r in got} == {(1, True), (0, False)}


def test_stage(spark, docs):
    good = " ".join(f"the word{i} of" for i in range(40))
    df = docs((1, good), (1, good), (None, good), (2, None), clash=True)
    got = X.quality_stage(spark, df, "")
    assert got.columns == df.columns and sorted(str(r.doc_id) for r in got.collect()) == ["1", "1", "None"]
    assert X.quality_stage(spark, docs(), "").count() == 0
