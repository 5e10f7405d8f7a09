"""The chat model: words, counts, weights, and its use as a scorer."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreline.functions.chat import first_that_works
from scoreline.ml import sentiment as X

TEXTS = ["You are NOT a good player", "not, good", "good good game", "don't say that. good", "never ever win again now", "", None, "no", "é not ünd x!not y", "a'b c"]


def test_words(spark):
    got = X.tokens(spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string"), "t").orderBy("i").collect()
    assert [sorted(r.words) for r in got] == [sorted(X.words_of(t or "")) for t in TEXTS]
    assert X.words_of(TEXTS[0]) == {"you", "are", "not", "not_a", "not_good", "not_player"} and X.words_of(TEXTS[1]) == {"not", "good"}
    assert X.words_of(TEXTS[3]) == {"dont", "not_say", "not_that", "good"} and X.words_of("never ever win again now") == {"never", "not_ever", "not_win", "not_again", "now"}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.sampled_from("not goodbad'.,! é"), max_size=40), min_size=1, max_size=20))
def test_words_of_any_text(spark, texts):
    got = X.tokens(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t").collect()
    assert {r.i: set(r.words) for r in got} == {i: X.words_of(t) for i, t in enumerate(texts)}


ROWS = [("you are trash", 1), ("trash talk", 1), ("not good at all", 1), ("good game", 0), ("good match all", 0), ("well played all", 0), (None, 0), ("good good", None)]


def labelled(spark):
    return spark.createDataFrame(ROWS, "text string, y int")


def test_counts_and_information(spark):
    docs = [(X.words_of(t or ""), y) for t, y in ROWS if y is not None]
    n, n1 = len(docs), sum(y for _, y in docs)
    got = {r.word: r for r in X.word_counts(labelled(spark), "text", "y").collect()}
    pos, neg = Counter(w for ws, y in docs if y for w in ws), Counter(w for ws, y in docs if not y for w in ws)
    assert set(got) == {*pos, *neg}
    for w, r in got.items():
        mi = 0.0
        for has in (True, False):
            for y in (0, 1):
                both = sum((w in ws) == has and lab == y for ws, lab in docs)
                mi += both / n * math.log(both * n / (sum((w in ws) == has for ws, _ in docs) * (n1 if y else n - n1))) if both else 0
        assert (r.pos, r.neg) == (pos[w], neg[w]) and abs(r.mi - mi) < 1e-12


def test_model_is_naive_bayes_over_its_words(spark):
    m = X.fit(labelled(spark), "text", "y", most_words=4)
    docs = [(X.words_of(t or ""), y) for t, y in ROWS if y is not None]
    n1 = sum(y for _, y in docs)
    assert len(m.weight) == 4 and "trash" in m.weight
    for text in ("trash", "good game", "you all", ""):
        want = math.log(n1 / (len(docs) - n1))
        for w in m.weight:
            a, b = ((sum(w in ws for ws, y in docs if y == k) + 1) / ((n1 if k else len(docs) - n1) + 2) for k in (1, 0))
            want += math.log(a / b) if w in X.words_of(text) else math.log((1 - a) / (1 - b))
        assert abs(m.odds(text) - want) < 1e-12
    score = first_that_works(lambda: m.scorer())
    got = spark.createDataFrame([("trash",), ("good game",), (None,)], "t string").select(score(F.col("t")).alias("l")).collect()
    assert [r.l for r in got] == [m.labels[m.odds(t) > 0] for t in ("trash", "good game", "")] and got[0].l == "negative"


def test_rows_of_one_label_fall_back_to_the_lexicon(spark):
    one = labelled(spark).filter("y = 1")
    for rows in (one, one.limit(0)):
        with pytest.raises(ValueError):
            X.fit(rows, "text", "y")
    score = first_that_works(lambda: X.fit(one, "text", "y").scorer())
    assert [r[0] for r in spark.createDataFrame([("trash",), ("hello",)], "t string").select(score(F.col("t"))).collect()] == ["negative", "neutral"]


def test_query(spark, sf_dir):
    import __spark_entry__

    rows = __spark_entry__.queries()["s_model_chat"](spark, sf_dir).collect()
    assert {r.role for r in rows} == {r.role for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("role").distinct().collect()}
    assert all(0 <= r.negative <= r.messages for r in rows)
