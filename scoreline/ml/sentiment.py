"""A sentiment model for chat: naive Bayes over the words of a message, negated ones apart, of which mutual information
chooses those that tell most. Counts are Spark sums over the labelled rows; the model is a bounded table of weights.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chat import Predict, Scorer, Unavailable, model_scorer
from ..session import let_workers_import

#: Labelled rows that a model is fitted on, at most; words that it keeps.
MOST_ROWS, MOST_WORDS = 100_000, 1_000
#: Words that turn the ones after them, up to the next mark.
NEGATORS = ("not", "no", "never", "cannot", "without", "dont", "doesnt", "isnt", "wasnt", "cant", "wont")
REACH = 3
WORD = r"[a-z]+"
MARKS = ".,;:!?"
PIECE = r"[a-z]+|[.,;:!?]"


def plain(text: Column) -> Column:
    return F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("'"), F.lit(""))


def tokens(rows: DataFrame, text: str) -> DataFrame:
    """The rows with ``words``. A word looks back at most ``REACH`` pieces, one by one and up to a mark, so that the work
    grows with the text's length. The pieces are bound as a lambda's variable, as an optimiser that puts their expression
    in the place of a column may cut the text once for each of its words."""

    def turned(pieces: Column, i: Column) -> Column:
        out = F.lit(False)
        for back in range(REACH, 0, -1):
            near = F.get(pieces, i - back)  # null before the text
            out = F.coalesce(near.isin(*NEGATORS), F.lit(False)) | (F.coalesce(~near.isin(*MARKS), F.lit(False)) & out)
        return out

    def words(pieces: Column) -> Column:
        return F.transform(pieces, lambda w, i: F.when(~w.isin(*MARKS), F.when(turned(pieces, i), F.concat(F.lit("not_"), w)).otherwise(w)))

    pieces = F.regexp_extract_all(plain(F.col(text)), F.lit(f"({PIECE})"))
    every = F.transform(F.array(pieces), words)[0]
    return rows.withColumn("words", F.array_distinct(F.filter(every, lambda w: w.isNotNull())))


def words_of(text: str) -> set[str]:
    """The same words, of one text."""
    pieces, out = re.findall(PIECE, text.lower().replace("'", "")), set()
    for i, w in enumerate(pieces):
        if re.fullmatch(WORD, w):
            near = pieces[max(0, i - REACH) : i]
            last = max((k for k, p in enumerate(near) if not p.isalpha()), default=-1)
            out.add(("not_" if set(near[last + 1 :]) & set(NEGATORS) else "") + w)
    return out


def word_counts(rows: DataFrame, text: str, label: str) -> DataFrame:
    """(word, pos, neg, mi): in how many rows of either label a word is, and what its presence tells about the label, in
    nats. ``pos`` is of label 1."""
    seen = tokens(rows.select(F.col(text).alias("_t"), F.col(label).cast("int").alias("_y")).filter("_y is not null"), "_t")
    totals = seen.agg(F.count("*").alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("n1"))
    # explode would have the optimiser filter by the words' number first, and so make them twice
    each = seen.select("_y", F.explode_outer("words").alias("word")).filter("word is not null").groupBy("word").agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    at = each.crossJoin(F.broadcast(totals))  # one row

    def part(both: Column, a: Column, b: Column) -> Column:
        return F.when(both > 0, both / F.col("n") * F.log(both * F.col("n") / (a * b))).otherwise(0.0)

    pos, neg, n, n1 = (F.col(c).cast("double") for c in ("pos", "neg", "n", "n1"))
    n0, has = n - n1, pos + neg
    mi = part(pos, has, n1) + part(neg, has, n0) + part(n1 - pos, n - has, n1) + part(n0 - neg, n - has, n0)
    return at.select("word", "pos", "neg", mi.alias("mi"))


@dataclass
class Sentiment:
    """``base``: log odds of label 1 without any word; by word, what its presence adds."""

    base: float
    weight: dict[str, float]
    labels: tuple[str, str] = ("neutral", "negative")

    def odds(self, text: str) -> float:
        return self.base + sum(self.weight.get(w, 0.0) for w in words_of(text))

    def predictor(self) -> Callable[[], Predict]:
        return lambda: lambda texts: [self.labels[self.odds(t) > 0] for t in texts]

    def scorer(self) -> Scorer:
        return model_scorer(self.predictor())


def smallest(rows: DataFrame, most: int, *columns: str) -> DataFrame:
    """The ``most`` rows of the smallest content hashes, ties by content. Only hashes are sorted for the bound, and
    whole rows only where they share it, so that rows stay in the tasks that read them."""
    hashed = rows.withColumn("_h", F.xxhash64(*columns))
    bound, n = hashed.select("_h").orderBy("_h").limit(most).agg(F.max("_h"), F.count("*")).first()
    if n < most:
        return rows
    below = hashed.filter(F.col("_h") < bound)
    left = most - below.count()
    return below.unionByName(hashed.filter(F.col("_h") == bound).orderBy(*columns).limit(left)).drop("_h")


class OneLabel(Unavailable, ValueError):
    """Rows that do not have both labels teach no model."""


def fit(rows: DataFrame, text: str, label: str, most_rows: int = MOST_ROWS, most_words: int = MOST_WORDS, smooth: float = 1.0) -> Sentiment:
    """Learns from the ``most_rows`` rows of the smallest content hashes; of their words the ``most_words`` of greatest
    mutual information come to the driver. Raises ``OneLabel`` if the rows have one label only, or none."""
    let_workers_import(rows.sparkSession)  # for the scorer
    some = smallest(rows.filter(F.col(label).isNotNull()).select(text, label), most_rows, text, label).persist()
    try:
        n, n1 = some.agg(F.count("*"), F.sum(F.col(label).cast("int"))).first()
        if not n or n1 in (0, n):
            raise OneLabel("a sentiment model needs rows of both labels")
        top = word_counts(some, text, label).orderBy(F.desc(F.round("mi", 12)), "word").limit(most_words).collect()
    finally:
        some.unpersist()
    on = {r.word: ((r.pos + smooth) / (n1 + 2 * smooth), (r.neg + smooth) / (n - n1 + 2 * smooth)) for r in top}
    absent = sum(math.log((1 - a) / (1 - b)) for a, b in on.values())
    base = math.log(n1 / (n - n1)) + absent
    return Sentiment(base, {w: math.log(a / b) - math.log((1 - a) / (1 - b)) for w, (a, b) in on.items()})
