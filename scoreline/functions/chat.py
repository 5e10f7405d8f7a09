"""Chat signals: lexicon scorers and per-player counts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import times

# The two lexicons and two patterns that the tables' contracts name.
FEATURE_LEXICON = r"(?i)\b(?:trash|garbage|stupid|idiot|noob|useless|terrible|awful|worst|kys|report)\b"
EXPLORATION_LEXICON = r"\b(noob|trash|idiot|stupid|cheat|cheater|ez|wtf|losing|throw|threw|report)\b"
ALL_CAPS = r"^[A-Z0-9 !?.'\-]+$"
INTENSE = r"!{2,}"

Scorer = Callable[[Column], Column]


def lexicon_scorer(pattern: str = FEATURE_LEXICON) -> Scorer:
    """A scorer labels a message; any function from a text column to a label column serves, a model's too."""
    return lambda text: F.when(text.rlike(pattern), "negative").otherwise("neutral")


#: A model: labels for a batch of texts.
Predict = Callable[[list[str]], list[str]]


def model_scorer(load: Callable[[], Predict]) -> Scorer:
    """A scorer that a model backs. ``load`` runs once in each task that scores, batches go through Arrow, a null text
    is an empty one."""

    @F.pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for texts in batches:
            yield pd.Series(predict(texts.fillna("").tolist()), dtype="object").str.lower()

    return lambda text: label(text)


class Unavailable(Exception):
    """A scorer that this machine or these rows do not have."""


def first_that_works(*ways: Callable[[], Scorer], otherwise: Scorer | None = None) -> Scorer:
    """The scorer of the first way that is to be had here: a way whose library is absent, or that says ``Unavailable``, is
    logged and passed over. Any other error, of a job or a table, is the caller's. The last resort is the lexicon."""
    for make in ways:
        try:
            return make()
        except (ImportError, Unavailable) as e:
            logging.getLogger(__name__).warning("chat scorer %s is not to be had: %s", getattr(make, "__name__", make), e)
    return otherwise or lexicon_scorer()


def cpu_has(feature: str = "avx", path: str = "/proc/cpuinfo") -> bool:
    """Whether the processor says that it has a feature that a model may need; yes where it cannot be asked."""
    try:
        with open(path, encoding="utf-8", errors="ignore") as f:
            lines = f.read().lower().splitlines()
    except OSError:
        return True
    return any(feature in x.partition(":")[2].split() for x in lines if x.startswith(("flags", "features")))


def needs_cpu(make: Callable[[], Scorer], feature: str = "avx") -> Callable[[], Scorer]:
    """A way that is tried only where the processor has the feature."""

    def checked() -> Scorer:
        if not cpu_has(feature):
            raise Unavailable(f"the processor has no {feature}")
        return make()

    return checked


def chat_counts(messages: DataFrame, scorer: Scorer, lower: bool = False) -> DataFrame:
    """Per (logid, steamid): messages, mean length, shouted, emphatic and negative ones. ``lower`` counts emphasis
    and lexicon hits on the lower-cased text, as the exploration export does."""
    text = F.coalesce(F.col("message"), F.lit(""))
    seen = F.coalesce(F.col("messagelower"), F.lit("")) if lower else text
    return (
        messages.filter(F.col("steamid").isNotNull())
        .groupBy("logid", "steamid")
        .agg(
            F.count("*").alias("chat_messages"),
            F.avg(F.length(text)).alias("avg_message_length"),
            times(text.rlike(ALL_CAPS)).alias("all_caps_messages"),
            times(seen.rlike(INTENSE)).alias("intense_punctuation_messages"),
            times(scorer(seen) == "negative").alias("negative_lexicon_hits"),
        )
    )
