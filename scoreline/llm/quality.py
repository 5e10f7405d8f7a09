"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Defined cases: a null or empty text has no words and fails; a text of any length is counted whole; a line counts as
repeated if it holds a word and equals an earlier line of its text; a ratio of just a threshold holds; rows equal in
everything are judged alike; other columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import SPACE, boxed, table, unboxed

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for was on are with as be by at this from or an a he not "
    "de la le et les des en un une du que dans qui pour est sur au par il pas avec ce "
    "der die und den von das mit sich des auf für ist im dem nicht ein eine als auch es "
    "el los del se las por con para al lo como más su"
).split()


def _let(value: str, name: str, body: str) -> str:
    """Binds a value once; Spark would copy a plain expression into every use."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeats(w: str) -> str:
    """Words of array ``w`` in three-word windows that are there twice or more: windows are hashed and sorted with
    their places, those equal to a neighbour are taken back in order, and the places they cover are summed."""
    hashed = f"transform(sequence(0, size({w}) - 3), i -> struct(xxhash64({w}[i], {w}[i + 1], {w}[i + 2]) as h, i as i))"
    twice = "filter(s, (x, k) -> (k > 0 and s[k - 1].h = x.h) or (k + 1 < size(s) and s[k + 1].h = x.h))"
    places = _let(f"sort_array({hashed})", "s", f"sort_array(transform({twice}, x -> x.i))")
    covered = f"aggregate({places}, named_struct('c', 0L, 'e', 0), (a, i) -> named_struct('c', a.c + (i + 3 - greatest(i, a.e)), 'e', i + 3), a -> a.c)"
    some = f"size(array_distinct(transform(sequence(0, size({w}) - 3), i -> xxhash64({w}[i], {w}[i + 1], {w}[i + 2])))) < size({w}) - 2"
    return f"case when size({w}) < 4 then 0L when {some} then {covered} else 0L end"


def features(text: str = "text") -> Column:
    """A struct of counts over one text."""
    stops = "|".join(STOP_WORDS)
    space = SPACE.replace("\\", "\\\\")
    t = f"coalesce({text}, '')"
    words = f"array_remove(split({t}, '{space}'), '')"
    lines = f"filter(split({t}, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    body = f"""named_struct(
        'n_words', bigint(size(w)), 'word_chars', bigint(length(array_join(w, ''))),
        'n_symbols', bigint(regexp_count({t}, '[#*$%&|<>]')),
        'n_dup_lines', {_let(lines, "l", "bigint(size(l) - size(array_distinct(l)))")},
        'n_repeat_words', {_repeats("w")},
        'n_stop_words', bigint(regexp_count({t}, '(?<![^\\\\x20\\\\x09-\\\\x0D])(?i:{stops})(?=[,.]?(?:[\\\\x20\\\\x09-\\\\x0D]|$))')),
        'n_lines', {_let(lines, "l", "bigint(size(l))")})"""
    return F.expr(_let(words, "w", body))


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts of ``features`` that must lie in [low, high]; None leaves a side open."""

    name: str
    top: str
    under: str | None = None
    low: float | None = None
    high: float | None = None

    def holds(self) -> str:
        """By multiplication: no division, so a count of zero is no special case."""
        under = f"f.{self.under}" if self.under else "1"
        sides = [f"f.{self.top} >= {self.low}D * {under}"] * (self.low is not None) + [f"f.{self.top} <= {self.high}D * {under}"] * (self.high is not None)
        return " and ".join(sides)


BASE = (Rule("words", "n_words", low=50), Rule("repeats", "n_repeat_words", "n_words", high=0.5))
RULES = (
    Rule("word length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop words", "n_stop_words", "n_words", low=0.06),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """A struct ``row`` of the columns of ``docs``, a struct ``f`` of counts, ``base_failed`` and ``kept``. No shuffle:
    one projection."""
    every = lambda rs: F.expr(" and ".join(f"({r.holds()})" for r in rs))
    got = docs.select(boxed(docs), features().alias("f")).withColumn("base_failed", ~every(base))
    return got.withColumn("kept", ~F.col("base_failed") & every(rules))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    return got.select("row.doc_id", *[f"f.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, unchanged."""
    return judge(docs).filter("kept").select(*unboxed(docs))


SQL = {
    "op5_quality": rf"""
with w as (select row_number() over () as rid, doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select rid, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 3) x),
t as (select rid, i, count(*) over (partition by rid, g) as n from g),
c as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from t where n > 1) x group by rid),
f as (select w.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
  length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) as n_symbols,
  len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) as n_lines,
  len(list_distinct(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as n_unlike,
  len(list_filter(w, lambda x: regexp_full_match(x, '(?i:{"|".join(STOP_WORDS)})[,.]?'))) as n_stop_words,
  coalesce(c.n, 0) as n_repeat_words from w left join c on w.rid = c.rid),
j as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_lines - n_unlike as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and word_chars between 2 * n_words and 15 * n_words and n_symbols <= 0.1::double * n_words
    and n_stop_words >= 0.06::double * n_words and (n_lines - n_unlike) <= 0.5::double * n_lines as kept from j""",
}
