"""Main text of HTML pages: the maximum-scoring contiguous run of tokens.

A page is a sequence of words and tags. A word scores by the block it stands in: the elements around it and their
names, the share of linked words, the length, and where a page marks an article, whether it lies in it. A tag costs
the share of its kind that labelled pages have outside of their main text. Scores of words come from a logistic
regression. An element whose tokens sum up to less than nothing is one token of a small cost, so that the text goes
on behind an advert or a list of comments in its midst; one linear scan finds the best contiguous region of what is
then there, and its blocks are the main text.

Labelled pages are two: rows of the table that mark an article, which stands for their main text, at most
``SAMPLE`` of them (a documented bound; every page is read), each learned from with and without its mark; and a few
pages in this module, labelled by hand, for kinds of surroundings that a table may not show.

Defined cases: null or empty html gives an empty text; a page without any word gives an empty text; a page of any
length is read whole, in time linear in it; unclosed and stray tags are read as they come; of regions of one score
the first counts; rows of one id are pages of their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, blocks, let_workers_import, table

#: Fixed values of HTML: elements without content, elements whose content is not shown, inline elements, and what a new
#: element ends if it stands open.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style textarea title noscript template iframe svg select option object".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
ENDS = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "li": ("li",), "tr": ("tr", "td", "th")}
#: Elements by which a page itself marks its main text.
MARKS = frozenset(("article", "main"))
_PLAIN = frozenset("html body div".split())

#: Pages of the table that are learned from, and characters that one of these may have.
SAMPLE, LONGEST = 400, 100_000
#: Most that a word scores or costs, and most that an element costs as a whole.
MOST, COST = 3.0, 6.0
ROUNDS, DECAY = 600, 1e-4

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>|<[!?][^<>]*>?|(?P<text>[^<]+|<)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")


def names(tag: str, attrs: str) -> frozenset[str]:
    """What an element is called: its tag and the words of its class, id and role."""
    found = {tag} - _PLAIN - MARKS - INLINE
    if "=" in attrs:
        for m in _ATTR.finditer(attrs):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                if not name.startswith(("has-", "with-", "no-", "has_", "with_", "no_")):  # says what is elsewhere
                    found.update("." + x for x in _NAME.findall(name))
    return frozenset(found)


class Block:
    """A run of text that no block element breaks. ``base`` is the summed weight of the names around it."""

    __slots__ = ("base", "inside", "labelled", "last", "linked", "names", "parts", "words")

    def __init__(self, base, inside, labelled, last, names):
        self.base, self.inside, self.labelled, self.last, self.names = base, inside, labelled, last, names
        self.parts, self.words, self.linked = [], 0, 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())

    def own(self) -> tuple[str, ...]:
        """Features of the block by itself."""
        n = max(self.words, 1)
        return (f"last:{self.last}", "long" if n > 9 else "short", f"linked:{-(-3 * self.linked // n)}", "bias")


class Reader:
    """Reads a page once. What stands open is kept as counts, so that a token costs the same at any depth."""

    def __init__(self, weight: dict[str, float], learn: bool = False):
        self.weight, self.learn = weight, learn
        self.events: list[Block | tuple[str, bool]] = []
        self.stack: list[tuple[str, frozenset[str]]] = []
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []  # places of elements that are not inline
        self.open: Counter[str] = Counter()
        self.base, self.block = 0.0, None
        self.marks = 0

    def _push(self, tag: str, called: frozenset[str]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.walls.append(len(self.stack))
            self.block = None
            self.events.append((tag, True))
        for k in called:
            self.open[k] += 1
            if self.open[k] == 1:
                self.base += self.weight.get(k, 0.0)
        self.open[tag + ">"] += 1
        self.marks += tag in MARKS
        self.stack.append((tag, called))

    def _pop(self) -> None:
        tag, called = self.stack.pop()
        self.places[tag].pop()
        for k in called:
            self.open[k] -= 1
            if not self.open[k]:
                self.base -= self.weight.get(k, 0.0)
        self.open[tag + ">"] -= 1
        if tag not in INLINE:
            self.walls.pop()
            self.block = None
            self.events.append((tag, False))

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self._pop()

    def _close(self, tag: str) -> None:
        at = self.places.get(tag)
        if not at:
            if tag not in INLINE and tag not in VOID:
                self.block = None
        elif tag not in INLINE or not self.walls or self.walls[-1] < at[-1]:
            self._pop_to(at[-1])

    def _text(self, text: str) -> None:
        if self.block is None:
            if not text.strip():
                return
            last = self.stack[self.walls[-1]][0] if self.walls else "body"
            kinds = frozenset(k for k, n in self.open.items() if n and not k.endswith(">")) if self.learn else None
            inside = self.open["article>"] + self.open["main>"] > 0
            self.block = Block(self.base, inside, self.open[".mainmark"] > 0, last, kinds)
            self.events.append(self.block)
        b = self.block
        b.parts.append(text)
        if n := len(text.split()):
            b.words += n
            b.linked += n * (self.open["a>"] > 0)

    def read(self, page: str) -> list[Block | tuple[str, bool]]:
        at, n = 0, len(page)
        while at < n:
            m = _TOKEN.match(page, at)
            at = m.end()
            if m["text"]:
                self._text(_unescape(m["text"]))
            elif m["tag"]:
                tag, attrs = m["tag"].lower(), m["attrs"]
                if tag in UNSEEN:
                    if not m["end"] and not attrs.endswith("/"):
                        shut = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                        at = shut.end() if shut else n
                elif tag in VOID:
                    if tag == "br":
                        self._text(" ")
                    elif tag == "hr":
                        self.block = None
                elif m["end"]:
                    self._close(tag)
                else:
                    wall = self.stack[self.walls[-1]][0] if self.walls else ""
                    if tag not in INLINE and (wall == "p" or wall in ENDS.get(tag, ())):
                        self._pop_to(self.walls[-1])
                    if not attrs.endswith("/") or tag not in INLINE:
                        self._push(tag, names(tag, attrs))
        self._pop_to(0)
        return self.events


_LONG = re.compile(r"&#([0-9]{8,});?")


def _unescape(text: str) -> str:
    """Character references decoded; numbers too long for any character are that of an unknown one."""
    return entities.unescape(_LONG.sub(lambda m: "\ufffd" if len(n := m[1].lstrip("0")) > 7 else f"&#{n or 0};", text))


#: Pages labelled by hand: an element marked with the attribute ``main`` holds the main text, all else does not.
_BODY = "<h1>A title of words</h1><p>One <b>bold</b> word and <a href=x>a link</a> in a paragraph of words that goes on here.</p><h2>A part</h2><h3>A smaller part</h3><p>More words of the text<br>go on here.</p><ul><li>first point</li><li>second point</li></ul><blockquote>words of others</blockquote><table><tr><td>cell</td><td>cell</td></tr></table><pre>some code here</pre><figure><figcaption>What the picture shows</figcaption></figure><section><p>Short.</p></section><div>Some words of the text stand in no paragraph of their own.</div><div>Others too.</div>"
_AROUND = (
    ("<nav><ul><li><a href=x>Home</a></li><li><a href=x>News</a></li></ul></nav>", "<footer>&copy; words &middot; all rights</footer>"),
    ("<header class=header><a href=x>Name</a><div class=menu><a>One</a><a>Two</a></div></header>", "<div id=footer class=footer><p>Contact us</p></div>"),
    ("<div class=\"ad\">Buy words now, cheap words for all.</div>", "<aside class=sidebar><h3>Latest</h3><ul><li><a>Other text</a></li></ul><p>Words at the side of it.</p></aside>"),
    ("<div class='cookie notice'>We use cookies to serve you.</div>", "<section class=comments id=comments><h3>Comments</h3><div class=comment><p>I liked these words a lot and say so here.</p></div></section>"),
    ("<div class=\"banner advert advertising\">Sponsored words of somebody</div>", "<form class=newsletter><label>Mail</label><input><button>Join us today</button></form>"),
    ("<div role=navigation class=\"nav navbar\"><a>a</a> <a>b</a></div>", "<div class=\"related share social widget promo sponsored\"><p>Read this too</p></div>"),
    ("<div class=\"ads advertisement breadcrumb breadcrumbs\">You are here</div>", "<div class=\"sidebar reply replies commentlist\"><p>Reader words about the text</p></div>"),
    ("<div class=\"consent popup modal notification alert gdpr\">Please accept.</div>", "<div role=\"contentinfo complementary banner dialog\" class=\"copyright subscribe login\">words</div>"),
)
_SHELLS = ("<article main>{}</article>", "<main main><div class=content>{}</div></main>", "<div class='post entry article' main>{}</div>", "<div id=content main><section>{}</section></div>")


#: Text like any other, beside what a page marks as its article.
_BESIDE = ("<p>A line of words that stands before it all.</p>", "<div><h2>More from here</h2><p>Another text begins with these words and goes on.</p></div>")


def _named(m: re.Match, k: int) -> str:
    """The k-th of an attribute's names alone."""
    every = (m[2] or m[3] or m[4]).split()
    return f"{m[1]}={every[k % len(every)]}"


@cache
def labelled_pages() -> tuple[tuple[str, bool], ...]:
    """Each surrounding by each of its names, outside of the main text and, unlabelled, within it; and whether the page
    can be told without its mark."""
    out = []
    for s in _SHELLS[:2]:
        for around in (_BESIDE, ("", _BESIDE[0] * 3)):
            out.append((around[0] + s.replace(" main", " id=mainmark").format(_BODY) + around[1], False))
    for pair in _AROUND:
        for k in range(2 * len(_SHELLS)):
            s, (a, b) = _SHELLS[k % len(_SHELLS)], (_ATTR.sub(lambda m: _named(m, k), x) for x in pair)
            main = s.replace(" main", " id=mainmark").format(_BODY)
            out.append((f"<html><head><title>t</title><style>x</style><script>y</script></head><body>{a}{main}{b}</body></html>", True))
            within = s.replace(" main", "").format("<div id=mainmark>" + _BODY + "</div>" + a + b + "<div id=mainmark>" + _BODY + "</div>")
            out.append((f"<html><body>{b}<div class=page>{within}{a}</div></body></html>", True))
    return tuple(out)


Model = tuple[dict[str, float], dict[str, float]]


def _place(b: Block, marked: bool) -> tuple[str, ...]:
    return ("inside",) if b.inside else ("beside",) if marked else ()


def learn(pages: list[str]) -> Model:
    """Weights of features and costs of tags, from pages that mark an article and the pages of this module."""
    rows: list[tuple[tuple[str, ...], bool, float]] = []
    tags: dict[bool, Counter[str]] = {True: Counter(), False: Counter()}
    own = labelled_pages()
    for source, weight in ((own, 1.0 / len(own)), ([(p, True) for p in pages], 1.0 / max(1, len(pages)))):
        for page, plain in source:
            read = Reader({}, learn=True)
            events = read.read(page)
            if source is not own and not read.marks:
                continue
            depth = 0
            for e in events:
                if isinstance(e, Block):
                    y = e.labelled if source is own else e.inside
                    features = (*(e.names - {".mainmark"}), *e.own())
                    if plain:
                        rows.append((features, y, weight))
                    rows.append(((*features, *_place(e, read.marks > 0)), y, weight))
                else:
                    depth += (1 if e[1] else -1) * (e[0] in MARKS)
                    if source is not own:
                        tags[depth > 0][e[0]] += 1
    seen = Counter(f for fs, _, _ in rows for f in fs)
    at = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n > 2))}
    row = np.array([r for r, (fs, _, _) in enumerate(rows) for f in fs if f in at])
    col = np.array([at[f] for fs, _, _ in rows for f in fs if f in at])
    y, share = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
    share /= share.sum()
    longest = max(Counter(row.tolist()).values())
    step = 1 / (0.25 * longest * np.bincount(col, share[row], len(at)) + DECAY)  # what the curvature allows each weight
    w, last = np.zeros(len(at)), np.zeros(len(at))
    for k in range(ROUNDS):  # gradient steps with momentum
        ahead = w + k / (k + 3) * (w - last)
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, ahead[col], len(rows)), -35, 35)))
        w, last = ahead - step * (np.bincount(col, (share * (p - y))[row], len(at)) + DECAY * ahead), w
    cost = {t: (tags[False][t] + 1) / (tags[True][t] + tags[False][t] + 2) for t in {*tags[True], *tags[False]}}
    return {f: float(w[k]) for f, k in at.items()}, cost


def scores(events: list, model: Model, marked: bool) -> list[float]:
    """Of each event: words score together, as those of a block score alike."""
    weight, cost = model
    out = []
    for e in events:
        if isinstance(e, Block):
            z = e.base + sum(weight.get(f, 0.0) for f in (*e.own(), *_place(e, marked)))
            out.append(e.words * max(-MOST, min(MOST, z)))
        else:
            out.append(-cost.get(e[0], 0.5))
    return out


def _best(steps: list[tuple[float, int, int]]) -> tuple[int, int]:
    """First and last place of the run of greatest sum among (value, first, last) in order; an empty one if none is
    above nothing."""
    best, run, start, span = 0.0, 0.0, 0, (0, -1)
    for value, first, last in steps:
        if run <= 0:
            run, start = 0.0, first
        run += value
        if run > best:
            best, span = run, (start, last)
    return span


def best_region(events: list, score: list[float]) -> list[int]:
    """Events of the best contiguous region. An element of a negative sum is one token, unless it holds all of what
    would be the best region without this."""
    seed = _best([(s, i, i) for i, s in enumerate(score)])
    fold: dict[int, tuple[int, float]] = {}
    opened: list[tuple[int, float]] = []
    total = 0.0
    for i, e in enumerate(events):
        if not isinstance(e, Block) and e[1]:
            opened.append((i, total))
        total += score[i]
        if not isinstance(e, Block) and not e[1]:
            first, before = opened.pop()
            if total < before and not first <= seed[0] <= seed[1] <= i:
                fold[first] = (i, max(total - before, -COST))
                total = before + fold[first][1]
    steps, i = [], 0
    while i < len(events):
        last, value = fold.get(i, (i, score[i]))
        steps.append((value, i, last))
        i = last + 1
    lo, hi = _best(steps)
    return [first for _, first, last in steps if lo <= first and last <= hi and first not in fold]


def extract(page: str | None, model: Model | None = None) -> str:
    """Blocks of the main text, a line each."""
    if not page:
        return ""
    model = model or learned_here()
    read = Reader(model[0])
    events = read.read(page)
    region = best_region(events, scores(events, model, read.marks > 0))
    lines = [events[i].text() for i in region if isinstance(events[i], Block)]
    return "\n".join(x for x in lines if x)


@cache
def learned_here() -> Model:
    """The model of this module's own pages alone."""
    return learn([])


def fit(pages: DataFrame, most: int = SAMPLE, longest: int = LONGEST) -> Model:
    """Learns from ``most`` pages of the smallest hashes of page_id, longer ones left out."""
    ids = [r[0] for r in pages.select("page_id").filter("page_id is not null").distinct().orderBy(F.xxhash64("page_id", F.lit(17)), "page_id").limit(most).collect()]
    some = pages.filter(F.col("page_id").isin(ids) & (F.length("html") <= longest)).select("page_id", "html").limit(2 * most)
    got = sorted((r.page_id, r.html) for r in some.toLocalIterator()) if ids else []
    return learn([h for _, h in got[:most]])


def extract_pages(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars). No shuffle; a page at a time; the model, a few hundred weights, is sent along."""
    model = model or fit(pages)
    let_workers_import(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, 256):
            text = [extract(h, sent.value) for h in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"), run, "page_id long, url string, text string, n_chars long")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))
