import html
import re
import time

import numpy as np
import pytest

from scoreline.llm import html as X


def page(body):
    return f'<!DOCTYPE html><html><head><title>T t t</title><script>var a = "<p>no</p>";</script></head><body>{body}</body></html>'


ARTICLE = "<article><h1>The title</h1><p>First words &amp; more &lt;b&gt;.</p><p>Second\n  paragraph <b>bold</b> text<br>here.</p></article>"
TEXT = "The title\nFirst words & more <b>.\nSecond paragraph bold text here."


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href=/x>Menu one</a></li></ul></nav>{}<footer>&copy; all of it</footer>",
    "<header><h2>Site</h2></header><div class='ad'>Buy a lot of words here now and cheap ones too.</div>{}<aside><p>Side words in a long line of words</p></aside>",
    "<div class=\"cookie-notice\">We use cookies on this page of ours.</div>{}<section class='comments'><p>I think this is a good text indeed.</p></section>",
    "<form><label>Name</label><input><button>Send</button></form>{}<div id='comments'><div class='comment'><p>Nice one, really nice one.</p></div></div>",
    "<style>p{{x}}</style><!-- <p>hidden</p> -->{}<div role=\"navigation\"><p>go here and there</p></div>",
])
def test_main_text(around):
    got = X.extract(page(around.format(ARTICLE)))
    assert re.sub(r"\s+", " ", got) == re.sub(r"\s+", " ", TEXT)


def test_notices_inside_the_article_go():
    inner = ARTICLE.replace("</p><p>", "</p><div class='advert'>Buy this.</div><form><input></form><p>")
    assert X.extract(page(inner)).replace("\n", " ") == TEXT.replace("\n", " ")


@pytest.mark.parametrize("bad, want", [(None, ""), ("", ""), ("plain words", "plain words"), ("<p>open <b>tags", "open tags"), ("a < b and c > d", "a < b and c > d"), ("<script>x", ""), ("</p></div>words</b>", "words"), ("<div></div>", ""), ("<p>&#233;&eacute;&nbsp;x</p>", "éé x"), ("<p>a&#" + "9" * 5000 + ";b &#" + "0" * 5000 + "65; &#x" + "f" * 5000 + ";</p>", "a\ufffdb A \ufffd"), ("<p>&#00000000233;&#99999999</p>", "é\ufffd")])
def test_broken_pages(bad, want):
    assert X.extract(bad) == want


def test_very_long_pages():
    body = "<article>" + "<p>word word word</p>" * 30_000 + "</article>"
    assert X.extract(page("<nav><a>m</a></nav>" + body)) == "\n".join(["word word word"] * 30_000)
    assert X.extract("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_text_is_not_broken_by_what_is_not_shown():
    inner = "<article><p>one <script>x()</script>two three</p><p>alpha beta <svg><path/></svg> gamma</p><p>pic <img src=x> and <wbr>more</p></article>"
    assert X.extract(page(inner)) == "one two three\nalpha beta gamma\npic and more"


def test_what_lies_beside_the_article_goes():
    assert X.extract("<article><p>big</p></article><p>hello there second para outside article of some words</p>") == "big"


def test_names_that_no_page_has_shown():
    """Menus and lists of links go by their links, whatever they are called."""
    menu = "<div class=zzqx><ul>" + "<li><a href=x>Some place</a></li>" * 6 + "</ul></div>"
    prose = "<div class=qqq>" + "<p>A paragraph of a good many words that says one thing, and then another.</p>" * 4 + "</div>"
    assert X.extract(page(menu + prose + menu)) == "\n".join(["A paragraph of a good many words that says one thing, and then another."] * 4)


def brute_region(events, score):
    """All regions of all events, after the same folding by definition, from the innermost element out."""
    n = len(events)
    runs = lambda v: max(((sum(v[a:b]), -a, -b) for a in range(n) for b in range(a + 1, n + 1)), default=(0, 0, 0))
    best = runs(score)
    seed = (-best[1], -best[2] - 1) if best[0] > 0 else (0, -1)
    value, gone, stack, spans = list(score), set(), [], []
    for i, e in enumerate(events):
        if not isinstance(e, X.Block):
            spans.append((stack.pop(), i)) if not e[1] else stack.append(i)
    for a, b in spans:
        if sum(value[a : b + 1]) < 0 and not a <= seed[0] <= seed[1] <= b:
            value[a : b + 1] = [max(sum(value[a : b + 1]), -X.COST)] + [0.0] * (b - a)
            gone |= set(range(a, b + 1))
    got = runs([x for x in value])
    return set(range(-got[1], -got[2])) - gone if got[0] > 0 else set(), got[0]


@pytest.mark.parametrize("seed", range(40))
def test_best_region_is_the_maximum(seed):
    rng = np.random.default_rng(seed)
    body, depth = "", 0
    for _ in range(int(rng.integers(3, 14))):
        move = rng.integers(0, 4)
        if move == 0:
            body, depth = body + "<div>", depth + 1
        elif move == 1 and depth:
            body, depth = body + "</div>", depth - 1
        else:
            body += "words "
    events = X.Reader({}).read(body)
    score = [float(x) for x in rng.integers(-40, 40, len(events)) * 0.25]
    want, _ = brute_region(events, score)
    got = X.best_region(events, score)
    shown = lambda x: [i for i in sorted(x) if isinstance(events[i], X.Block)]
    total = lambda x: sum(score[i] for i in x if isinstance(events[i], X.Block))
    assert shown(got) == shown(want) or total(got) == pytest.approx(total(want))


def test_weights_come_from_labelled_pages():
    """What the pages learned from have outside of their article goes, under names that this module has never seen."""
    prose = "<p>A paragraph of a good many words that says one thing, and then another.</p>"
    rows = [f"<div class=wobble>{prose}</div><article>{prose * 3}<p>No {k}.</p></article><div class=wibble><p>More of this</p></div>" for k in range(30)]
    unmarked = f"<div class=wobble>{prose}</div><div>{prose * 3}</div><div class=wibble><p>More of this</p></div>"
    assert X.extract(unmarked, X.learn(rows)).count("\n") == 2 and X.extract(unmarked).count("\n") > 2
    weight, cost = X.learn(rows)
    assert weight[".wobble"] < -1 and weight["nav"] < 0 and weight[".comments"] < 0
    assert all(0 < c < 1 for c in cost.values()) and cost["article"] < 0.6


@pytest.mark.parametrize("part", ["<a ", "<div>", "<b>", "<p><b>", "</p>", "<!", "<a \"", "<script>", "<div class=a><p>x</p>", "<li><b>", "&am", "<"])
def test_long_broken_pages_take_linear_time(part):
    took = []
    for n in (100_000, 1_000_000):
        began = time.process_time()
        X.extract((part * n)[:n])
        took.append(time.process_time() - began)
    assert took[1] < 25 * max(took[0], 0.1)


def test_all_pages_of_the_table(spark):
    """The pages' articles, taken out by their own tags, which the extractor does not rely on."""
    rows = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in X.op6_html(spark, "/root/testdata/sf0.01").collect():
        inside = re.search(r"<article>(.*)</article>", rows[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)>", inside)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_frame_edges(spark):
    df = spark.createDataFrame([(1, None, None, 5), (None, "u", "<p>x", 5), (1, None, None, 5)], "page_id long, url string, html string, text int")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in X.extract_pages(df).collect()) == [("1", "", 0), ("1", "", 0), ("None", "x", 1)]
    assert X.extract_pages(df.limit(0)).count() == 0
