"""Page extraction: held-out layouts, the test pages, and hard markup."""

import html
import re

import numpy as np
import pytest

from rsvpark.llm import html_blocks as H
from rsvpark.llm.queries import QUERIES, table
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def tree():
    return H.train_tree()


def text_of(page, tree):
    return H.extract_texts([page], tree)[0]


def test_other_samples_of_the_layouts(tree):
    x, y = H.labelled_table(range(100, 110))
    assert (tree.predict(x) == (y > 0)).mean() > 0.98


def test_query_gives_the_articles(spark):
    rows = {r.page_id: r for r in QUERIES["op10_html_blocks"](spark, SF_SMALL).collect()}
    for p in table(spark, SF_SMALL, "pages").collect():
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = [re.sub(r"<[^>]+>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in parts) if b)
        assert rows[p.page_id].text == want and rows[p.page_id].n_chars == len(want) and rows[p.page_id].url == p.url


PAGE = """<!doctype html><html><head><title>Title here</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home</a> <span>The daily page of things</span></header>
<nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport today</a></li></ul></nav>
<div class="cookie-banner">We use cookies to make this site better, please accept them all now.</div>
<main><article><h1>A short &amp; plain title</h1>
<p>First   paragraph with <b>bold</b>, <a href="/x">a link</a> and
more words that go on for a while.</p><script>var a = "<p>not text</p>";</script>
<p>Tiny.</p><ul><li>one item</li><li>another <i>item</i></li></ul>
<div class="ad">Buy this thing now, it is very cheap indeed today.</div>
<p>Last &#233; paragraph &mdash; it has a fair number of words as well.<!-- <p>hidden</p> --></p>
<form><label>Your mail</label><input><button>Send it</button></form></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I read this and I liked what it says about all the words.</p></div></section></main>
<aside class="sidebar"><p>Other stories that you may want to read some other time.</p></aside>
<footer>&copy; 2024 The page, all rights reserved by someone or other.</footer></body></html>"""


def test_open_head_and_unclosed_elements_lose_nothing(tree):
    want = text_of(PAGE, tree)
    assert "First paragraph" in want and "Last" in want
    assert text_of(PAGE.replace("</head>", ""), tree) == want
    assert text_of(PAGE.replace("</head>", "").replace("<body>", "").replace("</body>", ""), tree) == want
    assert text_of(PAGE.replace("</title>", "", 1).replace("<style>p{}</style>", ""), tree) == want
    for name in sorted(H.PAIRED):
        assert text_of(PAGE.replace("<main>", f"<{name} x='1'><main>"), tree) == want
        later = f"<footer><{name}>not text</{name}>"
        assert text_of(PAGE.replace("<main>", f"<{name}><main>").replace("<footer>", later), tree) == want
        inner = f"<{name}><{name}>not text</{name}> nor this</{name}>"
        assert text_of(PAGE.replace("<p>Tiny.", f"<p>{inner}Tiny."), tree) == want
    assert text_of(PAGE.replace("<p>Tiny.", "<p><svg/>Tiny.<svg><path/></svg>"), tree) == want

WANT = ["A short & plain title", "First paragraph with bold, a link and more words that go on for a while.", "Tiny.", "one item", "another item",
        "Last é paragraph — it has a fair number of words as well."]


def test_a_full_page(tree):
    assert text_of(PAGE, tree).split("\n") == WANT


def test_a_page_without_semantic_elements(tree):
    page = re.sub(r"<(/?)(?:main|article)>", r"<\1div>", PAGE).replace("<div><div>", '<div class="content"><div>')
    assert text_of(page, tree).split("\n") == WANT


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<a href='x", "<!--", "<script>x", "</div></p>", "<p>" * 5000, "<div class=\"" + "a" * 9999,
                                  "&#xFFFFFFFF; &bogus; &amp", "<p>a" + "<b>" * 3000 + "z", "x" * 300_000, "<" * 50_000, "<a " * 20_000, "<p a='" * 5000])
def test_broken_markup_never_fails(tree, page):
    assert isinstance(text_of(page, tree), str)


def test_edge_rows(spark):
    rows = [(1, None, None, 3), (2, "u", "", 3), (None, "u", "<article><p>One two three four five.</p></article>", 3),
            (4, "u", "<article><p>" + "word " * 50_000 + "</p></article>", 3), (4, "u", "<nav>a</nav>", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = sorted(((r.page_id or 0, r.url, r.n_chars, r.text[:8]) for r in H.extract(df).collect()), key=str)
    assert out == sorted([(1, None, 0, ""), (2, "u", 0, ""), (0, "u", 24, "One two "), (4, "u", 249_999, "word wor"), (4, "u", 0, "")], key=str)
    assert H.extract(df.limit(0)).count() == 0


def test_tree_learns_a_rule():
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(400, 4))
    y = ((x[:, 1] > 0.4) & (x[:, 3] < 0.7)).astype(float)
    t = H.Tree().fit(x[:300], y[:300])
    assert (t.predict(x[300:]) == (y[300:] > 0)).mean() > 0.95
