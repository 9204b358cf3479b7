"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks (text between block-level tags; inline tags, scripts,
styles, titles and comments vanish; a head need not be closed).  A block is described by its word count and link
density, those of its neighbours, and what encloses it (element names, and words
in ``class``, ``id`` and ``role``).  A CART tree, trained on the small labelled
table below, says which blocks belong to the article.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea)\b(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<title\b(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>.*?(?:</title\s*>|(?=</head\b|<body\b)|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|<[!?/][^>]*>", re.S | re.I)
#: Elements that vanish with all they hold, if they are closed; of an unclosed one only the tag goes.
PAIRED = frozenset("noscript template svg math iframe object select canvas audio video map".split())
_PAIRED = re.compile(rf"<(?:{'|'.join(sorted(PAIRED))})\b", re.I)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr input picture source".split())
CONTAINERS = frozenset("article main section div nav header footer aside form ul ol dl table blockquote figure details dialog body "
                       "fieldset menu center td th tr tbody".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: What an enclosing element or hint word says.
KINDS = {
    "article": "article main articlebody story post entry prose".split(),
    "content": "content body text maincontent".split(),
    "nav": "nav navigation navbar menu menubar breadcrumb breadcrumbs toc pagination pager tabs sitemap skip".split(),
    "header": "header masthead topbar banner branding logo toolbar".split(),
    "footer": "footer copyright legal colophon imprint".split(),
    "aside": "aside sidebar widget rail related recommended recommendations complementary popular trending".split(),
    "advert": "ad ads adv advert advertisement advertorial sponsor sponsored sponsors promo promotion promoted adsbygoogle dfp "
              "commercial teaser".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay dialog newsletter subscribe subscription signup "
              "paywall share sharing social toast infobar privacy".split(),
    "form": "form search login register contactform fieldset".split(),
    "comment": "comment comments commentlist reply replies disqus discussion respond reader readers feedback responses".split(),
}
_KIND_OF = {w: k for k, ws in KINDS.items() for w in ws}
_ORDER = list(KINDS)

FEATURES = ["words", "link_density", "prev_words", "prev_link_density", "next_words", "next_link_density",
            *[f"in_{k}" for k in _ORDER], "page_article", "outside_article", "heading", "list_item", "sentence_end", "form_control"]


def _kinds(name: str, attrs: str) -> frozenset:
    got = set()
    if name in _KIND_OF:
        got.add(_KIND_OF[name])
    if attrs and "=" in attrs:
        for m in _ATTR.finditer(attrs):
            value = m[1] or m[2] or m[3] or ""
            for t in _TOKEN.findall(_CAMEL.sub(" ", value).lower()):
                if t in _KIND_OF:
                    got.add(_KIND_OF[t])
    return frozenset(got)


def _closed(page: str, tags: list) -> dict:
    """Start of each closed ``PAIRED`` element -> its end; an end tag closes the nearest open element of its name."""
    ends: dict = {}
    if _PAIRED.search(page):
        opened: dict = {}
        for m in tags:
            name = m[3] and m[3].lower()
            if name in PAIRED:
                if not m[2]:
                    if name not in ("svg", "math") or not m[4].endswith("/"):
                        opened.setdefault(name, []).append(m.start())
                elif opened.get(name):
                    ends[opened[name].pop()] = m.end()
    return ends


def blocks(page: str | None) -> list[tuple[str, int, frozenset, str]]:
    """``(text, words in links, kinds enclosing it, element)`` of the page's non-empty blocks, in page order."""
    page = page or ""
    out = []
    stack: list[tuple[str, frozenset]] = []
    inside: frozenset = frozenset()
    element, element_kinds = "", frozenset()
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    control = False
    known: dict = {}

    def flush():
        nonlocal control
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html.unescape(text)
            text = " ".join(text.split())
            if text:
                lw = len(" ".join(linked).split()) if linked else 0
                kinds = inside | element_kinds
                out.append((text, lw, kinds | {"control"} if control else kinds, element))
            parts.clear()
        linked.clear()
        control = False

    at = 0
    tags = list(_TAG.finditer(page))
    ends = _closed(page, tags)
    for m in tags:
        if m.start() < at:
            continue
        if m.start() > at:
            t = page[at:m.start()]
            parts.append(t)
            if in_link:
                linked.append(t)
        at = m.end()
        raw = m[3]
        if raw is None:
            if m[1] is not None and m[1].lower() == "textarea":
                control = True
            continue
        name = raw.lower()
        closing = m[2]
        if name in PAIRED and not closing:
            if name == "select":
                control = True
            at = ends.get(m.start(), at)
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br" or name == "img":
                parts.append(" ")
            elif name == "input":
                control = True
            continue
        if name == "button":
            control = True
        flush()
        if closing:
            if name in CONTAINERS:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        inside = stack[-1][1] if stack else frozenset()
                        break
            element, element_kinds = "", frozenset()
            in_link = 0
            continue
        attrs = m[4]
        key = (name, attrs)
        kinds = known.get(key)
        if kinds is None:
            kinds = known[key] = _kinds(name, attrs)
        if name in CONTAINERS:
            if not attrs.endswith("/"):
                inside = inside | kinds if kinds else inside
                stack.append((name, inside))
            element, element_kinds = "", frozenset()
        else:
            element, element_kinds = name, kinds
    if at < len(page):
        t = page[at:]
        cut = t.rfind("<")
        if cut >= 0 and re.match(r"</?[a-zA-Z!]", t[cut:]):
            t = t[:cut]  # a tag the page ends in
        parts.append(t)
    flush()
    return out


def features(bs: list) -> np.ndarray:
    """One row of ``FEATURES`` per block of a page."""
    n = len(bs)
    x = np.zeros((n + 2, len(FEATURES)))
    has_article = any("article" in b[2] for b in bs)
    for i, (text, lw, kinds, element) in enumerate(bs, 1):
        w = text.count(" ") + 1
        r = x[i]
        r[0] = min(w, 100)
        r[1] = min(1.0, lw / w)
        for j, k in enumerate(_ORDER):
            r[6 + j] = k in kinds
        base = 6 + len(_ORDER)
        r[base] = has_article
        r[base + 1] = has_article and "article" not in kinds
        r[base + 2] = element in HEADINGS
        r[base + 3] = element in ("li", "dt", "dd", "option")
        r[base + 4] = text[-1] in ".!?…:;\"'”»"
        r[base + 5] = "control" in kinds
    x[1:-1, 2:4], x[1:-1, 4:6] = x[:-2, 0:2], x[2:, 0:2]
    return x[1:-1]


class Tree:
    """Binary classification tree grown by Gini impurity."""

    def __init__(self, depth: int = 16, leaf: int = 2):
        self.depth, self.leaf = depth, leaf
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []

    def _node(self) -> int:
        for a, v in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            a.append(v)
        return len(self.feature) - 1

    def _grow(self, x, y, depth) -> int:
        node = self._node()
        self.value[node] = float(y.mean())
        if depth == 0 or len(y) < 2 * self.leaf or y.min() == y.max():
            return node
        n, best = len(y), (1e-9, -1, 0.0)
        gini = lambda p, m: m * p * (1 - p)
        whole = gini(y.mean(), n)
        for f in range(x.shape[1]):
            o = np.argsort(x[:, f], kind="stable")
            v, c = x[o, f], np.cumsum(y[o])
            k = np.arange(1, n)
            ok = (v[1:] > v[:-1]) & (k >= self.leaf) & (n - k >= self.leaf)
            if not ok.any():
                continue
            gain = whole - gini(c[:-1] / k, k) - gini((c[-1] - c[:-1]) / (n - k), n - k)
            gain[~ok] = -1
            i = int(gain.argmax())
            if gain[i] > best[0] + 1e-9:
                best = (gain[i], f, (v[i] + v[i + 1]) / 2)
        if best[1] < 0:
            return node
        _, f, cut = best
        low = x[:, f] <= cut
        self.feature[node], self.cut[node] = f, cut
        self.left[node] = self._grow(x[low], y[low], depth - 1)
        self.right[node] = self._grow(x[~low], y[~low], depth - 1)
        return node

    def fit(self, x, y) -> "Tree":
        self._grow(np.asarray(x, float), np.asarray(y, float), self.depth)
        for a in ("feature", "cut", "left", "right", "value"):
            setattr(self, a, np.array(getattr(self, a)))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at] >= 0.5
            go = x[np.arange(len(x)), np.maximum(f, 0)] <= self.cut[at]
            at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)


#: The labelled table: layouts of pages.  A row is (enclosing elements and element, words, words in links, times, 1 = main text).
LAYOUTS = [
    [("nav/ul/li", 1, 1, 6, 0), ("div.ad", 12, 0, 1, 0), ("article/h1", 9, 0, 1, 1), ("article/p", 40, 0, 4, 1), ("article/p", 5, 0, 2, 1),
     ("article/p", 25, 3, 1, 1), ("article/aside/p", 14, 0, 1, 0), ("article/div.ad", 10, 2, 1, 0), ("footer", 9, 1, 1, 0)],
    [("nav/ul/li", 2, 2, 4, 0), ("article/h1", 4, 0, 1, 1), ("article/p", 1, 0, 3, 1), ("article/p", 70, 0, 2, 1), ("article", 30, 0, 1, 1),
     ("article/ul/li", 8, 0, 3, 1), ("article/ul/li", 2, 0, 2, 1), ("article/blockquote/p", 18, 0, 1, 1), ("footer/p", 20, 0, 1, 0)],
    [("header/div", 3, 0, 1, 0), ("header/h1", 4, 0, 1, 0), ("header/nav/ul/li", 1, 1, 5, 0), ("div.cookie-notice/p", 25, 2, 1, 0),
     ("main/h1", 8, 0, 1, 1), ("main/p", 55, 2, 3, 1), ("main/p", 12, 0, 2, 1), ("main/h2", 4, 0, 1, 1), ("main/p", 35, 0, 2, 1),
     ("main/form/label", 6, 0, 2, 0), ("main/div.newsletter/p", 16, 0, 1, 0), ("section.comments/h2", 2, 0, 1, 0),
     ("section.comments/div/p", 30, 0, 3, 0), ("aside/h3", 2, 0, 1, 0), ("aside/ul/li", 6, 6, 4, 0), ("footer/div/p", 30, 4, 1, 0)],
    [("div#menu/ul/li", 1, 1, 6, 0), ("div.content/h1", 7, 0, 1, 1), ("div.content/p", 45, 1, 5, 1), ("div.content/p", 6, 0, 1, 1),
     ("div.content/div.share", 4, 4, 1, 0), ("div.content/div.related/a", 8, 8, 3, 0), ("div#sidebar/p", 22, 0, 2, 0),
     ("div#comments/p", 25, 0, 3, 0), ("div.reply/p", 12, 0, 1, 0), ("div#footer/p", 15, 3, 1, 0)],
    [("div/a", 2, 2, 5, 0), ("div/h1", 6, 0, 1, 1), ("div/p", 60, 2, 4, 1), ("div/p", 30, 0, 3, 1), ("div/ul/li", 4, 4, 5, 0), ("div/p", 3, 3, 2, 0)],
    [("table/tr/td", 1, 1, 5, 0), ("table/tr/td/p", 50, 0, 4, 1), ("table/tr/td/h2", 5, 0, 1, 1), ("table/tr/td/p", 22, 2, 2, 1),
     ("table/tr/td", 5, 5, 4, 0), ("center/p", 6, 4, 1, 0)],
    [("p", 35, 0, 4, 1), ("p", 12, 0, 2, 1), ("p", 60, 5, 1, 1)],
    [("h1", 6, 0, 1, 1), ("p", 25, 0, 2, 1), ("p", 4, 0, 1, 1), ("p", 33, 0, 1, 1)],
    [("div.banner/p", 14, 0, 1, 0), ("div.promo/p", 24, 1, 1, 0), ("article/header/h1", 8, 0, 1, 1), ("article/section/p", 45, 2, 3, 1),
     ("article/section/h2", 5, 0, 1, 1), ("article/section/p", 9, 0, 2, 1), ("article/figure/figcaption", 9, 0, 1, 1),
     ("article/form/p", 12, 0, 1, 0), ("article/section.comments/p", 35, 0, 3, 0), ("article/nav/ul/li", 3, 3, 3, 0),
     ("article/footer/p", 10, 3, 1, 0), ("article/div.notice/p", 20, 0, 1, 0), ("article/div.sidebar/p", 30, 0, 1, 0),
     ("div.modal/p", 30, 0, 1, 0), ("form.login/label", 2, 0, 2, 0), ("footer/ul/li", 2, 2, 5, 0)],
    [("div.header/p", 10, 0, 1, 0), ("div.navbar/ul/li", 2, 2, 4, 0), ("div.post/h1", 7, 0, 1, 1), ("div.post/p", 48, 1, 4, 1),
     ("div.post/p", 3, 0, 2, 1), ("div.post/ul/li", 6, 1, 4, 1), ("div.post/div.ads/p", 18, 0, 1, 0), ("div.post/div.comments/p", 26, 0, 4, 0),
     ("aside.sidebar/p", 40, 0, 2, 0), ("div.sponsored/p", 35, 2, 1, 0), ("div.footer/p", 25, 2, 2, 0)],
    [("header/p", 15, 0, 1, 0), ("div.alert/p", 18, 0, 1, 0), ("main/article/h1", 5, 0, 1, 1), ("main/article/p", 38, 0, 4, 1),
     ("main/article/table/tr/td", 2, 0, 4, 1), ("main/article/pre", 20, 0, 1, 1), ("main/div.related/p", 20, 0, 2, 0),
     ("main/div#disqus/p", 30, 0, 2, 0), ("main/p", 12, 0, 1, 0), ("footer", 20, 0, 1, 0)],
    [("nav/ul/li", 1, 1, 3, 0), ("article/h1", 5, 5, 1, 1), ("article/p", 9, 4, 3, 1), ("article/p", 4, 2, 2, 1), ("article/p", 3, 3, 2, 1),
     ("article/p", 14, 9, 2, 1), ("article/ul/li", 4, 4, 4, 1), ("article/ul/li", 9, 5, 2, 1), ("article/p", 30, 12, 1, 1),
     ("article/div.related/ul/li", 5, 5, 3, 0), ("article/nav/ul/li", 2, 2, 3, 0), ("footer/p", 12, 0, 1, 0)],
    [("header/nav/ul/li", 1, 1, 4, 0), ("main/h1", 5, 0, 1, 1), ("main/p", 10, 5, 2, 1), ("main/p", 4, 4, 1, 1), ("main/ul/li", 4, 4, 3, 1),
     ("main/p", 40, 15, 1, 1), ("main/aside/p", 12, 3, 2, 0), ("footer/p", 8, 4, 1, 0)],
    [("nav/ul/li", 1, 1, 4, 0), ("article/h1", 5, 0, 1, 1), ("article/p", 22, 0, 2, 1), ("article/p", 4, 0, 1, 1)],
    [("h1", 5, 0, 1, 1), ("p", 30, 0, 2, 1), ("p", 5, 0, 1, 1)], [("article/h1", 7, 0, 1, 1)], [("p", 3, 0, 1, 1)],
    [("article/h1", 6, 0, 1, 1), ("article/p", 28, 0, 1, 1), ("article/p", 20, 20, 1, 1), ("div/p", 40, 0, 2, 0), ("div/h3", 4, 0, 1, 0), ("section/p", 25, 0, 2, 0)],
]
# Every kind of surroundings, short and long and without links, on pages with and without an article.
for _k in _ORDER[2:]:
    LAYOUTS.append([(f"div.{KINDS[_k][0]}", 5, 1, 1, 0), ("div/h1", 6, 0, 1, 1), ("div/p", 40, 0, 2, 1), (f"div.{KINDS[_k][0]}/p", 5, 0, 2, 0), ("div/p", 8, 0, 1, 1),
                    (f"div.{KINDS[_k][0]}/p", 30, 0, 2, 0), ("div/p", 30, 1, 2, 1), (f"div.{KINDS[_k][0]}/p", 1, 0, 1, 0)])
    LAYOUTS.append([("article/h1", 6, 0, 1, 1), ("article/p", 40, 0, 2, 1), (f"article/div.{KINDS[_k][0]}/p", 6, 0, 2, 0), ("article/p", 8, 0, 1, 1),
                    (f"article/div.{KINDS[_k][0]}/p", 30, 0, 1, 0), ("article/p", 12, 1, 2, 1)])
LAYOUTS.append([("nav", 1, 0, 1, 0)])
LAYOUTS.append([("header", 6, 0, 1, 0), ("p", 40, 0, 3, 1), ("footer", 6, 0, 1, 0)])
SEEDS = 4
_WORDS = "stone river amber quiet lantern harbour meadow copper signal winter orchard paper violet engine summit valley".split()


def _sample_page(layout: list, rng) -> tuple[str, list[int]]:
    """A page of one layout with random words, and the label of each of its blocks."""
    out, labels = ["<!DOCTYPE html><html><head><title>x</title></head><body>"], []
    open_path: list[str] = []
    for path, n, n_link, times, label in layout:
        *outer, last = path.split("/")
        same = 0
        while same < min(len(outer), len(open_path)) and outer[same] == open_path[same]:
            same += 1
        for e in reversed(open_path[same:]):
            out.append(f"</{re.split('[.#]', e)[0]}>")
        tag = lambda e: re.sub(r"#([\w-]+)", r' id="\1"', re.sub(r"\.([\w-]+)", r' class="\1"', e))
        for e in outer[same:]:
            out.append(f"<{tag(e)}>")
        open_path = outer
        for _ in range(times):
            k = max(1, int(round(n * rng.uniform(0.6, 1.4)))) if n > 1 else 1
            ws = [str(rng.choice(_WORDS)) for _ in range(k)]
            k_link = k if n_link == n else min(k, n_link)
            body = " ".join(ws[k_link:]) + ("." if k >= 8 and rng.uniform() < 0.8 else "")
            link = f'<a href="/">{" ".join(ws[:k_link])}</a> ' if k_link else ""
            name = re.split("[.#]", last)[0]
            out.append(f"<{tag(last)}>{link}{body}</{name}>" if name != "a" else f'<div><a href="/">{" ".join(ws)}</a></div>')
            labels.append(label)
    for e in reversed(open_path):
        out.append(f"</{re.split('[.#]', e)[0]}>")
    return "".join(out) + "</body></html>", labels


def labelled_table(seeds=range(SEEDS)) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the sample pages."""
    xs, ys = [], []
    for seed in seeds:
        rng = np.random.default_rng(seed)
        for layout in LAYOUTS:
            page, labels = _sample_page(layout, rng)
            bs = blocks(page)
            assert len(bs) == len(labels), (len(bs), len(labels), layout[0])
            xs.append(features(bs))
            ys += labels
    return np.concatenate(xs), np.array(ys, float)


def train_tree() -> Tree:
    return Tree().fit(*labelled_table())


def extract_texts(pages: list, tree: Tree) -> list[str]:
    """Main text of each page; the blocks of all are classified in one go."""
    cut = [blocks(p) for p in pages]
    rows = [features(b) for b in cut if b]
    keep = tree.predict(np.concatenate(rows)) if rows else np.zeros(0, bool)
    out, at = [], 0
    for bs in cut:
        k = keep[at: at + len(bs)]
        at += len(bs)
        out.append("\n".join(b[0] for b, ok in zip(bs, k) if ok))
    return out


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page.

    Rows are independent (no shuffle).  Null and empty html, and pages without
    main text, give an empty text; repeated rows are extracted each; other
    columns are ignored.
    """
    tree = pages.sparkSession.sparkContext.broadcast(train_tree())

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                c = b.slice(i, 256)
                texts = extract_texts(c.column(2).to_pylist(), tree.value)
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
