"""Spark string rules against plain-Python statements of the same rules,
on generated strings full of Unicode spaces, brackets and separators."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rsvpark.functions import text as T

ALPHABET = ["a", "B", "x", " ", "　", "\xa0", "\t", "\n", "|", ",", ";", "（", "）", "学", "-", "—", "–", "."]
CELLS = st.lists(st.text(alphabet=st.sampled_from(ALPHABET), max_size=16), min_size=150, max_size=150)


def m_strip_translation(s: str) -> str:
    body = s.rstrip()
    if body.endswith("）"):
        inner = body[:-1]
        last_close = inner.rfind("）")
        start = inner.find("（", last_close + 1)
        if start != -1:
            return body[:start].strip() or s
    return s.strip() or s


def m_choice_picks(s: str) -> list[str]:
    out: list[str] = []
    for piece in s.split("|"):
        if piece.strip():
            label = m_strip_translation(piece.strip())
            if label not in out:
                out.append(label)
    return out


def m_multiselect(s: str) -> list[str]:
    pieces = s.split("|") if "|" in s else re.split("[,;]", s)
    labels = [m_strip_translation(p.strip()) for p in pieces]
    return [x for x in labels if x]


def m_shorten(s: str) -> str:
    for sep in (" — ", " – ", " - "):
        if sep in s:
            return s[: s.index(sep)].strip()
    words = s.split()
    return s if len(words) <= 6 else " ".join(words[:6]) + "…"


@settings(max_examples=3, deadline=None)
@given(CELLS)
def test_string_rules_match_python(spark, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, s string")
    out = df.select(
        "i", "s",
        T.strip_ws("s").alias("strip"),
        T.strip_translation(T.strip_ws("s")).alias("tr"),
        T.choice_picks("s").alias("picks"),
        T.multiselect_labels("s").alias("multi"),
        T.part_count("s").alias("parts"),
        T.shorten_label("s").alias("short"),
        T.is_blank("s").alias("blank"),
    ).orderBy("i").collect()
    for r in out:
        s = r.s
        assert r.strip == s.strip(), repr(s)
        assert r.tr == m_strip_translation(s.strip()), repr(s)
        assert list(r.picks) == m_choice_picks(s), repr(s)
        assert list(r.multi) == m_multiselect(s), repr(s)
        assert r.parts == len(s.split("|") if "|" in s else re.split("[,;]", s)), repr(s)
        assert r.short == m_shorten(s), repr(s)
        assert r.blank == (s.strip() == ""), repr(s)


def test_percent_rounding_is_half_even(spark):
    from rsvpark.functions.fmt import pct_even, pct_half_up
    rows = [(n, d) for d in range(1, 41) for n in range(0, d + 1)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", pct_even("n", "d").alias("e"), pct_half_up("n", "d").alias("u")).collect()
    for r in got:
        assert r.e == round(r.n / r.d * 100)
        x = r.n / r.d * 100
        assert r.u == int(x + 0.5) if x >= 0 else True
    z = spark.createDataFrame([(3, 0)], "n long, d long").select(pct_even("n", "d").alias("p")).collect()
    assert z[0].p == 0


def test_html_escape_and_slug(spark):
    import html
    df = spark.createDataFrame([("<a href='x'>&\"</a>", "..My  file (v2).final")], "h string, stem string")
    r = df.select(T.html_escape("h").alias("e"), T.slug("stem").alias("sl")).collect()[0]
    assert r.e == html.escape("<a href='x'>&\"</a>")
    assert r.sl == "My-file-v2-final"
    assert df.select(T.slug(F.lit("---")).alias("s")).collect()[0].s == "event"


PAD = [" ", "　", "\xa0", "\t", "\n", ".", "!", "?", "。", "！", "？", "…", "a", "学"]
FILLER_CELLS = st.lists(
    st.tuples(st.text(alphabet=st.sampled_from([" ", "\t", "　", "\n"]), max_size=60),
              st.sampled_from(T.K.FILLER_ANSWERS + ["No", "N/A", "NONE", "Just Curious", "question", ""]),
              st.text(alphabet=st.sampled_from(PAD), max_size=80)).map("".join),
    min_size=150, max_size=150)


def m_filler(s: str) -> bool:
    punct = re.escape(T.K.FILLER_TRAILING_PUNCT)
    return re.sub(f"[{punct}]+$", "", s.strip().lower()).strip() in T.K.FILLER_ANSWERS


@settings(max_examples=3, deadline=None)
@given(FILLER_CELLS)
def test_filler_rule_matches_python(spark, cells):
    """The shape precheck never rejects a filler answer, however long its
    whitespace and punctuation tail."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, s string")
    out = df.select("i", "s", T.is_filler("s").alias("f"), T.is_blank("s").alias("b")).orderBy("i").collect()
    for r in out:
        assert r.f == m_filler(r.s), repr(r.s)
        assert r.b == (r.s.strip() == ""), repr(r.s)


def test_filler_rule_on_long_texts(spark):
    cells = ["No" + " \n" * 3000 + "?!…", "　" * 500 + "没有" + "。" * 400, "no " + "x" * 5000,
             "x" * 10000, " " * 9000, "Nothing yet" + " " * 100 + "." * 100 + " a"]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, s string")
    got = [(r.f, r.b) for r in df.select("i", T.is_filler("s").alias("f"), T.is_blank("s").alias("b"))
           .orderBy("i").collect()]
    assert got == [(m_filler(s), s.strip() == "") for s in cells]
    assert [f for f, _ in got] == [True, True, False, False, False, False]
