"""Quality rules: base counts against a scan, shares on built texts."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rsvpark.llm import repetition as R
from rsvpark.llm.queries import QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import brute


def base(m, i):
    return tuple(m[k][i].item() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_query_matches_brute_force(spark, small_docs):
    rows = QUERIES["op2_repetition"](spark, SF_SMALL).collect()
    assert len(rows) == len(small_docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(small_docs[r.doc_id])
        share = brute.repetition_shares(small_docs[r.doc_id])
        assert all(abs(r[f"share_{k}"] - v) < 1e-9 for k, v in share.items())
        assert r.kept == (not r.base_failed and all(share[k] <= v for k, v in zip(R.SHARES, R.LIMITS)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é#\n\t \r", max_size=60)), min_size=1, max_size=8))
def test_base_counts(texts):
    m = R.measure(pa.array(texts, pa.string()))
    assert [base(m, i) for i in range(len(texts))] == [brute.base_rules(t) for t in texts]


def test_shares_of_built_texts():
    plain = " ".join(f"w{i}" for i in range(200))
    line = "\n".join(["same old line of words here"] * 30)
    mostly = plain + " " + " ".join(["spam eggs ham rice"] * 30)
    m = R.measure(pa.array([plain, line, mostly, plain + "\n" + " ".join(f"w{i}" for i in range(0, 15))]))
    assert m["kept"].tolist() == [True, False, False, True]
    assert all(m[f"share_{s}"][0] == 0 for s in R.SHARES)
    assert m["share_dup_lines"][1] == 29 / 30 and abs(m["share_dup_5"][1] - 29 / 30) < 1e-12
    # fifteen of 215 words repeat fifteen others
    chars = sum(len(f"w{i}") for i in range(15))
    total = sum(len(f"w{i}") for i in range(200)) + chars
    assert abs(m["share_dup_10"][3] - chars / total) < 1e-12
    assert abs(m["share_top_2"][2] - max(29 * 8, 28 * 8) / m["word_chars"][2]) < 0.01


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=80), min_size=1, max_size=5))
def test_shares_equal_plain_loops(texts):
    m = R.measure(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert all(abs(m[f"share_{k}"][i] - v) < 1e-9 for k, v in brute.repetition_shares(t).items())


@pytest.mark.parametrize("kind", ["passage", "lines", "sprinkled", "phrase"])
def test_planted_repetition_past_the_base_rule_is_rejected(small_docs, kind):
    """Real documents that pass, with less than half of their words repeated."""
    docs = [t for t in small_docs.values() if t and len(t.split()) > 80]
    whole = R.measure(pa.array(docs))
    docs = [t for t, k, r, n in zip(docs, whole["kept"], whole["n_repeat_words"], whole["n_words"]) if k and r < 0.05 * n][:60]
    assert len(docs) > 30
    out = []
    for t in docs:
        w = t.split()
        if kind == "passage":           # a quarter of the text again
            out.append(t + " " + " ".join(w[:len(w) // 4]))
        elif kind == "lines":           # a line, again and again
            line = " ".join(w[:8])
            out.append(t + ("\n" + line) * max(3, len(w) // 25))
        elif kind == "sprinkled":       # twelve words between the others
            part = " ".join(w[:12])
            step = 30
            out.append(" ".join(x for i in range(0, len(w), step) for x in (*w[i:i + step], part)))
        else:                           # a short phrase
            out.append(t + " buy it now" * max(2, len(w) // 8))
    m = R.measure(pa.array(out))
    past = ~m["base_failed"]
    assert past.mean() > 0.9 and (~m["kept"])[past].mean() > 0.95


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").join(spark.read.parquet(f"{SF_ORACLE}/labels.parquet").where("quality = 1"), "doc_id")
    rows = [r for r in R.repetition(docs).collect() if not r.base_failed]
    assert sum(r.kept for r in rows) >= 0.99 * len(rows) > 0


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (None, "a b", 0), (5, "x " * 50_000, 1), (5, "x " * 50_000, 1)]
    out = R.repetition(spark.createDataFrame(rows, "doc_id long, text string, kept int")).collect()
    assert sorted((r.n_words, r.kept) for r in out) == [(0, False)] * 3 + [(2, False)] + [(50_000, False)] * 2
    assert R.repetition(spark.createDataFrame([], "doc_id long, text string")).count() == 0
