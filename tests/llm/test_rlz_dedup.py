"""Substring dedup against an index of all windows."""

import random

import pytest

from rsvpark.llm import rlz_dedup as Z
from rsvpark.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_query_matches_brute_force(spark, small_docs):
    assert got(QUERIES["op6_rlz_dedup"](spark, SF_SMALL)) == sorted(brute.cut_repeats(list(small_docs.items())), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_pieced_together_texts(spark, seed):
    """Documents made of overlapping stretches of others, some a word short of the window."""
    rng = random.Random(seed)
    pool = [[f"w{rng.randrange(60 if k % 3 == 0 else 5000)}" for _ in range(200)] for k in range(6)]
    docs = []
    for i in range(90):
        w = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(pool)
            a = rng.randrange(150)
            w += p[a:a + rng.choice([20, 49, 50, 51, 80, 150])]
            if rng.random() < 0.4:
                w += [f"u{i}"]
        docs.append((i if i % 11 else i // 2, (" " if i % 2 else " \n ").join(w)))
    docs += [(500, docs[3][1]), (500, docs[3][1]), (None, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert got(Z.dedup(df)) == sorted(brute.cut_repeats(docs), key=str)


def test_nulls_empty_long_and_extra_columns(spark):
    long = " ".join(f"x{i % 97}" for i in range(60_000))
    rows = [(1, long, 1), (2, long, 2), (3, None, 3), (4, "", 4), (5, " ".join(["a"] * 200), 5), (6, " ".join(["a"] * 70), 6), (7, "é É", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, th int")
    assert got(Z.dedup(df)) == sorted(brute.cut_repeats([(r[0], r[1]) for r in rows]), key=str)
    texts = {r.doc_id: r.kept_text for r in Z.dedup(df).collect()}
    assert texts[2] == "" and texts[7] == "é É" and texts[1] == long
    assert Z.dedup(df.limit(0)).count() == 0


def test_equal_windows_have_equal_anchors():
    import pyarrow as pa
    from rsvpark.llm.words import words
    rng = random.Random(8)
    shared = [f"s{rng.randrange(30)}" for _ in range(75)]
    a = " ".join([f"a{i}" for i in range(33)] + shared + ["z"] * 20)
    b = " ".join(["q"] * 61 + shared + [f"b{i}" for i in range(9)])
    w = words(pa.array([a, b]))
    doc, lo, n, anchor, content = Z.reference_blocks(w)
    at = [{}, {}]
    for d, s, k, g in zip(doc, lo, n, anchor):
        for i in range(s, s + k):
            at[d][i - w.first[d]] = g
    for i in range(75 - 50 + 1):
        assert at[0][33 + i] == at[1][61 + i]
