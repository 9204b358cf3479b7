"""The n-gram join against pairwise comparison."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rsvpark.llm import ngram_join as J
from rsvpark.llm.components import components
from rsvpark.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import DOC_SCHEMA


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.select("doc_id", "n_shingles", "component_id").collect()}


def test_query_matches_brute_force(spark, small_docs):
    assert got(QUERIES["op1_ngram_join"](spark, SF_SMALL)) == brute.near_duplicates(small_docs)


def variants(rng, n_base=14, per=12):
    """Texts around the threshold: edits, cuts and additions of base texts of many lengths."""
    docs = {}
    for _ in range(n_base):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([1, 3, 4, 5, 6, 7, 8, 9, 11, 14, 20, 33, 60, 120, 300]))]
        for _ in range(per):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 14) + 1)):
                w[rng.randrange(len(w))] = f"v{rng.randrange(9)}"
            if rng.random() < 0.4:
                w = w[: max(1, int(len(w) * rng.uniform(0.7, 1)))]
            if rng.random() < 0.4:
                w += [f"x{rng.randrange(5)}" for _ in range(rng.randrange(len(w) // 4 + 2))]
            docs[len(docs)] = (" " if rng.random() < 0.8 else "\n\t").join(w).replace("w1", rng.choice(["w1", "W1"]))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_texts_around_the_threshold(spark, seed):
    docs = variants(random.Random(seed))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs.items()], DOC_SCHEMA).repartition(5)
    assert got(J.join(df)) == brute.near_duplicates(docs)


def test_a_common_passage_and_a_family_of_near_copies(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))
    base = [f"b{i}" for i in range(80)]
    docs = {}
    for i in range(150):
        docs[i] = passage + " " + " ".join(f"u{i}_{j}" for j in range(rng.randrange(6, 60)))
    for i in range(150, 260):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(80)] = f"e{i}"
        docs[i] = " ".join(w)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert got(J.join(df)) == brute.near_duplicates(docs)


def test_nulls_empty_repeats_and_extra_columns(spark):
    t = "one two three four five six seven eight"
    rows = [(1, t, "a"), (2, t.upper(), "b"), (2, t, "b"), (3, None, "c"), (4, "", "c"), (5, " \n ", "d"), (6, "one two", "e"),
            (7, "ONE  two", "f"), (None, t, "g"), (8, "six", None), (9, "x " * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sid string").withColumn("label", df_lit())
    out = sorted((tuple(r) for r in J.join(df).collect()), key=str)
    want = [(1, 4, 1), (2, 4, 1), (2, 4, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (None, 4, None), (8, 1, 8), (9, 1, 9)]
    assert out == sorted(want, key=str)
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in J.keep_one(df).collect())
    assert [k[1] for k in kept] == [1, 3, 4, 5, 6, 8, 9, 0]
    assert J.keep_one(df).columns == df.columns


def df_lit():
    from pyspark.sql import functions as F
    return F.lit("z")


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.join(df).count() == 0 and J.keep_one(df).count() == 0


def test_pigeonhole_never_misses():
    """Any linked pair shares a bucket as soon as the larger set's credits suffice."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(3, 200))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        d = int(rng.integers(0, n // 7 + 2))
        b = np.concatenate((a[d:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 7 + 2)), dtype=np.uint64)))
        if not len(b):
            continue
        small, large = sorted((a, b), key=len)
        s = J.Sets(np.concatenate((np.sort(small), np.sort(large))), np.array([0, len(small), len(small) + len(large)]))
        common = len(np.intersect1d(a, b))
        if 4 * common < 3 * (len(a) + len(b) - common):
            continue
        own, own2, low, low2 = (c[1] for c in J.credits(s))
        band = np.searchsorted(J.BOUND, [len(small), len(large)], side="right")
        is_low = band[0] != band[1]
        have = low + low2 if is_low else own + own2
        if have < int(J.needed(np.array([len(large)]), is_low)[0]):
            continue  # crowded: compared with all sets instead
        g, key, member = J.entries(s, 1)
        sig = [{int(k) for k in key[member == i]} for i in (0, 1)]
        plain = {k >> 2 for k in sig[0] if k & 3 == J.OWN}
        deleted = {k >> 2 for k in sig[0] if k & 3 == J.OWN_DEL}
        probe, probe_del = (J.LOW, J.LOW_DEL) if is_low else (J.OWN, J.OWN_DEL)
        p = {k >> 2 for k in sig[1] if k & 3 == probe}
        q = {k >> 2 for k in sig[1] if k & 3 == probe_del}
        assert p & plain or p & deleted or q & plain


def test_comparison_of_a_block_with_all_texts(spark):
    docs = variants(random.Random(9), n_base=6, per=8)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    sets, _ = J.links(df)
    named = sets.where("n > 0")
    reps = named.groupBy("sid").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "rep")
    all_sets = named.select("sid", "n").distinct()
    links = {tuple(sorted(r)) for r in J._crowded_links(df, all_sets, reps).select("a", "b").collect()}
    sid = {r.doc_id: r.sid for r in named.collect()}
    want = set()
    s = {i: brute.shingles(t) for i, t in docs.items()}
    for i in docs:
        for j in docs:
            if i < j and s[i] != s[j] and brute.linked(s[i], s[j]):
                want.add(tuple(sorted((sid[i], sid[j]))))
    assert links == want


def test_small_sets_use_deletions():
    s = J.shingle_sets(pa.array(["a b c d e f g h i j k l", "one"]))
    filled, double, _, _ = J.credits(s)
    assert filled[0] + double[0] >= J.needed(s.n, False)[0] and double[1] == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 190)] + [(5, i) for i in range(300, 360)] + [(7, 7)]
    edges += [(rng.randrange(400, 440), rng.randrange(400, 440)) for _ in range(25)]
    df = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges], "a long, b long")
    want = brute.components({x for e in edges if e[0] != e[1] for x in e}, [e for e in edges if e[0] != e[1]])
    assert {r.id: r.label for r in components(df).collect()} == want


def test_links_of_a_unit_equal_pairwise_comparison():
    rng = np.random.default_rng(4)
    for trial in range(60):
        base = rng.integers(0, 1 << 60, rng.integers(3, 60))
        sets = []
        for _ in range(rng.integers(2, 70)):
            s = base[rng.random(len(base)) > rng.uniform(0, 0.3)]
            sets.append(np.unique(np.concatenate((s, rng.integers(0, 1 << 60, rng.integers(0, 5)), base[:1]))))
        off = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        n = np.diff(off)
        rows = rng.permutation(len(sets))
        split = len(rows) if trial % 2 else int(rng.integers(1, len(rows)))
        edges = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
                 if (split == len(rows) or i < split <= j) and brute.linked(set(sets[rows[i]].tolist()), set(sets[rows[j]].tolist()))]
        want = brute.components(range(len(rows)), edges)
        assert J._links(np.concatenate(sets), off, n, rows, split).tolist() == [want[i] for i in range(len(rows))]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(6)
    a = [np.unique(rng.integers(0, 400, rng.integers(1, 200))).astype(np.uint64) for _ in range(80)]
    s = J.Sets(np.concatenate(a), np.concatenate(([0], np.cumsum([len(x) for x in a]))))
    k = J.sketches(s)
    assert k.shape == (80, J.SKETCH)
    for i in range(80):
        for j in range(80):
            assert np.bitwise_count((k[i] ^ k[j]).view(np.uint64)).sum() <= len(np.setxor1d(a[i], a[j]))


@pytest.mark.parametrize("light,block_sets", [(0, 7), (0, 2000), (3, 5), (10 ** 9, 2000)])
def test_small_buckets_families_and_blocks_give_the_same(spark, monkeypatch, light, block_sets):
    """The same links whether buckets are paid for one by one or as families of any block size."""
    monkeypatch.setattr(J, "LIGHT", light)
    monkeypatch.setattr(J, "BLOCK_SETS", block_sets)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(70)]
    docs = {}
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(70)] = f"e{rng.randrange(40)}"
        docs[i] = " ".join(w)
    docs |= {1000 + i: t for i, t in variants(rng, n_base=5, per=8).items()}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert got(J.join(df)) == brute.near_duplicates(docs)
