"""Decontamination: planted leaks, the subspace against a dense SVD, LCS against dynamic programming."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rsvpark.llm import lsa_decontam as L
from rsvpark.llm.queries import QUERIES, table
from tests.conftest import SF_SMALL
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def contained(docs, items):
    norm = lambda t: " " + " ".join(brute.word_list(brute.fold(t))) + " "
    texts = {i: norm(t) for i, t in docs.items()}
    return {(i, j) for j, t in items.items() if t for i, x in texts.items() if norm(t) in x}


def test_every_planted_passage_is_found_and_clean_documents_stay(spark):
    for sf in (SF_SMALL, SF):
        docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
        items = {r.item_id: r.text for r in table(spark, sf, "benchmark").collect()}
        rows = QUERIES["op4_lsa_decontam"](spark, sf).collect()
        got = {(r.doc_id, r.item_id) for r in rows}
        assert contained(docs, items) <= got
        for r in rows:
            # what is more holds most of the item in order
            w = brute.word_list(brute.fold(items[r.item_id]))
            text = brute.word_list(brute.fold(docs[r.doc_id]))
            near = text[max(0, r.word - len(w)): r.word + 64 + len(w)]
            assert brute.lcs(w, near) >= L.LCS_WITH_ANSWER * len(w)
        assert len(got) <= 1.15 * len(contained(docs, items)) + 2


def test_paraphrases_and_block_wise_items(spark):
    rng = random.Random(6)
    vocab = [f"word{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = {i: text(rng.choice([20, 35, 50, 150])) for i in range(30)}
    docs, want = {}, set()
    for i in range(120):
        w = text(rng.randrange(0, 300))
        if i % 4 == 0:
            j = rng.randrange(30)
            q = [x if rng.random() < 0.9 else rng.choice(vocab) for x in items[j]]
            w = w + q + text(rng.randrange(0, 200))
            want.add((i, j))
        docs[i] = " ".join(w)
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame([(j, " ".join(w)) for j, w in items.items()], "item_id long, text string")
    one = {(r.doc_id, r.item_id) for r in L.leaks(d, b).collect()}
    assert len(one & want) >= 0.9 * len(want) and not one - want
    from pyspark.sql import functions as F
    blocks = L.flag(d, b, ["doc_id"], item_block=8).select("doc_id", F.explode("__leaks.item_id").alias("item_id"))
    assert len({tuple(r) for r in blocks.collect()} & want) >= 0.9 * len(want)
    assert {r.doc_id for r in L.clean(d, b).collect()} == set(docs) - {i for i, _ in one}


def accepted(item, stretch, answer_at):
    n = len(item)
    covered = brute.lcs(item, stretch) / n
    answer = brute.lcs(item[answer_at:], stretch) / max(1, n - answer_at)
    return covered >= L.LCS_ALONE or (covered >= L.LCS_WITH_ANSWER and answer >= L.ANSWER)


def test_thousands_of_short_items_verbatim_and_with_three_tenths_replaced(spark):
    rng = random.Random(11)
    weights = [1 / (i + 3) for i in range(4000)]
    text = lambda n: [f"w{i}" for i in rng.choices(range(4000), weights, k=n)]
    items = {i: text(15) for i in range(3000)}
    docs, want = {}, set()
    for i in range(300):
        j = rng.randrange(3000)
        q = items[j] if i % 2 else [x if rng.random() < 0.7 else text(1)[0] for x in items[j]]
        docs[i] = " ".join(text(rng.randrange(40, 200)) + q + text(rng.randrange(40, 200)))
        if accepted(items[j], q, L.answer_start(" ".join(items[j]))):
            want.add((i, j))
    assert sum(i % 2 == 0 for i, _ in want) > 50
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame([(j, " ".join(w)) for j, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in L.leaks(d, b).collect()}
    assert not want - got


def brute_leaks(text, item, answer_at):
    return any(accepted(item, text[i:i + 2 * len(item)], answer_at) for i in range(len(text)))


def test_counted_candidates_equal_every_stretch(spark):
    rng = random.Random(2)
    text = lambda n: [f"w{rng.randrange(12)}" for _ in range(n)]
    items = [text(rng.choice([1, 2, 3, 4, 5, 9, 16, 17, 33, 40])) for _ in range(25)]
    docs = [text(rng.choice([0, 1, 8, 31, 32, 33, 64, 65, 130])) for _ in range(40)]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    m = L.fit(d, [(j, " ".join(w)) for j, w in enumerate(items)])
    m.items[:] = 0      # the subspace finds nothing
    import pyarrow as pa
    got = {(i, x[0]) for i, g in enumerate(L.find_leaks(pa.array([" ".join(w) for w in docs]), m)) for x in g}
    want = {(i, j) for i, t in enumerate(docs) for j, w in enumerate(items) if brute_leaks(t, w, L.answer_start(" ".join(w)))}
    assert want and got == want


def test_term_weights_come_from_all_documents(spark):
    rng = random.Random(4)
    docs = [[f"w{rng.randrange(200)}" for _ in range(rng.randrange(0, 150))] for _ in range(400)]
    items = [(0, "w1 w2 w3 w4 unseen."), (1, "w5 w6 w7")]
    passages = [set(w[i:i + L.PIECE]) for w in docs + [t.split() for _, t in items] for i in range(0, len(w), L.PIECE)]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(5)
    m = L.fit(d, items, sample_docs=40)
    from rsvpark.llm.words import words
    import pyarrow as pa
    names = [f"w{i}" for i in range(200)] + ["unseen.", "never"]
    slots = L._slots(words(pa.array(names)).hash)
    assert len(set(slots.tolist())) == len(names)
    for name, slot in zip(names, slots):
        want = np.log((1 + len(passages)) / (1 + sum(name in p for p in passages))) ** 2
        assert np.isclose(m.mass[slot], want, rtol=1e-5)


def test_edge_rows(spark):
    item = "the quick brown fox jumps over the lazy dog near the old river bank today"
    docs = [(1, None, 1), (2, "", 1), (3, " \n", 1), (4, item, 1), (4, item, 1), (None, "x " + item + " y", 1), (5, "z " * 30_000, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "  "), (None, "one"), (4, "")], "item_id long, text string")
    rows = [(r.doc_id, r.item_id) for r in L.leaks(d, b).collect()]
    assert sorted(rows, key=str) == sorted([(4, 1)] * 4 + [(None, 1)] * 2, key=str)
    assert L.clean(d, b).columns == d.columns and L.clean(d, b).count() == 4
    assert L.leaks(d, b.limit(0)).count() == 0 and L.leaks(d.limit(0), b).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=40))
def test_lcs(a, b):
    assert L.lcs(np.array(a, np.uint64), np.array(b, np.uint64)) == brute.lcs(a, b)


def test_subspace_matches_dense_svd(spark):
    rng = np.random.default_rng(1)
    n_terms, rows = 40, []
    for _ in range(120):
        slots = np.sort(rng.choice(n_terms, 6, replace=False))
        rows.append((slots.tolist(), rng.integers(1, 4, 6).tolist()))
    df = spark.createDataFrame(rows, "slot array<int>, n array<int>").repartition(3)
    idf, col = np.zeros(1 << L.BITS), np.full(1 << L.BITS, -1, np.int32)
    idf[:n_terms], col[:n_terms] = rng.uniform(0.5, 2, n_terms), np.arange(n_terms)
    a = np.zeros((120, n_terms))
    for i, (s, c) in enumerate(rows):
        a[i, s] = np.array(c) * idf[s]
    a /= np.linalg.norm(a, axis=1)[:, None]
    v = L.randomised_svd(df, idf, col, n_terms, rank=40)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(np.linalg.norm(a @ v, axis=0), s[: v.shape[1]], atol=1e-6)
    low = L.randomised_svd(df, idf, col, n_terms, rank=5)
    assert np.linalg.norm(a @ low) > 0.97 * np.linalg.norm(s[:5])


def test_subspace_comes_from_all_documents(spark):
    rng = random.Random(6)
    docs = [[f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 80))] for _ in range(2500)]
    items = [(0, " ".join(f"w{i}" for i in range(9))), (1, "w20 w21 unseen.")]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(5)
    total, df = L.statistics(d, spark.createDataFrame(items, "item_id long, text string"))
    df[:] = np.minimum(df, 8)       # no term is a stop word
    m = L.fit(d, items, rank=200, stats=(total, df))
    from rsvpark.llm.words import words
    import pyarrow as pa
    names = [f"w{i}" for i in range(60)] + ["unseen."]
    slot = dict(zip(names, L._slots(words(pa.array(names)).hash).tolist()))
    idf = np.log((1 + total) / (1 + df))
    rows = [w[i:i + L.PIECE] for w in docs + [t.split() for _, t in items] for i in range(0, len(w), L.PIECE)]
    a, every = np.zeros((len(rows), len(m.fold))), np.zeros(len(rows))
    for i, w in enumerate(rows):
        for x in set(w):
            v = w.count(x) * idf[slot[x]]
            every[i] += v * v
            if m.col[slot[x]] >= 0:
                a[i, m.col[slot[x]]] = v
    a /= np.sqrt(every)[:, None]
    v = m.fold / idf[np.flatnonzero(m.col >= 0)][np.argsort(m.col[m.col >= 0])][:, None]
    assert len(rows) == total and np.allclose(np.linalg.norm(a @ v, axis=0), np.linalg.svd(a, compute_uv=False)[: v.shape[1]], rtol=1e-4)


def test_products_are_cut_to_pieces():
    import pyarrow as pa
    lists = pa.ListArray.from_arrays(pa.array([0, 3, 3, 3 + L.GRAM_CELLS + 5, 4 + L.GRAM_CELLS + 5], pa.int32()), pa.array(np.arange(L.GRAM_CELLS + 9), pa.int32()))
    whole = pa.RecordBatch.from_arrays([lists, lists], ["slot", "n"])
    for b in (whole, whole.slice(1)):
        got = list(L._pieces([b]))
        assert len(got) > 1 and pa.Table.from_batches(got).to_pylist() == b.to_pylist()


def test_answer_is_the_last_sentence():
    words = lambda t: t.split()[L.answer_start(t):]
    assert words("What is it? A red fox.") == ["A", "red", "fox."]
    assert words("Some question\nthe answer") == ["the", "answer"]
    assert words("a b c d e f g h i j") == ["i", "j"]


def test_products_with_the_matrix_are_sums_over_its_counts():
    """Equal to the dense product, and no piece fills a matrix of passages by terms."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    rng = np.random.default_rng(4)
    n_terms, n = 3000, 1500
    rows = [np.sort(rng.choice(n_terms, rng.integers(1, 9), replace=False)) for _ in range(n - 1)] + [np.arange(n_terms)]
    off = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    slot = np.concatenate(rows).astype(np.int32)
    count, rest = rng.integers(1, 4, len(slot)).astype(np.int32), rng.random(n)
    b = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(off, pa.array(slot)), pa.ListArray.from_arrays(off, pa.array(count)), pa.array(rest)], ["slot", "n", "rest"])
    idf, z = 1 + rng.random(n_terms), rng.normal(size=(n_terms, 7))
    col = np.where(np.arange(n_terms) % 5 > 0, np.cumsum(np.arange(n_terms) % 5 > 0) - 1, -1)
    z = z[: col.max() + 1]
    a = np.zeros((n, n_terms))
    a[np.repeat(np.arange(n), np.diff(off)), slot] = count * idf[slot]
    a /= np.sqrt((a ** 2).sum(axis=1) + rest)[:, None]
    a = a[:, col >= 0]
    model = SimpleNamespace(value=(idf, col, z))
    list(L._gram_batches(model)([b]))
    tracemalloc.start()
    parts = list(L._gram_batches(model)([b]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.zeros_like(z)
    for x in parts:
        for i, m in zip(x["i"].to_pylist(), x["m"].to_pylist()):
            m = np.frombuffer(m).reshape(-1, z.shape[1])
            got[i:i + len(m)] += m
    assert np.allclose(got, a.T @ (a @ z)) and most < 3 << 20


def test_tiles_of_a_short_text_take_little_memory():
    """Arrays of the count are as long as the text's tiles, not as a full block of cells."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    from rsvpark.llm.words import words
    item = words(pa.array([" ".join(f"q{i}" for i in range(20))]), lower=True).hash
    w = words(pa.array([" ".join(f"x{i}" for i in range(100)) + " " + " ".join(f"q{i}" for i in range(20)), "q1 q2", ""]), lower=True)
    m = SimpleNamespace(counted=L.counted([item], np.zeros(1 << L.BITS)))
    pos = np.arange(len(w.hash)) - w.first[w.doc]
    args = (w, L._slots(w.hash), pos, m)
    list(L._counted_places(*args))
    tracemalloc.start()
    got = list(L._counted_places(*args))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(d, i) for d, i, *_ in got} == {(0, 0)} and most < 1 << 20


def test_sums_of_blocks_are_those_of_reduceat():
    rng = np.random.default_rng(2)
    fold = rng.normal(size=(50, 128)).astype(np.float32)
    n = np.concatenate([np.arange(1, L.STRIDE + 1), rng.integers(1, L.STRIDE + 1, 200)])
    first = np.cumsum(n) - n
    c = rng.integers(0, 50, int(n.sum()))
    assert np.array_equal(L._block_sums(fold, c, first), np.add.reduceat(fold[c], first, axis=0))
