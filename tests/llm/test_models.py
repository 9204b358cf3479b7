"""Toxicity and quality models: held-out accuracy, calibration, edge rows, and that only texts are read."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rsvpark.llm import fm_toxicity as FM
from rsvpark.llm import rff_quality as Q
from rsvpark.llm.labels import training_sample
from rsvpark.llm.queries import QUERIES, table
from tests.conftest import SF_SMALL
from tests.llm.brute import auc

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,mod,rest,least_auc,least_acc", [
    ("op3_fm_toxicity", "toxic", 5, 0, 0.75, 0.9), ("op8_rff_quality", "quality", 3, 1, 0.95, 0.95)])
def test_held_out_accuracy(spark, name, label, mod, rest, least_auc, least_acc):
    rows = QUERIES[name](spark, SF).collect()
    docs = table(spark, SF, "documents").count()
    assert len(rows) == docs
    y = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in y]
    assert auc([r.score for r in held], [y[r.doc_id] for r in held]) >= least_auc
    assert sum(r.predicted == y[r.doc_id] for r in held) >= least_acc * len(held)


@pytest.mark.parametrize("op,label", [(FM.score, "toxic"), (Q.classify, "quality")])
def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, op, label):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    mod, rest = (5, 0) if label == "toxic" else (3, 1)
    from pyspark.sql import functions as F
    from rsvpark.llm.labels import remainder
    flipped = labels.withColumn(label, F.when(remainder(mod) == rest, 1 - F.col(label)).otherwise(F.col(label)))
    odd = docs.withColumn("source", F.lit("s")).withColumn("lang", F.lit(None).cast("string")).withColumn("score", F.lit(7)).withColumn("y", F.lit(1))
    a = {r.doc_id: r.score for r in op(docs, labels).collect()}
    b = {r.doc_id: r.score for r in op(odd, flipped).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-6


@pytest.mark.parametrize("op,label", [(FM.score, "toxic"), (Q.classify, "quality")])
def test_edge_rows(spark, op, label):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b"), (5, "word " * 40_000), (6, "a b c"), (6, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    out = op(docs, none).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    odd = spark.createDataFrame([(6, 1), (6, 0), (None, 1), (5, None), (77, 0), (2, 0)], f"doc_id long, {label} int")
    assert len(op(docs, odd).collect()) == len(rows)
    assert op(docs.limit(0), odd).count() == 0


def test_sample_is_bounded_and_reproducible(spark):
    labels = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    got = [r.doc_id for r in training_sample(labels, "quality", 3, 1, 2000).collect()]
    assert 1700 < len(got) < 2300 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in got)
    assert sorted(got) == sorted(r.doc_id for r in training_sample(labels.repartition(7), "quality", 3, 1, 2000).collect())


def interaction(n_noise, seed=4):
    """Toxic only if an insult or a group mention comes without the other: neither says anything alone."""
    rng = random.Random(seed)
    texts, y = [], []
    for i in range(2400):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = [f"n{rng.randrange(n_noise)}x" for _ in range(12)] + ["slurry"] * a + ["groupies"] * b
        rng.shuffle(w)
        texts.append(" ".join(w))
        y.append(float(a != b))
    return texts, np.array(y)


@pytest.mark.parametrize("n_noise", [300, 3000])
def test_factorization_machine_learns_an_interaction(n_noise):
    texts, y = interaction(n_noise)
    ids, first, _ = FM.terms(pa.array(texts))
    cut = first[1800]
    m = FM.train(ids[:cut], first[:1801], y[:1800])
    known = set(np.flatnonzero(m.slot >= 0).tolist())
    assert set(FM.terms(pa.array(["slurry groupies"]))[0][:2].tolist()) <= known and len(known) < 40
    p = m.score(ids[cut:], first[1800:] - cut)
    assert ((p >= 0.5) == (y[1800:] > 0)).mean() > 0.95
    # without the factors nothing is left of it
    flat = FM.Model(m.bias, m.weight, np.zeros_like(m.factor), m.slot)
    q = flat.score(ids[cut:], first[1800:] - cut)
    assert ((q >= 0.5) == (y[1800:] > 0)).mean() < 0.9


def test_pairs_of_words_that_act_together_equal_plain_loops():
    texts, y = interaction(60)
    texts, y = texts[:500], y[:500]
    ids, first, n = FM.terms(pa.array(texts))
    doc = np.repeat(np.arange(n), np.diff(first))
    pair = np.unique(doc * (1 << FM.BITS) + ids)
    pair = pair[pair % 2 == 0]
    share = (y.sum() + 0.5) / (n + 1)
    sets = [set((pair[pair >> FM.BITS == i] & ((1 << FM.BITS) - 1)).tolist()) for i in range(n)]
    words = [w for w in set().union(*sets) if sum(w in s for s in sets) >= FM.PAIR_ROWS]
    rate = {w: np.mean([t for s, t in zip(sets, y) if w in s]) for w in words}
    want = set()
    for a in words:
        for b in words:
            both = [t for s, t in zip(sets, y) if a in s and b in s]
            if a < b and len(both) >= FM.PAIR_ROWS:
                excess = sum(both) - len(both) * min(1, max(0, rate[a] + rate[b] - share))
                if abs(excess) >= FM.PAIR_Z * (share * (1 - share) * len(both)) ** 0.5:
                    want |= {a, b}
    assert want and set(FM.acting_together(pair, y, share).tolist()) == want


def test_toxicity_query_equals_a_plain_double_loop(spark):
    """Every score of the query from the fitted model, pair of terms by pair of terms."""
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    m = FM.fit(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in QUERIES["op3_fm_toxicity"](spark, SF_SMALL).collect():
        ids = FM.terms(pa.array([text[r.doc_id]]))[0]
        rows = [m.slot[i] for i in ids if m.slot[i] >= 0]
        z = m.bias + sum(float(m.weight[i]) for i in rows)
        for k, i in enumerate(rows):
            for j in rows[k + 1:]:
                z += float(np.dot(m.factor[i].astype(float), m.factor[j].astype(float)))
        want = 1 / (1 + np.exp(-min(max(z, -FM.CLIP), FM.CLIP)))
        assert abs(r.score - want) < 1e-5 and r.predicted == (r.score >= 0.5)


def test_terms_fold_case_and_share_prefixes():
    one = [set(FM.terms(pa.array([t]))[0].tolist()) for t in ("Éclair IDIOT!", "éclair idiot", "idiotic", None, "...")]
    assert one[0] == one[1] and one[1] & one[2] and not one[3] and not one[4]


def test_isotonic_pools_violators():
    v = Q.isotonic(np.array([0.1, 0.5, 0.3, 0.2, 0.9]), np.array([1.0, 1, 1, 2, 1]))
    assert np.allclose(v, [0.1, 0.3, 0.3, 0.3, 0.9])


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    d = len(Q.STATS)
    x = rng.normal(size=(40, d))
    freq, phase = rng.normal(size=(d, 20_000)) / 3, rng.uniform(0, 2 * np.pi, 20_000)
    m = Q.Model(np.zeros(d), np.ones(d), freq, phase, np.zeros(20_001), np.zeros(2), np.zeros(2))
    f = m.features(x)[:, :-1]
    dist = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(f @ f.T - np.exp(-dist / 18)).max() < 0.05


def test_statistics_of_simple_texts():
    x = dict(zip(Q.STATS, Q.statistics(pa.array(["a a b\nc!\nc!", None, "A"]))[0]))
    assert x["log_words"] == np.log1p(5) and abs(x["same_as_before"] - 2 / 5) < 1e-12 and abs(x["distinct_words"] - 3 / 5) < 1e-12
    assert abs(x["dup_lines"] - 1 / 3) < 1e-12 and x["marked_words"] == 2 / 5
    assert not Q.statistics(pa.array([None, "", "  "])).any()


def test_ridge_equals_a_direct_solve(spark):
    """Weights from partition sums against one least-squares problem over the collected rows."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    m = Q.fit(docs, labels)
    sample = training_sample(labels, "quality", Q.MOD, Q.HELD_OUT, Q.MAX_LABELS).selectExpr("doc_id", "cast(y as double) as y")
    rows = (docs.select("doc_id", "text").join(sample, "doc_id").selectExpr("text", "y", "pmod(xxhash64(doc_id, 'calibrate'), 5) = 0 as held").collect())
    x = Q.statistics(pa.array([r.text for r in rows]))
    y, held = np.array([r.y for r in rows]), np.array([r.held for r in rows])
    assert np.allclose(m.mean, x.mean(0)) and np.allclose(m.scale, np.where(x.std(0) < 1e-9, 1, x.std(0)))
    w = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))[~held]
    f = m.features(x[~held])
    # ridge as least squares with a row of sqrt(RIDGE) per weight
    a = np.concatenate([f * np.sqrt(w)[:, None], np.sqrt(Q.RIDGE) * np.eye(f.shape[1])])
    b = np.concatenate([y[~held] * np.sqrt(w), np.zeros(f.shape[1])])
    assert np.allclose(m.weights, np.linalg.lstsq(a, b, rcond=None)[0], atol=1e-6)
    # calibration: the least-squares monotone fit of labels on binned raw scores, by trying every block of bins
    r = np.round(m.raw(x[held]) * Q.BINS) / Q.BINS
    knots = np.unique(r)
    assert np.allclose(m.knots, knots) and (np.diff(m.values) >= 0).all()
    per = [y[held][r == k] for k in knots]
    for i in range(0, len(knots), max(1, len(knots) // 12)):
        low = max(min(np.concatenate(per[s:e + 1]).mean() for e in range(i, len(per))) for s in range(i + 1))
        assert abs(m.values[i] - low) < 1e-9
