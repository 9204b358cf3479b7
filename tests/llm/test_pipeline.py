"""The corpus pipeline: each stage against brute force on what it got."""

import collections

import pytest

import corpus_pipeline as P
from rsvpark.llm import lookup_shards, mix_schedule, rff_quality
from rsvpark.llm.queries import table
from rsvpark.session import materialize
from tests.conftest import SF_SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage on the small tables."""
    docs = table(spark, SF_SMALL, "documents")
    out = []
    for name, stage in P.STAGES:
        after = materialize(stage(spark, docs, SF_SMALL), "test-pipeline")
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(spark, steps):
    cols = table(spark, SF_SMALL, "documents").columns
    assert len(P.STAGES) == 5 and all(after.columns == cols for _, _, after in steps[:-1])
    assert steps[-1][2].columns == [*cols, "slot", "shard"]


def test_quality_keeps_what_the_classifier_accepts(spark, steps):
    _, before, after = steps[0]
    verdict = {r.doc_id: r.predicted for r in rff_quality.classify(before, table(spark, SF_SMALL, "labels")).collect()}
    assert set(texts(after)) == {i for i, p in verdict.items() if p}
    y = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
    assert sum(i in texts(after) for i, q in y.items() if q) >= 0.95 * sum(y.values())


def test_one_of_each_group_stays(steps):
    _, before, after = steps[1]
    comp = brute.near_duplicates(texts(before))
    assert set(texts(after)) == {c for _, c in comp.values()}


def test_leaks_go(spark, steps):
    _, before, after = steps[2]
    from tests.llm.test_lsa_decontam import contained
    items = {r.item_id: r.text for r in table(spark, SF_SMALL, "benchmark").collect()}
    leaked = {i for i, _ in contained(texts(before), items)}
    gone = set(texts(before)) - set(texts(after))
    assert leaked <= gone and len(gone - leaked) <= 2


def test_mix_repeats_documents(steps):
    _, before, after = steps[3]
    taken = {r.doc_id: -(-r.taken // r.size) if r.size else 0 for r in mix_schedule.mix(before).collect()}
    n = collections.Counter(r.doc_id for r in after.collect())
    assert n == collections.Counter({i: k for i, k in taken.items() if k})


def test_every_row_has_its_shard(steps):
    _, before, after = steps[4]
    t = lookup_shards.fill_table(lookup_shards.shard_names())
    rows = after.collect()
    assert len(rows) == before.count() and all(t[r.slot] == r.shard for r in rows)


def test_empty_documents(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), "test-empty")
        assert docs.count() == 0, name
