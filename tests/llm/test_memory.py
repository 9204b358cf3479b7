"""What a task of the pipeline's first stages holds at once, and the sums that move whole."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rsvpark.llm import ngram_join, rff_quality
from rsvpark.session import ARROW_BYTES, bound_batches

MB = 1 << 20


def batch_sizes(df):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], ["n", "bytes"])
    return df.coalesce(1).mapInArrow(sizes, "n long, bytes long").collect()


def long_texts(spark, n):
    return spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('word', id, ' '), 5000)").alias("text"))


def test_batches_of_long_texts_are_bounded(spark):
    docs = long_texts(spark, 600)
    rows = rff_quality.document_statistics(docs)
    got = batch_sizes(docs)
    assert sum(r.n for r in got) == 600 and sum(r.bytes for r in got) > 20 * MB
    assert max(r.bytes for r in got) <= 2 * ARROW_BYTES
    assert rows.count() == 600


def test_a_session_with_smaller_batches_keeps_them(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for own in ("65536", "64k", "1mb"):
            spark.conf.set(key, own)
            bound_batches(spark)
            assert spark.conf.get(key) == own
        for other in ("64m", str(64 * MB), "1gb"):
            spark.conf.set(key, other)
            bound_batches(spark)
            assert spark.conf.get(key) == str(ARROW_BYTES)
    finally:
        spark.conf.set(key, before)


def peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_what_a_worker_holds(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10 ** 6, 400)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    entries, most = peak(lambda: list(ngram_join._entry_batches(8)([batch.select(["text"])])))
    assert most < 60 * MB, most
    whole = ngram_join.shingle_sets(pa.array(texts))
    n = sum(len(k.as_py()) // 6 for b in entries for k in b.column(1))
    assert n == len(ngram_join.entries(whole, 8)[1])


def test_matrix_sums_move_whole(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(500, 5)), rng.integers(0, 2, 500).astype(float)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(7)
    seen = []
    applied = type(df.groupBy("y")).applyInArrow

    def noted(self, *a, **k):
        seen.append(applied(self, *a, **k))
        return seen[-1]
    type(df.groupBy("y")).applyInArrow = noted
    try:
        got = rff_quality._partition_sums(df, lambda a, b: a.T @ np.concatenate([a, b[:, None]], axis=1))
    finally:
        type(df.groupBy("y")).applyInArrow = applied
    assert np.allclose(got, x.T @ np.concatenate([x, y[:, None]], axis=1))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "HashAggregate" not in plan
    assert not len(rff_quality._partition_sums(df.limit(0), lambda a, b: a))
