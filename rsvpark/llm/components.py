"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.session import materialize, release


def components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` for every vertex of ``edges(a, b)``; the label is the smallest id of its component.

    Each round hangs the larger neighbours of every vertex on its smallest
    neighbour, then its smaller ones; the number of rounds grows with the
    logarithm of the longest path.  A vertex with many neighbours is a grouped
    minimum and a join that Spark can split; rounds are written tables.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    state, held = None, e
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_m, "u")
        e = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_m.withColumnRenamed("m", "v"))
        written = materialize(e.distinct(), "cc")
        release(held)
        e = held = written
        row = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state == (row.n, row.h):
            break
        state = (row.n, row.h)
    return e.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
