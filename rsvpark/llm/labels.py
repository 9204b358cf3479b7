"""Bounded, reproducible samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(mod: int, key: str = "doc_id") -> Column:
    """``crc32(key as text) mod n``; a null key counts as empty text."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % mod).cast("int")


def training_sample(labels: DataFrame, label: str, mod: int, held_out: int, limit: int) -> DataFrame:
    """``(doc_id, y)`` of labelled rows outside the held-out remainder.

    One row per doc_id (a doc_id labelled both ways counts as 1 if any row says
    so); rows without id or label are left out.  With more rows than ``limit``
    the share ``limit / rows`` of the hash range of ``doc_id`` is kept, so the
    sample has about ``limit`` rows at any size.
    """
    rows = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
            .where("doc_id is not null and y is not null").where(remainder(mod) != held_out)
            .groupBy("doc_id").agg(F.max("y").alias("y")))
    n = rows.count()
    if n > limit:
        span = 1 << 30
        rows = rows.where(F.expr(f"pmod(xxhash64(doc_id, 'sample'), {span})") < int(span * limit / n))
    return rows
