"""The corpus pipeline: quality, near duplicates, benchmark leaks, source mix, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet under the shared folder and gives what it reads back to
the next one, so a lost executor costs one stage's tasks, not the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rsvpark.llm import lookup_shards, lsa_decontam, mix_schedule, ngram_join, rff_quality
from rsvpark.session import materialize, release


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return rff_quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return lsa_decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents as often as the mix takes them."""
    return mix_schedule.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix with its slot and shard."""
    return lookup_shards.place(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shards),
]

#: The classifier, the join and the retrieval are not expressible in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{i}")
        release(before)     # nothing reads a stage's input once its output is written
    return docs
