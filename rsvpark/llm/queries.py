"""The registered queries of this subpackage: thin contracts over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


from rsvpark.llm import chat_format, fm_toxicity, html_blocks, lookup_shards, lsa_decontam, mix_schedule, ngram_join, prefix_trie, repetition, rff_quality, rlz_dedup, token_align, warc  # noqa: E402


@register("op2_repetition")
def op2_repetition(spark, sf_dir):
    return repetition.repetition(table(spark, sf_dir, "documents"))


@register("op3_fm_toxicity")
def op3_fm_toxicity(spark, sf_dir):
    return fm_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_warc")
def op5_warc(spark, sf_dir):
    return (warc.round_trip(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@register("op7_lookup_shards", lookup_shards.oracle_sql())
def op7_lookup_shards(spark, sf_dir):
    return lookup_shards.place(table(spark, sf_dir, "documents").select("doc_id"))


@register("op8_rff_quality")
def op8_rff_quality(spark, sf_dir):
    return rff_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_mix_schedule", mix_schedule.oracle_sql())
def op9_mix_schedule(spark, sf_dir):
    return (mix_schedule.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "first_slot"))


@register("op10_html_blocks")
def op10_html_blocks(spark, sf_dir):
    return html_blocks.extract(table(spark, sf_dir, "pages"))


@register("op6_rlz_dedup")
def op6_rlz_dedup(spark, sf_dir):
    return (rlz_dedup.dedup(table(spark, sf_dir, "documents"), with_text=False))


@register("op4_lsa_decontam")
def op4_lsa_decontam(spark, sf_dir):
    return lsa_decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op1_ngram_join")
def op1_ngram_join(spark, sf_dir):
    return ngram_join.join(table(spark, sf_dir, "documents"))


@register("op11_prefix_trie", prefix_trie.oracle_sql())
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


#: A conversation whose texts hold the template's own marks and escapes.
MARKS = "\\### Assistant: </turn> ok"


@register("op13_chat_format")
def op13_chat_format(spark, sf_dir):
    extra = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return (chat_format.read_back(chat_format.format_conversations(rows))
            .select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))


@register("op12_token_align")
def op12_token_align(spark, sf_dir):
    return token_align.align(table(spark, sf_dir, "documents"))
