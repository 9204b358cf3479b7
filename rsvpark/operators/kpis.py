"""Per-event key figures.

All scalar figures come out of ONE grouped aggregate over the registrations
(``event_kpis``): a single scan, map-side partial aggregation, and a shuffle
of a few partial rows per task and event.  A hot event only makes its partial
rows bigger, never one task's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.functions.fmt import money_text, pct_even
from rsvpark.functions.text import (choice_picks, is_blank, is_experienced, is_filler,
                                    part_count, strip_ws)
from rsvpark.operators.counts import topic_option_counts

BY = ("event_id",)


def event_kpis(reg: DataFrame, by=BY) -> DataFrame:
    """One row per event with every scalar figure that needs a single pass."""
    role, exp, goals = F.col("role"), F.col("experience"), F.col("session_goals")
    q, topic, status = F.col("speaker_q"), F.col("future_topics"), F.col("attendee_status")
    topic_t = strip_ws(topic)
    att = F.count_if(F.coalesce(strip_ws(status) == K.ATTENDING, F.lit(False)))
    has_tickets = F.lit(True)
    if "has_ticket_type" in reg.columns:
        # Exports read from CSV say whether a column exists at all: an absent
        # ticket column reads as general admission, an absent status column
        # counts everyone as attending.
        has_tickets = F.bool_or("has_ticket_type")
        att = F.when(F.bool_or("has_attendee_status"), att).otherwise(F.count(F.lit(1)))
    one_pass = reg.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(role.isNotNull() & (part_count(role) > 1)).alias("multi_role"),
        F.count_if(exp.isNotNull() & is_experienced(strip_ws(exp))).alias("experienced"),
        F.count_if(goals.isNotNull() & (F.size(choice_picks(goals)) > 0)).alias("goals_answered"),
        F.count_if(~is_blank(q)).alias("engagement"),
        F.count_if(~is_blank(q) & is_filler(q)).alias("speaker_filler"),
        F.count_if(~is_blank(topic)).alias("topics_answered"),
        F.count_if(~is_blank(topic) & is_filler(topic)).alias("topic_filler_raw"),
        F.coalesce(F.bool_or(F.when(~is_blank(topic), topic_t.contains("|"))), F.lit(False))
        .alias("topic_has_pipe"),
        has_tickets.alias("has_tickets"),
        F.coalesce(F.sum("total_paid"), F.lit(0)).cast("decimal(38,2)").alias("total_paid"),
        att.alias("attending"),
    )
    # Ticket types are distinct (event, type) rows first, so the pass above
    # stays a hash aggregate and only a form's few types are ever listed.
    types = (reg.where(F.col("ticket_type").isNotNull()).select(*by, "ticket_type").distinct()
             .groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list("ticket_type")), ", ").alias("types")))
    tickets = F.when(F.col("has_tickets"), F.coalesce("types", F.lit(""))).otherwise(F.lit(K.DEFAULT_TICKET_TYPES))
    out = one_pass.join(types, list(by), "left").withColumn("ticket_types", tickets)
    return out.drop("types", "has_tickets")


def experienced_kpi(kpis: DataFrame, by=BY) -> DataFrame:
    """Experienced answers and their share of all rows."""
    return kpis.select(*by, F.col("total").cast("bigint").alias("total"),
                       F.col("experienced").cast("bigint").alias("experienced"),
                       pct_even("experienced", "total").alias("experienced_pct"))


def attending(kpis: DataFrame, by=BY) -> DataFrame:
    """Trimmed status equal to ``Attending`` and its share of all rows."""
    return kpis.select(*by, F.col("attending").cast("bigint").alias("attending"),
                       pct_even("attending", "total").alias("attending_pct"))


def paid_total(kpis: DataFrame, by=BY) -> DataFrame:
    """D15 + C10: total paid and the money sentence."""
    return kpis.select(*by, "total_paid", money_text("total_paid").alias("money_blurb"))


def topic_mode(reg: DataFrame, kpis: DataFrame, by=BY) -> DataFrame:
    """Are future topics exact choices (``A | B``) or free text?

    Choices when some answer holds ``|`` and at least half of the distinct
    options were picked more than once.
    """
    stats = (topic_option_counts(reg, by, ranked=False).groupBy(*by)
             .agg(F.count(F.lit(1)).alias("n_labels"), F.count_if(F.col("n") > 1).alias("n_repeated")))
    j = kpis.select(*by, "topic_has_pipe").join(stats, list(by), "left")
    n_labels = F.coalesce(F.col("n_labels"), F.lit(0)).cast("bigint")
    n_rep = F.coalesce(F.col("n_repeated"), F.lit(0)).cast("bigint")
    return j.select(*by, F.col("topic_has_pipe").alias("has_pipe"), n_labels.alias("n_labels"),
                    n_rep.alias("n_repeated"),
                    (F.col("topic_has_pipe") & (2 * n_rep >= n_labels)).alias("topics_are_choices"))


def filler_set_aside(kpis: DataFrame, mode: DataFrame, by=BY) -> DataFrame:
    """L1: filler answers per list.  Topic answers only go to theming (and
    so only have filler set aside) when topics are free text."""
    j = kpis.join(mode.select(*by, "topics_are_choices"), list(by))
    free = ~F.col("topics_are_choices")
    return j.select(
        *by,
        F.col("engagement").cast("bigint").alias("speaker_answers"),
        F.col("speaker_filler").cast("bigint").alias("speaker_filler"),
        F.when(free, F.col("topics_answered")).otherwise(0).cast("bigint").alias("topic_answers"),
        F.when(free, F.col("topic_filler_raw")).otherwise(0).cast("bigint").alias("topic_filler"),
    )


def real_questions(kpis: DataFrame, by=BY) -> DataFrame:
    """Speaker answers minus filler, floored at 0, share of all rows."""
    real = F.greatest(F.col("engagement") - F.col("speaker_filler"), F.lit(0)).cast("bigint")
    return kpis.select(*by, real.alias("real_questions"), pct_even(real, "total").alias("real_pct"))
