"""Exact label counts with the first-appearance tie rule.

A label's order is count descending, then the first place it was seen:
the smallest ``row_id``, then the position inside that row.  The first
position is taken with ``array_position`` (first index of the label in its
own row), so ``min_by(first_pos, row_id)`` is exact and both aggregates stay
hash aggregates with map-side partials; no row order is relied on.

Positions are computed after aggregation, over one row per distinct label,
and never with one window over all labels of an event (free-text answers can
make that as large as the event).  A label's position is

    (labels with a larger count)
  + (labels with the same count whose first row falls in an earlier bucket
     of ``2**ROW_BUCKET_BITS`` row ids)
  + (its row number inside its (count, bucket) cell),

so every window is bounded: by the number of distinct counts, by the number
of row-id buckets, and by the bucket width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rsvpark.functions.text import choice_picks, combo_label, multiselect_labels, strip_ws

BY = ("event_id",)


def count_labels(df: DataFrame, labels: Column, by=BY, label_name: str = "label",
                 ranked: bool = True) -> DataFrame:
    """Count every element of the array ``labels`` per (by, label); with
    ``ranked=False`` only ``(by, label, n)`` (no positions: callers that
    need counts alone skip the ranking stages)."""
    # Each element is paired with the first index of its value in the same
    # row before exploding, so exploded rows do not carry the whole array.
    arr = df.select(*by, "row_id", labels.alias("_labels"))
    tagged = F.transform("_labels", lambda x: F.struct(x.alias("v"), F.array_position("_labels", x).alias("p")))
    exploded = arr.select(*by, "row_id", F.explode(tagged).alias("_e")).select(
        *by, "row_id", F.col("_e.v").alias(label_name), F.col("_e.p").alias("_pos"))
    agg = exploded.groupBy(*by, label_name).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("row_id").alias("_first_row"),
        F.min_by("_pos", "row_id").alias("_first_pos"),
    )
    if not ranked:
        return agg.select(*by, label_name, F.col("n").cast("bigint").alias("n"))
    return rank_by_count(agg, by, label_name)


def count_values(df: DataFrame, value: Column, by=BY, label_name: str = "label") -> DataFrame:
    """Count a single-valued column per (by, value); nulls are dropped."""
    agg = (df.select(*by, "row_id", value.alias(label_name))
           .where(F.col(label_name).isNotNull())
           .groupBy(*by, label_name)
           .agg(F.count(F.lit(1)).alias("n"), F.min("row_id").alias("_first_row"))
           .withColumn("_first_pos", F.lit(0)))
    return rank_by_count(agg, by, label_name)


ROW_BUCKET_BITS = 20


def larger_counts(hist: DataFrame, by=BY, count_col: str = "n", weight: str | None = None) -> DataFrame:
    """``(by, count_col, _above)``: rows of the group with a strictly larger count.

    ``hist`` holds one row per (group, count) or finer, with the number of
    rows it stands for in ``weight`` (default: one each); the window runs
    over distinct counts only.
    """
    k = F.sum(weight) if weight else F.count(F.lit(1))
    h = hist.groupBy(*by, count_col).agg(k.alias("_kn"))
    w = Window.partitionBy(*by).orderBy(F.desc(count_col)).rowsBetween(Window.unboundedPreceding, -1)
    return h.select(*by, count_col, F.coalesce(F.sum("_kn").over(w), F.lit(0)).alias("_above"))


def rank_by_count(agg: DataFrame, by=BY, label_name: str = "label") -> DataFrame:
    """1-based position: count desc, then first appearance (row, then place in row)."""
    by = list(by)
    x = agg.withColumn("_b", F.shiftright("_first_row", ROW_BUCKET_BITS))
    # Offsets per (count, bucket) cell, computed on the small cell table.
    cells = x.groupBy(*by, "n", "_b").agg(F.count(F.lit(1)).alias("_k"))
    wb = Window.partitionBy(*by, "n").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select(*by, "n", "_b", F.coalesce(F.sum("_k").over(wb), F.lit(0)).alias("_before"))
    offsets = before.join(larger_counts(cells, by, weight="_k"), by + ["n"]).select(
        *by, "n", "_b", (F.col("_above") + F.col("_before")).alias("_off"))
    wi = Window.partitionBy(*by, "n", "_b").orderBy("_first_row", "_first_pos")
    inner = x.select(*by, label_name, "n", "_b", F.row_number().over(wi).alias("_i"))
    return inner.join(offsets, by + ["n", "_b"]).select(
        *by, label_name, F.col("n").cast("bigint").alias("n"),
        (F.col("_off") + F.col("_i")).cast("bigint").alias("pos"))


# --- the concrete breakdowns -------------------------------------------------

def role_split(reg: DataFrame, by=BY) -> DataFrame:
    """D3: every role picked, with the comma fallback and no de-dupe."""
    src = reg.where(F.col("role").isNotNull())
    return count_labels(src, multiselect_labels("role"), by)


def role_combos(reg: DataFrame, by=BY) -> DataFrame:
    """Raw combinations as submitted (cleaned pieces re-joined)."""
    return count_values(reg, combo_label("role"), by, "combo")


def experience_dist(reg: DataFrame, by=BY) -> DataFrame:
    """Trimmed experience answers; blank-after-trim is its own label."""
    return count_values(reg, strip_ws("experience"), by)


def goal_counts(reg: DataFrame, by=BY) -> DataFrame:
    """Session-goal options, de-duplicated per attendee."""
    src = reg.where(F.col("session_goals").isNotNull())
    return count_labels(src, choice_picks("session_goals"), by)


def nonblank_topics(reg: DataFrame, by=BY) -> DataFrame:
    """Trimmed, non-blank future-topic answers."""
    t = strip_ws("future_topics")
    return reg.select(*by, "row_id", t.alias("topic")).where(F.col("topic") != "")


def topic_option_counts(reg: DataFrame, by=BY, ranked: bool = True) -> DataFrame:
    """Option counts over every non-blank topic answer (before routing)."""
    return count_labels(nonblank_topics(reg, by), choice_picks("topic"), by, ranked=ranked)
