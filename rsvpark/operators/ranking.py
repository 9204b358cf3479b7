"""Ranks, shares, colours and appended rows for the report tables
(E2-E5, F3, F4, H1, H2, C9, C19).

These run on already-aggregated tables (one row per (event, label) or
(event, day)), and still never put all labels of an event into one window:
free-text answers can make a label list as long as the event.  Event-wide
figures are grouped aggregates joined back; ranks come from a histogram of
counts; running totals add block sums to a running sum inside the block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.functions.fmt import axis_ticks, nice_max, palette_at, pct_half_up, rank_text
from rsvpark.functions.text import shorten_label
from rsvpark.operators.counts import larger_counts

BY = ("event_id",)


RUN_BLOCK_BITS = 20


def competition_rank(df: DataFrame, count_col: str = "n", by=BY) -> DataFrame:
    """1, 2, 2, 4 by count descending; a missing count sorts as 0.

    The rank is one more than the number of rows with a larger count, read
    from a histogram of counts (a window over distinct counts only).
    """
    by = list(by)
    c = df.withColumn("_c", F.coalesce(F.col(count_col), F.lit(0)))
    above = larger_counts(c, by, "_c")
    r = (c.join(above, by + ["_c"]).withColumn("rank", (F.col("_above") + 1).cast("bigint"))
         .drop("_c", "_above"))
    return r.withColumn("rank_text", rank_text("rank"))


def _with_group_figure(df: DataFrame, by, name: str, agg) -> DataFrame:
    """Join an event-wide aggregate back onto every row (no window)."""
    return df.join(df.groupBy(*by).agg(agg.alias(name)), list(by))


def running_sum(df: DataFrame, by, order_col: str, value: str, name: str) -> DataFrame:
    """Running total of ``value`` in ``order_col`` order (a dense 1-based
    position) within each group: sums of earlier blocks of
    ``2**RUN_BLOCK_BITS`` positions plus a running sum inside the block."""
    by = list(by)
    x = df.withColumn("_blk", F.shiftright(order_col, RUN_BLOCK_BITS))
    blocks = x.groupBy(*by, "_blk").agg(F.sum(value).alias("_s"))
    wb = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    prev = blocks.select(*by, "_blk", F.coalesce(F.sum("_s").over(wb), F.lit(0)).alias("_prev"))
    wi = Window.partitionBy(*by, "_blk").orderBy(order_col).rowsBetween(Window.unboundedPreceding,
                                                                         Window.currentRow)
    return (x.withColumn("_run", F.sum(value).over(wi)).join(prev, by + ["_blk"])
            .withColumn(name, F.col("_prev") + F.col("_run")).drop("_blk", "_run", "_prev"))


def leaders(counts: DataFrame, by=BY) -> DataFrame:
    """labels tied at the top count are leaders, the rest follow."""
    return (_with_group_figure(counts, by, "_top", F.max("n"))
            .withColumn("leader", F.col("n") == F.col("_top")).drop("_top"))


def with_no_answer(goals: DataFrame, kpis: DataFrame, by=BY) -> DataFrame:
    """D9 + H1: goal rows, then ``No answer`` (total - answered) when there
    are goal rows and some attendees picked nothing."""
    last = goals.groupBy(*by).agg(F.max("pos").alias("last_pos"))
    extra = (kpis.select(*by, (F.col("total") - F.col("goals_answered")).alias("blank"))
             .join(last, list(by))
             .where(F.col("blank") > 0)
             .select(*by, (F.col("last_pos") + 1).cast("bigint").alias("pos"),
                     F.lit(K.NO_ANSWER_LABEL).alias("label"), F.col("blank").cast("bigint").alias("n")))
    return goals.select(*by, "pos", "label", "n").unionByName(extra)


def topic_rows(rows: DataFrame, kpis: DataFrame, by=BY) -> DataFrame:
    """F3 + H2 + E3: ranked topic rows with bar colours, then the blank row last.

    ``rows`` has (by, label, n, pos) for every event: option counts for choice
    events, theme rows for free-text events.
    """
    last = rows.groupBy(*by).agg(F.max("pos").alias("last_pos"))
    blank = (kpis.select(*by, (F.col("total") - F.col("topics_answered")).alias("n"))
             .join(last, list(by), "left")
             .select(*by, (F.coalesce(F.col("last_pos"), F.lit(0)) + 1).cast("bigint").alias("pos"),
                     F.lit(K.BLANK_TOPICS_LABEL).alias("label"), F.col("n").cast("bigint").alias("n"),
                     F.lit(K.BAR_DEFAULT).alias("colour")))
    ranked = rows.select(*by, "pos", "label", "n",
                         palette_at(F.col("pos") - 1, K.BAR_PALETTE, K.BAR_DEFAULT).alias("colour"))
    return ranked.unionByName(blank)


def palette_lookup(counts: DataFrame, by=BY) -> DataFrame:
    """Colour per position for bar rows, role bars and donut segments."""
    p0 = F.col("pos") - 1
    return counts.select(*by, "label", "pos",
                         palette_at(p0, K.BAR_PALETTE, K.BAR_DEFAULT).alias("bar_colour"),
                         palette_at(p0, K.ROLE_PALETTE).alias("role_colour"),
                         palette_at(p0, K.DONUT_PALETTE).alias("donut_colour"))


def bar_share(counts: DataFrame, by=BY) -> DataFrame:
    """Bar length as a share of the event's largest count."""
    return (_with_group_figure(counts, by, "_top", F.max("n"))
            .select(*by, "label", "n", "pos",
                    (F.col("n").cast("double") / F.col("_top").cast("double")).alias("share_of_max")))


def donut_share(dist: DataFrame, by=BY) -> DataFrame:
    """E5 + C9: donut segment shares, start/end (running share) and legend text."""
    t = running_sum(_with_group_figure(dist, by, "total", F.sum("n")), by, "pos", "n", "cum")
    total = F.col("total").cast("double")
    pct = pct_half_up("n", "total")
    return t.select(
        *by, "label", "n", "pos",
        (F.col("n") / total).alias("share"),
        ((F.col("cum") - F.col("n")) / total).alias("start_share"),
        (F.col("cum") / total).alias("end_share"),
        pct.alias("legend_pct"),
        F.concat(shorten_label("label"), F.lit(" — "), F.col("n").cast("string"), F.lit(" ("),
                 pct.cast("string"), F.lit("%)")).alias("legend"),
        palette_at(F.col("pos") - 1, K.DONUT_PALETTE).alias("colour"),
    )


def axis_scale(daily: DataFrame, by=BY) -> DataFrame:
    """Chart axis top and tick labels for the daily and cumulative views."""
    agg = daily.groupBy(*by).agg(F.max("n").alias("daily_max"), F.max("cumulative").alias("cum_max"))
    modes = F.array(
        F.struct(F.lit("daily").alias("mode"), F.col("daily_max").alias("max_val")),
        F.struct(F.lit("cumulative").alias("mode"), F.col("cum_max").alias("max_val")),
    )
    m = agg.select(*by, F.inline(modes))
    nm = nice_max("max_val")
    return m.select(*by, "mode", F.col("max_val").cast("bigint").alias("max_val"),
                    nm.alias("nice_max"), axis_ticks(nm).alias("ticks"))
