"""Registration timeline: daily counts, running totals, peak day.

Everything aggregates to one row per (event, day) first; the running-total
window and the per-event reductions then work on at most one row per
calendar day, whatever the number of registrations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rsvpark.functions.fmt import day_label, long_day_label, pct_even

BY = ("event_id",)


def day_counts(reg: DataFrame, by=BY, keep_undated: bool = False) -> DataFrame:
    """Rows per (event, calendar day); undated rows form a null day if kept."""
    d = reg.select(*by, F.to_date("order_ts").alias("day"))
    if not keep_undated:
        d = d.where(F.col("day").isNotNull())
    return d.groupBy(*by, "day").agg(F.count(F.lit(1)).alias("n"))


def daily_timeline(reg: DataFrame, by=BY) -> DataFrame:
    """D2 + E1: daily count and cumulative count in date order."""
    w = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return day_counts(reg, by).select(
        *by, "day", day_label("day").alias("day_label"),
        F.col("n").cast("bigint").alias("n"),
        F.sum("n").over(w).cast("bigint").alias("cumulative"),
    )


def peak_day(reg: DataFrame, by=BY) -> DataFrame:
    """Busiest day (ties: earliest) and its share of *all* rows."""
    d = day_counts(reg, by, keep_undated=True)
    best = F.max(F.when(F.col("day").isNotNull(),
                        F.struct(F.col("n").alias("n"), (-F.unix_date("day")).alias("neg"),
                                 F.col("day").alias("day"))))
    agg = d.groupBy(*by).agg(F.sum("n").cast("bigint").alias("total"), best.alias("pk"))
    peak_n = F.coalesce(F.col("pk.n"), F.lit(0)).cast("bigint")
    return agg.select(
        *by, "total", F.col("pk.day").alias("peak_day"), peak_n.alias("peak_n"),
        pct_even(peak_n, "total").alias("peak_pct"),
        long_day_label("pk.day").alias("peak_label"),
    )


def data_window(reg: DataFrame, by=BY, as_of: Column | None = None) -> DataFrame:
    """D23 + C15: first and last day and the header text ``Sep 01 – Sep 05, 2026``.

    The year is that of ``as_of`` (default: today), as in the report header.
    """
    as_of = as_of if as_of is not None else F.current_date()
    agg = (reg.select(*by, F.to_date("order_ts").alias("day"))
           .groupBy(*by).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")))
    text = F.concat(day_label("first_day"), F.lit(" – "), day_label("last_day"), F.lit(", "),
                    F.year(as_of).cast("string"))
    return agg.select(*by, "first_day", "last_day",
                      F.when(F.col("first_day").isNotNull(), text).otherwise(F.lit("")).alias("window_text"))


def timeline_footnote(reg: DataFrame, by=BY) -> DataFrame:
    """C14: ``Sep 01: 2 · Sep 02: 2 …`` in date order (one entry per day)."""
    d = day_counts(reg, by)
    items = F.sort_array(F.collect_list(F.struct("day", day_label("day").alias("lbl"), "n")))
    text = F.array_join(F.transform(items, lambda x: F.concat(x["lbl"], F.lit(": "), x["n"].cast("string"))),
                        " · ")
    return d.groupBy(*by).agg(text.alias("footnote"))
