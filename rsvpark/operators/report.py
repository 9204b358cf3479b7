"""Report sentences and the one-row-per-event stats table
(C12, C11, C13, D22, L8, K1).

Sentences are built with built-in string and array functions over the
already-aggregated tables; per-event arrays hold one entry per option of a
choice question (bounded by the form, not by the number of attendees).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.functions.fmt import join_and, money_text, pct_even
from rsvpark.functions.text import is_experienced, shorten_label

BY = ("event_id",)


def _q(label: Column) -> Column:
    return F.concat(F.lit("“"), label, F.lit("”"))


def goals_summary(goals: DataFrame, kpis: DataFrame, by=BY) -> DataFrame:
    """``“A” leads with 4 of 6 attendees (67%), followed by …``.

    Percents are of attendees who answered; tied leaders ``lead … each``.
    Empty text for an event without goal picks.
    """
    items = (goals.groupBy(*by)
             .agg(F.sort_array(F.collect_list(F.struct("pos", "label", "n"))).alias("items"),
                  F.max("n").alias("top")))
    j = kpis.select(*by, "goals_answered").join(items, list(by), "left")
    ans = F.col("goals_answered")
    top = F.col("top")
    lead = F.transform(F.filter("items", lambda x: x["n"] == top), lambda x: _q(x["label"]))
    rest = F.transform(
        F.filter("items", lambda x: x["n"] < top),
        lambda x: F.concat(_q(x["label"]), F.lit(" ("), x["n"].cast("string"), F.lit(", "),
                           pct_even(x["n"], ans).cast("string"), F.lit("%)")))
    many = F.size(lead) > 1
    text = F.concat(
        join_and(lead), F.lit(" "), F.when(many, "lead").otherwise("leads"), F.lit(" with "),
        top.cast("string"), F.lit(" of "), ans.cast("string"), F.lit(" attendees"),
        F.when(many, " each").otherwise(""), F.lit(" ("), pct_even(top, ans).cast("string"), F.lit("%)"),
        F.when(F.size(rest) > 0, F.concat(F.lit(", followed by "), join_and(rest))).otherwise(""),
        F.lit("."))
    return j.select(*by, F.when(F.col("items").isNotNull(), text).otherwise(F.lit("")).alias("summary"))


def experience_labels(dist: DataFrame, by=BY) -> DataFrame:
    """Short labels counted / not counted as experienced, in report order."""
    items = dist.groupBy(*by).agg(F.sort_array(F.collect_list(
        F.struct("pos", shorten_label("label").alias("short"), is_experienced("label").alias("exp")))).alias("items"))

    def names(flag: bool) -> Column:
        picked = F.transform(F.filter("items", lambda x: x["exp"] == F.lit(flag)), lambda x: x["short"])
        return F.when(F.size(picked) > 0, F.array_join(picked, ", ")).otherwise(F.lit("(none)"))

    return items.select(*by, names(True).alias("counted"), names(False).alias("not_counted"))


def experience_short(dist: DataFrame, by=BY) -> DataFrame:
    """C6 applied to the experience distribution."""
    return dist.select(*by, "label", shorten_label("label").alias("short_label"), "n", "pos")


def insights(peak: DataFrame, roles: DataFrame, by=BY) -> DataFrame:
    """Fixed-wording timeline and role sentences (< 160 characters) that
    use only the computed numbers.  A role label that leaves no room for the
    numbers is cut, never the sentence."""
    top_role = roles.where(F.col("pos") == 1).select(*by, F.col("label").alias("top_role"),
                                                     F.col("n").alias("top_n"))
    j = peak.join(top_role, list(by), "left")
    tl = F.when(F.col("peak_day").isNotNull(), F.concat(
        F.lit("Registrations peaked on "), F.col("peak_label"), F.lit(" with "), F.col("peak_n").cast("string"),
        F.lit(" sign-ups ("), F.col("peak_pct").cast("string"), F.lit("% of "), F.col("total").cast("string"),
        F.lit(")."))).otherwise(F.lit(""))
    rest = F.concat(F.lit(" is the most picked role ("), F.col("top_n").cast("string"),
                    F.lit(" picks across "), F.col("total").cast("string"), F.lit(" registrations)."))
    short, room = shorten_label("top_role"), F.lit(K.INSIGHT_MAX_CHARS - 1) - F.length(rest)
    fits = F.when(F.length(short) <= room, short).otherwise(F.concat(short.substr(F.lit(1), room - 1), F.lit(K.ELLIPSIS)))
    role = F.when(F.col("top_role").isNotNull(), F.concat(fits, rest)).otherwise(F.lit(""))
    return j.select(*by, tl.alias("timeline_insight"), role.alias("role_insight"))


def event_stats(kpis: DataFrame, peak: DataFrame, mode: DataFrame, by=BY) -> DataFrame:
    """K1: one row per event with every key figure (all inputs are one row
    per event, so the joins are between tiny tables)."""
    real = F.greatest(F.col("engagement") - F.col("speaker_filler"), F.lit(0)).cast("bigint")
    j = (kpis.join(peak.select(*by, "peak_day", "peak_n", "peak_pct"), list(by), "left")
         .join(mode.select(*by, "topics_are_choices"), list(by), "left"))
    return j.select(
        *by,
        F.col("total").cast("bigint").alias("total"),
        "peak_day", "peak_n", "peak_pct",
        F.col("multi_role").cast("bigint").alias("multi_role"),
        F.col("experienced").cast("bigint").alias("experienced"),
        pct_even("experienced", "total").alias("experienced_pct"),
        F.col("goals_answered").cast("bigint").alias("goals_answered"),
        F.col("engagement").cast("bigint").alias("engagement"),
        real.alias("real_questions"),
        pct_even(real, "total").alias("real_pct"),
        (F.col("total") - F.col("topics_answered")).cast("bigint").alias("blank_topics"),
        "topics_are_choices", "ticket_types", "total_paid",
        money_text("total_paid").alias("money_blurb"),
        F.col("attending").cast("bigint").alias("attending"),
        pct_even("attending", "total").alias("attending_pct"),
    )


def report_text(stats: DataFrame, params: DataFrame | None = None, by=BY) -> DataFrame:
    """C13 + A11: the report's fill-in sentences per event, from the stats row.

    ``params(event_id, event_name)`` names events; without it the event key is
    used.  The small params table is joined on ``event_id`` (Spark broadcasts
    it when its runtime size is small).
    """
    s = stats
    if params is not None:
        s = s.join(params.select(*by, "event_name"), list(by), "left")
        name = F.coalesce(F.col("event_name"), F.col(by[0]))
    else:
        name = F.col(by[0])
    st = lambda c: F.col(c).cast("string")
    choices_with_rows = F.coalesce(F.col("topics_are_choices"), F.lit(False)) & F.col("has_topic_rows")
    return s.select(
        *by,
        F.concat(name, F.lit(K.TITLE_SUFFIX)).alias("title"),
        F.concat(F.col("ticket_types"), F.lit(" · "), F.col("money_blurb"), F.lit(" · "), st("attending_pct"),
                 F.lit(K.KPI_ATTENDING_SUFFIX)).alias("kpi_total_sub"),
        F.when(F.col("peak_day").isNotNull(), F.concat(
            F.date_format("peak_day", "EEE MMM dd"), F.lit(" — "), st("peak_pct"), F.lit(K.KPI_PEAK_SUFFIX)))
        .otherwise(F.lit("")).alias("kpi_peak_sub"),
        F.concat(st("experienced"), F.lit(" of "), st("total"), F.lit(K.KPI_EXPERIENCED_SUFFIX)).alias("kpi_exp_sub"),
        F.concat(st("real_questions"), F.lit(" of "), st("total"), F.lit(K.KPI_QUESTIONS_SUFFIX)).alias("kpi_eng_sub"),
        F.when(F.col("multi_role") > 0, F.concat(st("multi_role"), F.lit(K.ROLE_MULTI_SUFFIX)))
        .otherwise(F.lit(K.ROLE_SINGLE)).alias("role_footnote"),
        F.concat(st("real_questions"), F.lit(" of "), st("total"), F.lit(K.SPEAKERQ_DESC_SUFFIX)).alias("speakerq_desc"),
        F.concat(F.when(choices_with_rows, F.lit(K.TOPICS_DESC_CHOICES)).otherwise(F.lit(K.TOPICS_DESC_THEMES)),
                 F.lit(K.TOPICS_DESC_BLANK)).alias("topics_desc"),
        F.concat(F.lit("Total registrations: "), st("total"), F.lit(" · Peak day: "),
                 F.coalesce(F.date_format("peak_day", "MMM dd"), F.lit("-")), F.lit(" ("), st("peak_n"),
                 F.lit(") · Regular/advanced AI users: "), st("experienced_pct"),
                 F.lit("% · Asked a question: "), st("real_pct"), F.lit("%")).alias("summary_text"),
    )
