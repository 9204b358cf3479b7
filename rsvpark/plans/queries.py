"""Driver queries: timeline, breakdowns and key figures.

Each query reads the registrations view built from the given tables and
returns one DataFrame; the DuckDB statement next to it computes the same
rows from the same parquet tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.functions.text import strip_ws
from rsvpark.operators import counts, kpis, timeline
from rsvpark.plans import oracle as O
from rsvpark.plans.registry import register
from rsvpark.sources.fixture import load_reg

# ---------------------------------------------------------------------------
# Timeline
# ---------------------------------------------------------------------------

_DAYS = "d AS (SELECT event_id, CAST(order_ts AS DATE) AS day, count(*) AS n FROM reg GROUP BY ALL)"


@register("daily_timeline", O.with_reg(_DAYS) + """
SELECT event_id, day, strftime(day, '%b %d') AS day_label, CAST(n AS BIGINT) AS n,
       CAST(sum(n) OVER (PARTITION BY event_id ORDER BY day
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
FROM d WHERE day IS NOT NULL""")
def q_daily_timeline(spark, sf_dir):
    return timeline.daily_timeline(load_reg(spark, sf_dir))


@register("peak_day", O.with_reg(
    _DAYS,
    "t AS (SELECT event_id, CAST(sum(n) AS BIGINT) AS total FROM d GROUP BY event_id)",
    """p AS (SELECT event_id, day, n,
              row_number() OVER (PARTITION BY event_id ORDER BY n DESC, day) AS rn
            FROM d WHERE day IS NOT NULL)""") + f"""
SELECT t.event_id, t.total, p.day AS peak_day, CAST(coalesce(p.n, 0) AS BIGINT) AS peak_n,
       {O.pct_even('coalesce(p.n, 0)', 't.total')} AS peak_pct,
       strftime(p.day, '%a %b %d') AS peak_label
FROM t LEFT JOIN p ON p.event_id = t.event_id AND p.rn = 1""")
def q_peak_day(spark, sf_dir):
    return timeline.peak_day(load_reg(spark, sf_dir))


@register("data_window", O.with_reg(
    "w AS (SELECT event_id, min(CAST(order_ts AS DATE)) AS first_day, max(CAST(order_ts AS DATE)) AS last_day"
    " FROM reg GROUP BY event_id)") + """
SELECT event_id, first_day, last_day,
       CASE WHEN first_day IS NULL THEN '' ELSE strftime(first_day, '%b %d') || ' – ' ||
            strftime(last_day, '%b %d') || ', ' || CAST(year(current_date) AS VARCHAR) END AS window_text
FROM w""")
def q_data_window(spark, sf_dir):
    return timeline.data_window(load_reg(spark, sf_dir))


@register("timeline_footnote", O.with_reg(_DAYS) + """
SELECT event_id, string_agg(strftime(day, '%b %d') || ': ' || CAST(n AS VARCHAR), ' · ' ORDER BY day) AS footnote
FROM d WHERE day IS NOT NULL GROUP BY event_id""")
def q_timeline_footnote(spark, sf_dir):
    return timeline.timeline_footnote(load_reg(spark, sf_dir))


# ---------------------------------------------------------------------------
# Role / experience / goals / topics breakdowns
# ---------------------------------------------------------------------------

@register("role_split", O.with_reg(
    O.label_counts_sql("rs", "(SELECT * FROM reg WHERE role IS NOT NULL)", O.multiselect("role")))
    + "SELECT event_id, label, n, pos FROM rs")
def q_role_split(spark, sf_dir):
    return counts.role_split(load_reg(spark, sf_dir))


RC = O.value_counts_sql("rc", "reg", O.combo("role"), "combo")


@register("role_combos", O.with_reg(RC)
          + "SELECT event_id, combo, n, pos FROM rc")
def q_role_combos(spark, sf_dir):
    return counts.role_combos(load_reg(spark, sf_dir))


@register("multi_role", O.with_reg() + f"""
SELECT event_id, CAST(count(*) FILTER (WHERE role IS NOT NULL AND len({O.raw_split('role')}) > 1) AS BIGINT)
       AS multi_role
FROM reg GROUP BY event_id""")
def q_multi_role(spark, sf_dir):
    k = kpis.event_kpis(load_reg(spark, sf_dir))
    return k.select("event_id", F.col("multi_role").cast("bigint").alias("multi_role"))


@register("experience_dist", O.with_reg(O.value_counts_sql("ed", "reg", O.strip("experience")))
          + "SELECT event_id, label, n, pos FROM ed")
def q_experience_dist(spark, sf_dir):
    return counts.experience_dist(load_reg(spark, sf_dir))


_EXP_AGG = (f"e AS (SELECT event_id, count(*) AS total, count(*) FILTER (WHERE experience IS NOT NULL AND "
            f"{O.experienced(O.strip('experience'))}) AS experienced FROM reg GROUP BY event_id)")


@register("experienced_kpi", O.with_reg(_EXP_AGG) + f"""
SELECT event_id, CAST(total AS BIGINT) AS total, CAST(experienced AS BIGINT) AS experienced,
       {O.pct_even('experienced', 'total')} AS experienced_pct FROM e""")
def q_experienced_kpi(spark, sf_dir):
    return kpis.experienced_kpi(kpis.event_kpis(load_reg(spark, sf_dir)))


@register("goal_counts", O.with_reg(
    O.label_counts_sql("gc", "(SELECT * FROM reg WHERE session_goals IS NOT NULL)",
                       O.choice_picks("session_goals")))
    + "SELECT event_id, label, n, pos FROM gc")
def q_goal_counts(spark, sf_dir):
    return counts.goal_counts(load_reg(spark, sf_dir))


# ---------------------------------------------------------------------------
# Scalar key figures
# ---------------------------------------------------------------------------

@register("ticket_types", O.with_reg() + """
SELECT event_id, coalesce(string_agg(DISTINCT ticket_type, ', ' ORDER BY ticket_type), '') AS ticket_types
FROM reg GROUP BY event_id""")
def q_ticket_types(spark, sf_dir):
    return kpis.event_kpis(load_reg(spark, sf_dir)).select("event_id", "ticket_types")


@register("paid_total", O.with_reg(
    "s AS (SELECT event_id, CAST(coalesce(sum(total_paid), 0) AS DECIMAL(38,2)) AS total_paid"
    " FROM reg GROUP BY event_id)") + f"""
SELECT event_id, total_paid, {O.money('total_paid')} AS money_blurb FROM s""")
def q_paid_total(spark, sf_dir):
    return kpis.paid_total(kpis.event_kpis(load_reg(spark, sf_dir)))


@register("attending", O.with_reg(
    f"a AS (SELECT event_id, count(*) AS total, count(*) FILTER (WHERE {O.strip('attendee_status')} = "
    f"{O.lit(K.ATTENDING)}) AS att FROM reg GROUP BY event_id)") + f"""
SELECT event_id, CAST(att AS BIGINT) AS attending, {O.pct_even('att', 'total')} AS attending_pct FROM a""")
def q_attending(spark, sf_dir):
    return kpis.attending(kpis.event_kpis(load_reg(spark, sf_dir)))


@register("engagement", O.with_reg() + f"""
SELECT event_id, CAST(count(*) FILTER (WHERE NOT {O.blank('speaker_q')}) AS BIGINT) AS engagement
FROM reg GROUP BY event_id""")
def q_engagement(spark, sf_dir):
    k = kpis.event_kpis(load_reg(spark, sf_dir))
    return k.select("event_id", F.col("engagement").cast("bigint").alias("engagement"))
