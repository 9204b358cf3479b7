"""Driver queries: routing, ranks, shares, sentences, the stats row, sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.functions.text import html_escape, na_null, slug
from rsvpark.operators import counts, kpis, ranking, report, timeline
from rsvpark.plans import oracle as O
from rsvpark.plans.registry import register
from rsvpark.sources.fixture import load_reg, table
from rsvpark.sources.schema import ANSWER_KEYS

# ---------------------------------------------------------------------------
# Shared SQL pieces
# ---------------------------------------------------------------------------

K_CTE = f"""
k AS (SELECT event_id, count(*) AS total,
  count(*) FILTER (WHERE role IS NOT NULL AND len({O.raw_split('role')}) > 1) AS multi_role,
  count(*) FILTER (WHERE experience IS NOT NULL AND {O.experienced(O.strip('experience'))}) AS experienced,
  count(*) FILTER (WHERE session_goals IS NOT NULL AND len({O.choice_picks('session_goals')}) > 0)
    AS goals_answered,
  count(*) FILTER (WHERE NOT {O.blank('speaker_q')}) AS engagement,
  count(*) FILTER (WHERE NOT {O.blank('speaker_q')} AND {O.filler('speaker_q')}) AS speaker_filler,
  count(*) FILTER (WHERE NOT {O.blank('future_topics')}) AS topics_answered,
  count(*) FILTER (WHERE NOT {O.blank('future_topics')} AND {O.filler('future_topics')}) AS topic_filler_raw,
  coalesce(bool_or(contains({O.strip('future_topics')}, '|')) FILTER (WHERE NOT {O.blank('future_topics')}),
           false) AS topic_has_pipe,
  coalesce(string_agg(DISTINCT ticket_type, ', ' ORDER BY ticket_type), '') AS ticket_types,
  CAST(coalesce(sum(total_paid), 0) AS DECIMAL(38,2)) AS total_paid,
  count(*) FILTER (WHERE {O.strip('attendee_status')} = {O.lit(K.ATTENDING)}) AS attending
FROM reg GROUP BY event_id)"""

TOPIC_CTES = [
    K_CTE,
    O.label_counts_sql(
        "tc", f"(SELECT event_id, row_id, {O.strip('future_topics')} AS topic FROM reg "
              f"WHERE NOT {O.blank('future_topics')})", O.choice_picks("topic")),
    """ms AS (SELECT event_id, count(*) AS n_labels, count(*) FILTER (WHERE n > 1) AS n_repeated
            FROM tc GROUP BY event_id)""",
    """mode AS (SELECT k.event_id, k.topic_has_pipe AS has_pipe,
              CAST(coalesce(ms.n_labels, 0) AS BIGINT) AS n_labels,
              CAST(coalesce(ms.n_repeated, 0) AS BIGINT) AS n_repeated,
              k.topic_has_pipe AND 2 * coalesce(ms.n_repeated, 0) >= coalesce(ms.n_labels, 0)
                AS topics_are_choices
            FROM k LEFT JOIN ms USING (event_id))""",
]

DAYS = "d AS (SELECT event_id, CAST(order_ts AS DATE) AS day, count(*) AS n FROM reg GROUP BY ALL)"
PEAK_CTES = [
    DAYS,
    "t AS (SELECT event_id, CAST(sum(n) AS BIGINT) AS total FROM d GROUP BY event_id)",
    """p0 AS (SELECT event_id, day, n, row_number() OVER (PARTITION BY event_id ORDER BY n DESC, day) AS rn
             FROM d WHERE day IS NOT NULL)""",
    f"""p AS (SELECT t.event_id, t.total, p0.day AS peak_day, CAST(coalesce(p0.n, 0) AS BIGINT) AS peak_n,
              {O.pct_even('coalesce(p0.n, 0)', 't.total')} AS peak_pct,
              strftime(p0.day, '%a %b %d') AS peak_label
            FROM t LEFT JOIN p0 ON p0.event_id = t.event_id AND p0.rn = 1)""",
]

GC = O.label_counts_sql("gc", "(SELECT * FROM reg WHERE session_goals IS NOT NULL)", O.choice_picks("session_goals"))
RS = O.label_counts_sql("rs", "(SELECT * FROM reg WHERE role IS NOT NULL)", O.multiselect("role"))
ED = O.value_counts_sql("ed", "reg", O.strip("experience"))


def _reg(spark, sf_dir):
    return load_reg(spark, sf_dir)


def _mode(reg):
    k = kpis.event_kpis(reg)
    return k, kpis.topic_mode(reg, k)


def _choice_topic_rows(reg, mode):
    """Option counts for the events whose topics are exact choices."""
    choice = mode.where("topics_are_choices").select("event_id")
    return counts.topic_option_counts(reg).join(choice, "event_id", "left_semi")


# ---------------------------------------------------------------------------
# Topic routing and counts
# ---------------------------------------------------------------------------

@register("topic_mode", O.with_reg(*TOPIC_CTES) + "SELECT * FROM mode")
def q_topic_mode(spark, sf_dir):
    return _mode(_reg(spark, sf_dir))[1]


@register("topic_counts", O.with_reg(*TOPIC_CTES) + """
SELECT tc.event_id, tc.label, tc.n, tc.pos FROM tc JOIN mode USING (event_id) WHERE mode.topics_are_choices""")
def q_topic_counts(spark, sf_dir):
    reg = _reg(spark, sf_dir)
    return _choice_topic_rows(reg, _mode(reg)[1]).select("event_id", "label", "n", "pos")


@register("topic_rows", O.with_reg(
    *TOPIC_CTES,
    "tr AS (SELECT tc.event_id, tc.pos, tc.label, tc.n FROM tc JOIN mode USING (event_id) "
    "WHERE mode.topics_are_choices)",
    "lp AS (SELECT event_id, max(pos) AS lp FROM tr GROUP BY event_id)") + f"""
SELECT event_id, pos, label, n, {O.palette('pos - 1', K.BAR_PALETTE, K.BAR_DEFAULT)} AS colour FROM tr
UNION ALL
SELECT k.event_id, CAST(coalesce(lp.lp, 0) + 1 AS BIGINT) AS pos, {O.lit(K.BLANK_TOPICS_LABEL)} AS label,
       CAST(k.total - k.topics_answered AS BIGINT) AS n, {O.lit(K.BAR_DEFAULT)} AS colour
FROM k LEFT JOIN lp USING (event_id)""")
def q_topic_rows(spark, sf_dir):
    from rsvpark.plans.theme_store import topic_rows_for
    reg = _reg(spark, sf_dir)
    k, mode = _mode(reg)
    return topic_rows_for(spark, sf_dir, reg, k, mode)


@register("filler_set_aside", O.with_reg(*TOPIC_CTES) + """
SELECT k.event_id, CAST(k.engagement AS BIGINT) AS speaker_answers, CAST(k.speaker_filler AS BIGINT) AS speaker_filler,
       CAST(CASE WHEN mode.topics_are_choices THEN 0 ELSE k.topics_answered END AS BIGINT) AS topic_answers,
       CAST(CASE WHEN mode.topics_are_choices THEN 0 ELSE k.topic_filler_raw END AS BIGINT) AS topic_filler
FROM k JOIN mode USING (event_id)""")
def q_filler_set_aside(spark, sf_dir):
    reg = _reg(spark, sf_dir)
    k, mode = _mode(reg)
    return kpis.filler_set_aside(k, mode)


@register("real_questions", O.with_reg(K_CTE) + f"""
SELECT event_id, CAST(greatest(engagement - speaker_filler, 0) AS BIGINT) AS real_questions,
       {O.pct_even('greatest(engagement - speaker_filler, 0)', 'total')} AS real_pct FROM k""")
def q_real_questions(spark, sf_dir):
    return kpis.real_questions(kpis.event_kpis(_reg(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Goals
# ---------------------------------------------------------------------------

@register("goals_with_no_answer", O.with_reg(
    K_CTE, GC, "lp AS (SELECT event_id, max(pos) AS lp FROM gc GROUP BY event_id)") + f"""
SELECT event_id, pos, label, n FROM gc
UNION ALL
SELECT k.event_id, CAST(lp.lp + 1 AS BIGINT) AS pos, {O.lit(K.NO_ANSWER_LABEL)} AS label,
       CAST(k.total - k.goals_answered AS BIGINT) AS n
FROM k JOIN lp USING (event_id) WHERE k.total - k.goals_answered > 0""")
def q_goals_with_no_answer(spark, sf_dir):
    reg = _reg(spark, sf_dir)
    return ranking.with_no_answer(counts.goal_counts(reg), kpis.event_kpis(reg))


@register("goal_leaders", O.with_reg(GC) + """
SELECT event_id, label, n, pos, n = max(n) OVER (PARTITION BY event_id) AS leader FROM gc""")
def q_goal_leaders(spark, sf_dir):
    return ranking.leaders(counts.goal_counts(_reg(spark, sf_dir)))


_LEAD = "list_transform(list_filter(items, lambda x: x.n = top), lambda x: '“' || x.label || '”')"
_REST = ("list_transform(list_filter(items, lambda x: x.n < top), lambda x: '“' || x.label || '” (' || "
         "CAST(x.n AS VARCHAR) || ', ' || CAST(" + O.pct_even("x.n", "ans") + " AS VARCHAR) || '%)')")


@register("goals_summary", O.with_reg(
    K_CTE, GC,
    "gi AS (SELECT event_id, list({'pos': pos, 'label': label, 'n': n} ORDER BY pos) AS items, max(n) AS top "
    "FROM gc GROUP BY event_id)",
    "gs AS (SELECT k.event_id, k.goals_answered AS ans, gi.items, gi.top FROM k LEFT JOIN gi USING (event_id))",
    f"gl AS (SELECT event_id, ans, items, top, {_LEAD} AS lead, {_REST} AS rest FROM gs)") + f"""
SELECT event_id, CASE WHEN items IS NULL THEN '' ELSE
  {O.join_and('lead')} || ' ' || CASE WHEN len(lead) > 1 THEN 'lead' ELSE 'leads' END || ' with ' ||
  CAST(top AS VARCHAR) || ' of ' || CAST(ans AS VARCHAR) || ' attendees' ||
  CASE WHEN len(lead) > 1 THEN ' each' ELSE '' END || ' (' || CAST({O.pct_even('top', 'ans')} AS VARCHAR) || '%)' ||
  CASE WHEN len(rest) > 0 THEN ', followed by ' || {O.join_and('rest')} ELSE '' END || '.' END AS summary
FROM gl""")
def q_goals_summary(spark, sf_dir):
    reg = _reg(spark, sf_dir)
    return report.goals_summary(counts.goal_counts(reg), kpis.event_kpis(reg))


@register("competition_rank", O.with_reg(GC) + """
SELECT event_id, label, n, pos, CAST(rank() OVER (PARTITION BY event_id ORDER BY coalesce(n, 0) DESC) AS BIGINT) AS rank,
       printf('%02d', CAST(rank() OVER (PARTITION BY event_id ORDER BY coalesce(n, 0) DESC) AS INTEGER)) AS rank_text
FROM gc""")
def q_competition_rank(spark, sf_dir):
    return ranking.competition_rank(counts.goal_counts(_reg(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Experience
# ---------------------------------------------------------------------------

@register("experience_labels", O.with_reg(
    ED,
    f"ei AS (SELECT event_id, list({{'pos': pos, 'short': {O.shorten('label')}, 'exp': {O.experienced('label')}}}"
    f" ORDER BY pos) AS items FROM ed GROUP BY event_id)") + """
SELECT event_id,
  CASE WHEN len(list_filter(items, lambda x: x.exp)) > 0
       THEN array_to_string(list_transform(list_filter(items, lambda x: x.exp), lambda x: x.short), ', ')
       ELSE '(none)' END AS counted,
  CASE WHEN len(list_filter(items, lambda x: NOT x.exp)) > 0
       THEN array_to_string(list_transform(list_filter(items, lambda x: NOT x.exp), lambda x: x.short), ', ')
       ELSE '(none)' END AS not_counted
FROM ei""")
def q_experience_labels(spark, sf_dir):
    return report.experience_labels(counts.experience_dist(_reg(spark, sf_dir)))


@register("experience_short", O.with_reg(ED) + f"""
SELECT event_id, label, {O.shorten('label')} AS short_label, n, pos FROM ed""")
def q_experience_short(spark, sf_dir):
    return report.experience_short(counts.experience_dist(_reg(spark, sf_dir)))


@register("donut_share", O.with_reg(
    ED,
    "ew AS (SELECT *, sum(n) OVER (PARTITION BY event_id) AS total, sum(n) OVER (PARTITION BY event_id ORDER BY pos "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM ed)") + f"""
SELECT event_id, label, n, pos,
  CAST(n AS DOUBLE) / CAST(total AS DOUBLE) AS share,
  CAST(cum - n AS DOUBLE) / CAST(total AS DOUBLE) AS start_share,
  CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) AS end_share,
  {O.pct_half_up('n', 'total')} AS legend_pct,
  {O.shorten('label')} || ' — ' || CAST(n AS VARCHAR) || ' (' || CAST({O.pct_half_up('n', 'total')} AS VARCHAR)
    || '%)' AS legend,
  {O.palette('pos - 1', K.DONUT_PALETTE)} AS colour
FROM ew""")
def q_donut_share(spark, sf_dir):
    return ranking.donut_share(counts.experience_dist(_reg(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Role bars
# ---------------------------------------------------------------------------

@register("palette_lookup", O.with_reg(RS) + f"""
SELECT event_id, label, pos,
  {O.palette('pos - 1', K.BAR_PALETTE, K.BAR_DEFAULT)} AS bar_colour,
  {O.palette('pos - 1', K.ROLE_PALETTE)} AS role_colour,
  {O.palette('pos - 1', K.DONUT_PALETTE)} AS donut_colour
FROM rs""")
def q_palette_lookup(spark, sf_dir):
    return ranking.palette_lookup(counts.role_split(_reg(spark, sf_dir)))


@register("bar_share", O.with_reg(RS) + """
SELECT event_id, label, n, pos, CAST(n AS DOUBLE) / CAST(max(n) OVER (PARTITION BY event_id) AS DOUBLE) AS share_of_max
FROM rs""")
def q_bar_share(spark, sf_dir):
    return ranking.bar_share(counts.role_split(_reg(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Axis, stats row, insights
# ---------------------------------------------------------------------------

@register("axis_scale", O.with_reg(
    DAYS,
    "dt AS (SELECT event_id, day, n, sum(n) OVER (PARTITION BY event_id ORDER BY day ROWS BETWEEN UNBOUNDED "
    "PRECEDING AND CURRENT ROW) AS cumulative FROM d WHERE day IS NOT NULL)",
    "am AS (SELECT event_id, max(n) AS daily_max, max(cumulative) AS cum_max FROM dt GROUP BY event_id)",
    "m AS (SELECT event_id, 'daily' AS mode, daily_max AS max_val FROM am "
    "UNION ALL SELECT event_id, 'cumulative' AS mode, cum_max AS max_val FROM am)") + """
SELECT event_id, mode, CAST(max_val AS BIGINT) AS max_val, CAST(ceil(max_val / 5) * 5 AS BIGINT) AS nice_max,
  array_to_string(list_transform(range(0, 6), lambda i:
     CAST(CAST(floor(CAST(ceil(max_val / 5) * 5 AS BIGINT) * i / 5 + 0.5) AS BIGINT) AS VARCHAR)), ',') AS ticks
FROM m""")
def q_axis_scale(spark, sf_dir):
    return ranking.axis_scale(timeline.daily_timeline(_reg(spark, sf_dir)))


ORACLE_EVENT_STATS_BODY = f"""
SELECT k.event_id, CAST(k.total AS BIGINT) AS total, p.peak_day, p.peak_n, p.peak_pct,
  CAST(k.multi_role AS BIGINT) AS multi_role, CAST(k.experienced AS BIGINT) AS experienced,
  {O.pct_even('k.experienced', 'k.total')} AS experienced_pct,
  CAST(k.goals_answered AS BIGINT) AS goals_answered, CAST(k.engagement AS BIGINT) AS engagement,
  CAST(greatest(k.engagement - k.speaker_filler, 0) AS BIGINT) AS real_questions,
  {O.pct_even('greatest(k.engagement - k.speaker_filler, 0)', 'k.total')} AS real_pct,
  CAST(k.total - k.topics_answered AS BIGINT) AS blank_topics,
  mode.topics_are_choices, k.ticket_types, k.total_paid, {O.money('k.total_paid')} AS money_blurb,
  CAST(k.attending AS BIGINT) AS attending, {O.pct_even('k.attending', 'k.total')} AS attending_pct
FROM k LEFT JOIN p USING (event_id) LEFT JOIN mode USING (event_id)"""


@register("event_stats", O.with_reg(*TOPIC_CTES, *PEAK_CTES) + ORACLE_EVENT_STATS_BODY)
def q_event_stats(spark, sf_dir):
    reg = _reg(spark, sf_dir)
    k, mode = _mode(reg)
    return report.event_stats(k, timeline.peak_day(reg), mode)


_TL = ("CASE WHEN p.peak_day IS NULL THEN '' ELSE 'Registrations peaked on ' || p.peak_label || ' with ' || "
       "CAST(p.peak_n AS VARCHAR) || ' sign-ups (' || CAST(p.peak_pct AS VARCHAR) || '% of ' || "
       "CAST(p.total AS VARCHAR) || ').' END")
_REST = "(' is the most picked role (' || CAST(r.n AS VARCHAR) || ' picks across ' || CAST(p.total AS VARCHAR) || ' registrations).')"
_SHORT, _ROOM = O.shorten("r.label"), f"({K.INSIGHT_MAX_CHARS - 1} - length({_REST}))"
# the label gives way, not the numbers
_RL = (f"CASE WHEN r.label IS NULL THEN '' WHEN length({_SHORT}) <= {_ROOM} THEN {_SHORT} || {_REST} "
       f"ELSE substr({_SHORT}, 1, {_ROOM} - 1) || {O.lit(K.ELLIPSIS)} || {_REST} END")


@register("insights", O.with_reg(*PEAK_CTES, RS) + f"""
SELECT p.event_id, {_TL} AS timeline_insight, {_RL} AS role_insight
FROM p LEFT JOIN rs r ON r.event_id = p.event_id AND r.pos = 1""")
def q_insights(spark, sf_dir):
    reg = _reg(spark, sf_dir)
    return report.insights(timeline.peak_day(reg), counts.role_split(reg))


# ---------------------------------------------------------------------------
# Source-side functions on the given tables
# ---------------------------------------------------------------------------

@register("html_escaped", f"SELECT page_id, {O.html_escape('html')} AS escaped FROM pages")
def q_html_escaped(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_escape("html").alias("escaped"))


@register("event_slug", r"""
WITH s AS (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages),
t AS (SELECT page_id, url, CASE WHEN regexp_matches(name, '^.+\.[^.]+$')
        THEN regexp_extract(name, '^(.+)\.[^.]+$', 1) ELSE name END AS stem FROM s),
u AS (SELECT page_id, url, stem,
        regexp_replace(regexp_replace(stem, '[^A-Za-z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g') AS sl FROM t)
SELECT page_id, url, stem, CASE WHEN sl = '' THEN 'event' ELSE sl END AS slug FROM u""")
def q_event_slug(spark, sf_dir):
    from rsvpark.sources.csv_export import file_stem
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    stem = file_stem(F.regexp_extract("url", "([^/]*)$", 1))
    return p.select("page_id", "url", stem.alias("stem")).withColumn("slug", slug("stem"))


_UNPIVOT = ("(UNPIVOT (SELECT event_id, row_id, " + ", ".join(ANSWER_KEYS) + " FROM reg) ON "
            + ", ".join(ANSWER_KEYS) + " INTO NAME key VALUE answer)")


@register("answers_long", O.with_reg() + f"SELECT event_id, row_id, key, answer FROM {_UNPIVOT}")
def q_answers_long(spark, sf_dir):
    from rsvpark.sources.csv_export import answers_long
    return answers_long(_reg(spark, sf_dir))


_NA_IN = ", ".join(O.lit(t) for t in K.NA_TOKENS)


@register("na_tokens", O.with_reg() + f"""
SELECT event_id, key, CAST(count(*) AS BIGINT) AS cells,
       CAST(count(*) FILTER (WHERE answer IN ({_NA_IN})) AS BIGINT) AS nulled
FROM {_UNPIVOT} GROUP BY event_id, key""")
def q_na_tokens(spark, sf_dir):
    from rsvpark.sources.csv_export import answers_long
    a = answers_long(_reg(spark, sf_dir))
    return a.groupBy("event_id", "key").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(na_null("answer").isNull()).alias("nulled"))


@register("pending_events", O.with_reg() + """
SELECT DISTINCT event_id FROM reg WHERE event_id <> (SELECT event_id FROM reg ORDER BY row_id LIMIT 1)""")
def q_pending_events(spark, sf_dir):
    """Events without stored themes; the event of the first order has themes by hand in a store."""
    from rsvpark.session import shared_path
    from rsvpark.streaming.pending import pending_events, store_themes, stored_themes
    reg = _reg(spark, sf_dir)
    first = reg.agg(F.min_by("event_id", "row_id").alias("event_id"))
    by_hand = first.select("event_id", F.lit("speaker_q").alias("key"), F.lit(0).cast("bigint").alias("theme_id"), F.lit("By hand").alias("title"),
                           F.lit(1).cast("bigint").alias("count"), F.array(F.lit("?")).alias("quotes"))
    store = shared_path(spark, "rsvpark-work", f"manual-themes-{uuid.uuid4().hex}")
    store_themes(by_hand, store)
    return pending_events(reg, stored_themes(spark, store))


# ---------------------------------------------------------------------------
# Report sentences
# ---------------------------------------------------------------------------

def _rt_sql() -> str:
    c = K
    return f"""
SELECT es.event_id,
  es.event_id || {O.lit(c.TITLE_SUFFIX)} AS title,
  es.ticket_types || ' · ' || es.money_blurb || ' · ' || CAST(es.attending_pct AS VARCHAR)
    || {O.lit(c.KPI_ATTENDING_SUFFIX)} AS kpi_total_sub,
  CASE WHEN es.peak_day IS NULL THEN '' ELSE strftime(es.peak_day, '%a %b %d') || ' — '
    || CAST(es.peak_pct AS VARCHAR) || {O.lit(c.KPI_PEAK_SUFFIX)} END AS kpi_peak_sub,
  CAST(es.experienced AS VARCHAR) || ' of ' || CAST(es.total AS VARCHAR) || {O.lit(c.KPI_EXPERIENCED_SUFFIX)}
    AS kpi_exp_sub,
  CAST(es.real_questions AS VARCHAR) || ' of ' || CAST(es.total AS VARCHAR) || {O.lit(c.KPI_QUESTIONS_SUFFIX)}
    AS kpi_eng_sub,
  CASE WHEN es.multi_role > 0 THEN CAST(es.multi_role AS VARCHAR) || {O.lit(c.ROLE_MULTI_SUFFIX)}
       ELSE {O.lit(c.ROLE_SINGLE)} END AS role_footnote,
  CAST(es.real_questions AS VARCHAR) || ' of ' || CAST(es.total AS VARCHAR) || {O.lit(c.SPEAKERQ_DESC_SUFFIX)}
    AS speakerq_desc,
  CASE WHEN coalesce(es.topics_are_choices, false) AND coalesce(ms.n_labels, 0) > 0
       THEN {O.lit(c.TOPICS_DESC_CHOICES)} ELSE {O.lit(c.TOPICS_DESC_THEMES)} END
    || {O.lit(c.TOPICS_DESC_BLANK)} AS topics_desc,
  'Total registrations: ' || CAST(es.total AS VARCHAR) || ' · Peak day: ' || coalesce(strftime(es.peak_day, '%b %d'), '-')
    || ' (' || CAST(es.peak_n AS VARCHAR) || ') · Regular/advanced AI users: ' || CAST(es.experienced_pct AS VARCHAR)
    || '% · Asked a question: ' || CAST(es.real_pct AS VARCHAR) || '%' AS summary_text
FROM es LEFT JOIN ms USING (event_id)"""


_ES_CTE = "es AS (" + ORACLE_EVENT_STATS_BODY + ")"


@register("report_text", O.with_reg(*TOPIC_CTES, *PEAK_CTES, _ES_CTE) + _rt_sql())
def q_report_text(spark, sf_dir):
    reg = _reg(spark, sf_dir)
    k, mode = _mode(reg)
    stats = report.event_stats(k, timeline.peak_day(reg), mode)
    has_rows = mode.select("event_id", (F.col("n_labels") > 0).alias("has_topic_rows"))
    return report.report_text(stats.join(has_rows, "event_id", "left"))
