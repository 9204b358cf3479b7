"""Driver queries for themes, similar groups, prompt rows and chart payloads.

Themes and similar groups have no DuckDB oracle (iterative jobs, hash-based
buckets); the driver records a rows-only check and the tests compare them
with brute force on small inputs.  Prompt rows and chart payloads are plain
aggregates written as JSON / text and do have one (the JSON is built in SQL
with the same key order and null handling as Spark's ``to_json``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.functions.fmt import day_label, md5_bucket, palette_at
from rsvpark.functions.text import shorten_label
from rsvpark.operators import counts, kpis, ranking, themes, timeline
from rsvpark.operators.similar import DEN, NUM, similar_groups
from rsvpark.plans import oracle as O
from rsvpark.plans.more_queries import DAYS, ED, GC, RS, TOPIC_CTES
from rsvpark.plans.queries import RC
from rsvpark.plans.registry import register
from rsvpark.plans.theme_store import _inputs, themes_with_store, topic_rows_for
from rsvpark.session import materialize
from rsvpark.sources.fixture import load_reg

CHUNK_ANSWERS = 200
CONTEXT_BROADCAST_MAX_ROWS = 10_000     # answer lists; their contexts are a few KB each

# Theme inputs in SQL: trimmed, non-blank, non-filler answers per list.
_ANS_CTE = f"""ans AS (
  SELECT event_id, 'speaker_q' AS key, row_id, {O.strip('speaker_q')} AS answer FROM reg
  WHERE NOT {O.blank('speaker_q')} AND NOT {O.filler('speaker_q')}
  UNION ALL
  SELECT reg.event_id, 'future_topics' AS key, reg.row_id, {O.strip('future_topics')} AS answer
  FROM reg JOIN mode ON mode.event_id = reg.event_id
  WHERE NOT mode.topics_are_choices AND NOT {O.blank('future_topics')} AND NOT {O.filler('future_topics')})"""


@register("themes_kmeans")
def q_themes_kmeans(spark, sf_dir):
    return themes_with_store(spark, sf_dir)


@register("theme_cards")
def q_theme_cards(spark, sf_dir):
    return themes.theme_cards(themes_with_store(spark, sf_dir))


@register("theme_audit")
def q_theme_audit(spark, sf_dir):
    reg, k, mode, ans = _inputs(spark, sf_dir)
    genuine = ans.groupBy("event_id", "key").agg(F.count(F.lit(1)).cast("bigint").alias("n_genuine"))
    return themes.theme_audit(themes_with_store(spark, sf_dir), ans, genuine)


def theme_documents(th: DataFrame, filler: DataFrame, ins: DataFrame) -> DataFrame:
    """Per event, the theme file as JSON text in a ```json fence (K3 / A7 format)."""
    def lst(key):
        rows = th.where(F.col("key") == key)
        return rows.groupBy("event_id").agg(F.transform(
            F.sort_array(F.collect_list(F.struct(F.col("theme_id"), F.col("title"),
                                                 F.col("count").cast("int").alias("count"), "quotes"))),
            lambda x: F.struct(x["title"].alias("title"), x["count"].alias("count"),
                               x["quotes"].alias("quotes"))).alias(key))
    empty = F.array().cast("array<struct<title:string,count:int,quotes:array<string>>>")
    j = (filler.join(lst("speaker_q"), "event_id", "left").join(lst("future_topics"), "event_id", "left")
         .join(ins, "event_id", "left"))
    doc = F.struct(
        F.coalesce("speaker_q", empty).alias("speaker_question_clusters"),
        F.coalesce("future_topics", empty).alias("future_topic_clusters"),
        F.col("speaker_filler").cast("int").alias("non_specific_speaker_count"),
        F.col("topic_filler").cast("int").alias("non_specific_topics_count"),
        F.col("timeline_insight"), F.col("role_insight"))
    return j.select("event_id", F.concat(F.lit("```json\n"), F.to_json(doc), F.lit("\n```")).alias("text"))


@register("theme_json_parse")
def q_theme_json_parse(spark, sf_dir):
    from rsvpark.operators import report
    reg, k, mode, ans = _inputs(spark, sf_dir)
    th = themes_with_store(spark, sf_dir)
    ins = report.insights(timeline.peak_day(reg), counts.role_split(reg))
    docs = theme_documents(th, kpis.filler_set_aside(k, mode), ins)
    parsed = docs.select("event_id", themes.parse_theme_json("text").alias("themes"))
    return themes.theme_rows_from_file(parsed)


# SQL check: plain pairwise Jaccard similarity of word sets (pairs are formed
# here, in the check only); components by a recursive CTE.
SIMILAR_GROUPS_SQL = O.with_reg(
    *TOPIC_CTES, _ANS_CTE,
    r"""tok AS (SELECT DISTINCT event_id, key, row_id,
                  unnest(regexp_extract_all(lower(answer), '\p{Han}|[\p{L}\p{N}]+')) AS term FROM ans)""",
    "sz AS (SELECT event_id, key, row_id, count(*) AS n FROM tok GROUP BY ALL)",
    """common AS (SELECT a.event_id, a.key, a.row_id AS src, b.row_id AS dst, count(*) AS c
               FROM tok a JOIN tok b ON a.event_id = b.event_id AND a.key = b.key AND a.term = b.term GROUP BY ALL)""",
    f"""edges AS (SELECT c.event_id, c.key, c.src, c.dst FROM common c
               JOIN sz x ON x.event_id = c.event_id AND x.key = c.key AND x.row_id = c.src
               JOIN sz y ON y.event_id = c.event_id AND y.key = c.key AND y.row_id = c.dst
               WHERE {DEN} * c.c >= {NUM} * (x.n + y.n - c.c))""",
    """cc(event_id, key, row_id, label) AS (
      SELECT event_id, key, row_id, row_id FROM ans
      UNION
      SELECT e.event_id, e.key, e.dst, cc.label FROM cc
      JOIN edges e ON e.event_id = cc.event_id AND e.key = cc.key AND e.src = cc.row_id)""",
    "grp AS (SELECT event_id, key, row_id, min(label) AS group_id FROM cc GROUP BY ALL)",
).replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT g.event_id, g.key, g.group_id, CAST(count(*) AS BIGINT) AS n_answers, ex.answer AS example
FROM grp g JOIN ans ex ON ex.event_id = g.event_id AND ex.key = g.key AND ex.row_id = g.group_id
GROUP BY g.event_id, g.key, g.group_id, ex.answer"""


@register("similar_groups", SIMILAR_GROUPS_SQL)
def q_similar_groups(spark, sf_dir):
    return similar_groups(_inputs(spark, sf_dir)[3])


def context_json(reg: DataFrame) -> DataFrame:
    """``{"Sep 01": 2, …}`` by day and ``{"Tech": 5, …}`` by role, per event.

    A repeated day label (same day, different years) sits where it first
    appears and keeps the later value.  Labels are made unique before the map
    is built, so the result does not depend on ``spark.sql.mapKeyDedupPolicy``.
    """
    d = timeline.day_counts(reg)
    by_label = d.groupBy("event_id", day_label("day").alias("k")).agg(
        F.min("day").alias("first_day"), F.max_by("n", "day").alias("n"))
    daily = by_label.groupBy("event_id").agg(F.to_json(F.map_from_entries(F.transform(
        F.sort_array(F.collect_list(F.struct("first_day", "k", "n"))),
        lambda x: F.struct(x["k"], x["n"])))).alias("daily_json"))
    r = counts.role_split(reg)
    roles = r.groupBy("event_id").agg(F.to_json(F.map_from_entries(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "label", "n"))),
        lambda x: F.struct(x["label"], x["n"])))).alias("role_json"))
    return daily.join(roles, "event_id", "full")


def prompt_rows(answers: DataFrame, ctx: DataFrame, chunk: int = CHUNK_ANSWERS) -> DataFrame:
    """Theming requests for batch inference elsewhere.

    An answer list is split into chunks of about ``chunk`` answers by a hash
    of the row id, so no request (and no task) holds a whole hot event: list
    sizes and contexts, counted first, go to the answers, which never move to
    a task per event.
    """
    n = materialize(answers.groupBy("event_id", "key").agg(F.count(F.lit(1)).alias("n_list")), "list-sizes")
    ctx = ctx.join(n.select("event_id").distinct(), "event_id", "left_semi")
    if n.count() <= CONTEXT_BROADCAST_MAX_ROWS:
        n, ctx = F.broadcast(n), F.broadcast(ctx)
    a = (answers.join(n, ["event_id", "key"])
         .withColumn("chunk", md5_bucket("row_id", F.ceil(F.col("n_list") / chunk)).cast("bigint")))
    block = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_id", "answer"))),
                                     lambda x: F.concat(F.lit("- "), x["answer"])), "\n")
    g = a.groupBy("event_id", "key", "chunk").agg(F.count(F.lit(1)).cast("bigint").alias("n_answers"),
                                                  block.alias("answers_block"))
    j = g.join(ctx, "event_id", "left")
    prompt = F.concat(
        F.lit("LIST: "), F.col("key"), F.lit(" ("), F.col("n_answers").cast("string"), F.lit(" answers)\n"),
        F.col("answers_block"), F.lit("\n\nREGISTRATIONS BY DAY: "), F.coalesce("daily_json", F.lit("{}")),
        F.lit("\nROLE COUNTS: "), F.coalesce("role_json", F.lit("{}")))
    return j.select("event_id", "key", "chunk", "n_answers", "daily_json", "role_json", prompt.alias("prompt"))


# SQL check: theme inputs, md5 chunks, context maps (first key position, last
# value), then the prompt text.
_CTX_CTES = [
    DAYS, RS,
    """dd AS (SELECT event_id, strftime(day, '%b %d') AS lbl, min(day) AS first_day, arg_max(n, day) AS n
             FROM d WHERE day IS NOT NULL GROUP BY ALL)""",
    """dj AS (SELECT event_id, '{' || string_agg(CAST(to_json(lbl) AS VARCHAR) || ':' || CAST(n AS VARCHAR), ','
                                        ORDER BY first_day) || '}' AS daily_json FROM dd GROUP BY event_id)""",
    """rj AS (SELECT event_id, '{' || string_agg(CAST(to_json(label) AS VARCHAR) || ':' || CAST(n AS VARCHAR), ','
                                        ORDER BY pos) || '}' AS role_json FROM rs GROUP BY event_id)""",
    """ctx AS (SELECT coalesce(dj.event_id, rj.event_id) AS event_id, dj.daily_json, rj.role_json
              FROM dj FULL JOIN rj ON dj.event_id = rj.event_id)""",
]
PROMPT_ROWS_SQL = O.with_reg(*TOPIC_CTES, _ANS_CTE, *_CTX_CTES, f"""nl AS (
  SELECT event_id, key, count(*) AS n_list FROM ans GROUP BY ALL)""", f"""ch AS (
  SELECT a.event_id, a.key, a.row_id, a.answer,
    ('0x' || substr(md5(CAST(a.row_id AS VARCHAR)), 1, 15))::BIGINT
      % CAST(ceil(nl.n_list / {CHUNK_ANSWERS}) AS BIGINT) AS chunk
  FROM ans a JOIN nl ON nl.event_id = a.event_id AND nl.key = a.key)""", """g AS (
  SELECT event_id, key, chunk, count(*) AS n_answers,
         string_agg('- ' || answer, chr(10) ORDER BY row_id) AS block
  FROM ch GROUP BY ALL)""") + """
SELECT g.event_id, g.key, CAST(g.chunk AS BIGINT) AS chunk, CAST(g.n_answers AS BIGINT) AS n_answers,
  ctx.daily_json, ctx.role_json,
  'LIST: ' || g.key || ' (' || CAST(g.n_answers AS VARCHAR) || ' answers)' || chr(10) || g.block
    || chr(10) || chr(10) || 'REGISTRATIONS BY DAY: ' || coalesce(ctx.daily_json, '{}')
    || chr(10) || 'ROLE COUNTS: ' || coalesce(ctx.role_json, '{}') AS prompt
FROM g LEFT JOIN ctx ON ctx.event_id = g.event_id"""


@register("prompt_rows", PROMPT_ROWS_SQL)
def q_prompt_rows(spark, sf_dir):
    reg, k, mode, ans = _inputs(spark, sf_dir)
    return prompt_rows(ans, context_json(reg))


def json_text(c):
    """A string as a JSON string literal (null as ``null``)."""
    one = F.to_json(F.struct(c.alias("x")))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(one, F.lit(6), F.length(one) - 6))


def chart_payload(reg: DataFrame, topic_rows=None) -> DataFrame:
    """K2: per event JSON for the timeline, role, goals, topics and donut charts.

    ``topic_rows(reg, kpis, mode)`` gives the topic bar rows (default: option
    counts of choice events plus the blank row).
    """
    k = kpis.event_kpis(reg)
    mode = kpis.topic_mode(reg, k)
    if topic_rows is None:
        def topic_rows(r, kk, m):
            choice = m.where("topics_are_choices").select("event_id")
            return ranking.topic_rows(counts.topic_option_counts(r).join(choice, "event_id", "left_semi"), kk)

    def pairs(df, cols, name, order="pos"):
        """Per event ``[["label",n,...],...]`` as JSON text: labels quoted, counts numbers."""
        def item(x):
            parts = [x[c].cast("string") if c == "n" else json_text(x[c]) for c in cols]
            return F.concat(F.lit("["), *[p for q in parts for p in (F.lit(","), q)][1:], F.lit("]"))
        items = F.transform(F.sort_array(F.collect_list(F.struct(order, *cols))), item)
        return df.groupBy("event_id").agg(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias(name))

    dt = timeline.daily_timeline(reg)
    tl = dt.groupBy("event_id").agg(F.sort_array(F.collect_list(F.struct("day", "day_label", "n", "cumulative")))
                                    .alias("t")).select(
        "event_id", F.struct(F.col("t.day_label").alias("labels"), F.col("t.n").alias("daily"),
                             F.col("t.cumulative").alias("cumulative")).alias("timeline"))
    split = pairs(counts.role_split(reg), ["label", "n"], "split")
    raw = pairs(counts.role_combos(reg), ["combo", "n"], "raw")
    goals = pairs(ranking.with_no_answer(counts.goal_counts(reg), k), ["label", "n"], "goals")
    topics = pairs(topic_rows(reg, k, mode), ["label", "n", "colour"], "topics")
    exp = counts.experience_dist(reg).select("event_id", "pos", shorten_label("label").alias("label"), "n",
                                             palette_at(F.col("pos") - 1, K.DONUT_PALETTE).alias("colour"))
    donut = pairs(exp, ["label", "n", "colour"], "exp")
    j = (k.select("event_id").join(tl, "event_id", "left").join(split, "event_id", "left")
         .join(raw, "event_id", "left").join(goals, "event_id", "left").join(topics, "event_id", "left")
         .join(donut, "event_id", "left"))
    return j.select(
        "event_id",
        F.to_json("timeline").alias("timeline_json"),
        F.concat(F.lit('{"split":'), F.coalesce("split", F.lit("[]")), F.lit(',"raw":'), F.coalesce("raw", F.lit("[]")), F.lit("}")).alias("role_json"),
        F.coalesce("goals", F.lit("[]")).alias("goals_json"),
        F.col("topics").alias("topics_json"),
        F.coalesce("exp", F.lit("[]")).alias("exp_json"))


def _pairs_sql(name: str, src: str, cols: list[str]) -> str:
    """CTE ``name``: per event, ``[[c1, c2, ...], ...]`` as JSON text in ``pos`` order."""
    items = " || ',' || ".join(f"CAST(to_json(CAST({c} AS {'BIGINT' if c == 'n' else 'VARCHAR'})) AS VARCHAR)" for c in cols)
    return (f"{name} AS (SELECT event_id, '[' || string_agg('[' || {items} || ']', ',' ORDER BY pos) || ']' AS j "
            f"FROM {src} GROUP BY event_id)")


# SQL check: the same per-event chart JSON (choice topics; free-text events
# would need the theme job).  Counts are JSON numbers; a missing part is [].
CHART_PAYLOAD_SQL = O.with_reg(
    *TOPIC_CTES, DAYS, RS, RC, GC, ED,
    """dt AS (SELECT event_id, day, CAST(n AS BIGINT) AS n,
              CAST(sum(n) OVER (PARTITION BY event_id ORDER BY day
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum
            FROM d WHERE day IS NOT NULL)""",
    """tl AS (SELECT event_id, CAST(to_json(struct_pack(labels := list(strftime(day, '%b %d') ORDER BY day),
                                                       daily := list(n ORDER BY day),
                                                       cumulative := list(cum ORDER BY day))) AS VARCHAR) AS j
            FROM dt GROUP BY event_id)""",
    _pairs_sql("sp", "rs", ["label", "n"]),
    _pairs_sql("rw", "rc", ["combo", "n"]),
    "glp AS (SELECT event_id, max(pos) AS lp FROM gc GROUP BY event_id)",
    f"""gna AS (SELECT event_id, pos, label, n FROM gc
              UNION ALL
              SELECT k.event_id, glp.lp + 1 AS pos, {O.lit(K.NO_ANSWER_LABEL)} AS label, k.total - k.goals_answered AS n
              FROM k JOIN glp ON glp.event_id = k.event_id WHERE k.total - k.goals_answered > 0)""",
    _pairs_sql("gl", "gna", ["label", "n"]),
    """tr AS (SELECT tc.event_id, tc.pos, tc.label, tc.n FROM tc JOIN mode ON mode.event_id = tc.event_id
            WHERE mode.topics_are_choices)""",
    "tlp AS (SELECT event_id, max(pos) AS lp FROM tr GROUP BY event_id)",
    f"""trb AS (SELECT event_id, pos, label, n, {O.palette('pos - 1', K.BAR_PALETTE, K.BAR_DEFAULT)} AS colour FROM tr
              UNION ALL
              SELECT k.event_id, coalesce(tlp.lp, 0) + 1 AS pos, {O.lit(K.BLANK_TOPICS_LABEL)} AS label,
                     k.total - k.topics_answered AS n, {O.lit(K.BAR_DEFAULT)} AS colour
              FROM k LEFT JOIN tlp ON tlp.event_id = k.event_id)""",
    _pairs_sql("tp", "trb", ["label", "n", "colour"]),
    f"""exd AS (SELECT event_id, pos, {O.shorten('label')} AS label, n,
                     {O.palette('pos - 1', K.DONUT_PALETTE)} AS colour FROM ed)""",
    _pairs_sql("ex", "exd", ["label", "n", "colour"])) + """
SELECT k.event_id, tl.j AS timeline_json,
  '{"split":' || coalesce(sp.j, '[]') || ',"raw":' || coalesce(rw.j, '[]') || '}' AS role_json,
  coalesce(gl.j, '[]') AS goals_json, tp.j AS topics_json, coalesce(ex.j, '[]') AS exp_json
FROM k LEFT JOIN tl ON tl.event_id = k.event_id LEFT JOIN sp ON sp.event_id = k.event_id
  LEFT JOIN rw ON rw.event_id = k.event_id LEFT JOIN gl ON gl.event_id = k.event_id
  LEFT JOIN tp ON tp.event_id = k.event_id LEFT JOIN ex ON ex.event_id = k.event_id"""


@register("chart_payload", CHART_PAYLOAD_SQL)
def q_chart_payload(spark, sf_dir):
    return chart_payload(load_reg(spark, sf_dir),
                         lambda r, kk, m: topic_rows_for(spark, sf_dir, r, kk, m))

