"""Prompt rows and chart payloads against the tables they are built from."""

import json

import __spark_entry__ as E
from rsvpark.operators import counts, kpis, themes
from rsvpark.plans.theme_queries import chart_payload, json_text, context_json, prompt_rows
from rsvpark.sources.fixture import load_reg
from tests.conftest import SF_SMALL


def test_prompt_rows_cover_every_answer_once(spark):
    reg = load_reg(spark, SF_SMALL)
    k = kpis.event_kpis(reg)
    ans = themes.theme_inputs(reg, kpis.topic_mode(reg, k))
    rows = prompt_rows(ans, context_json(reg), chunk=7).collect()
    n_ans = {(r.event_id, r.key): r["count"] for r in ans.groupBy("event_id", "key").count().collect()}
    got = {}
    for r in rows:
        got[(r.event_id, r.key)] = got.get((r.event_id, r.key), 0) + r.n_answers
        assert r.prompt.count("\n- ") + r.prompt.startswith("- ") >= r.n_answers - 1
        assert r.n_answers <= 7 * 4          # hash chunks stay near the target size
    assert got == n_ans
    daily = json.loads(rows[0].daily_json)
    assert all(isinstance(v, int) for v in daily.values())


def test_chart_payload_matches_tables(spark):
    reg = load_reg(spark, SF_SMALL)
    pay = {r.event_id: r for r in chart_payload(reg).collect()}
    split = counts.role_split(reg).collect()
    for ev, r in pay.items():
        role = json.loads(r.role_json)
        exp = sorted([[x.label, x.n] for x in split if x.event_id == ev],
                     key=lambda p: [x.pos for x in split if x.event_id == ev and x.label == p[0]][0])
        assert role["split"] == exp
        tl = json.loads(r.timeline_json)
        assert tl["cumulative"][-1] == sum(tl["daily"])
        topics = json.loads(r.topics_json)
        assert topics[-1][0] == "No specific ask / blank"
        # counts are numbers: the page adds them
        assert sum(n for _, n in role["split"]) == sum(x.n for x in split if x.event_id == ev)
        assert all(isinstance(p[1], int) for p in role["raw"] + topics + json.loads(r.goals_json) + json.loads(r.exp_json))


def test_json_text_of_odd_labels(spark):
    labels = ['a"b', "c\\d", "e\nf", "é 漢", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, x string")
    got = {r.i: json.loads(r.j) for r in df.select("i", json_text(df.x).alias("j")).collect()}
    assert [got[i] for i in range(len(labels))] == labels


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == df.select("event_id").distinct().count() >= 1
    assert {"total", "peak_day", "money_blurb"} <= set(df.columns)



def test_context_maps_do_not_need_last_win(spark):
    """Day labels repeat across years; the maps are built from unique labels,
    so Spark's default (raising) duplicate-key policy is fine."""
    reg = load_reg(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        rows = context_json(reg).collect()
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", old)
    days = reg.selectExpr("event_id", "to_date(order_ts) AS d").where("d IS NOT NULL").distinct()
    labels = days.selectExpr("event_id", "date_format(d, 'MMM dd') AS k")
    assert labels.count() > labels.distinct().count()          # the fixture has repeated labels
    for r in rows:
        assert len(json.loads(r.daily_json)) == labels.where(f"event_id = '{r.event_id}'").distinct().count()


def test_report_sinks_round_trip(spark, workdir):
    """K1/K2/K4 and the theme table are written per event and read back equal
    to the query results; a second run replaces, not appends."""
    import __spark_entry__ as E
    from rsvpark.sources.sinks import write_report
    reg = load_reg(spark, SF_SMALL)
    paths = write_report(reg, workdir + "/report")
    write_report(reg, workdir + "/report")
    q = E.queries()
    stats = spark.read.parquet(paths["stats"])
    assert sorted(map(tuple, stats.select("event_id", "total", "peak_day").collect())) == \
        sorted(map(tuple, q["event_stats"](spark, SF_SMALL).select("event_id", "total", "peak_day").collect()))
    charts = {r.event_id: r for r in spark.read.json(paths["charts"]).collect()}
    want = {r.event_id: r for r in q["chart_payload"](spark, SF_SMALL).collect()}
    assert set(charts) == set(want)
    assert all(charts[e].timeline_json == want[e].timeline_json for e in want)
    key = ["event_id", "key", "chunk", "n_answers", "prompt"]
    prompts = spark.read.schema("key string, chunk long, n_answers long, prompt string, event_id string").json(paths["prompts"]).select(key)
    assert sorted(map(tuple, prompts.collect())) == sorted(map(tuple, q["prompt_rows"](spark, SF_SMALL).select(key).collect()))
    assert spark.read.parquet(paths["themes"]).count() == q["themes_kmeans"](spark, SF_SMALL).count()


def test_drop_folder_to_report(spark, workdir):
    """Exports dropped in a folder, ingested, reported: equal to the report of the exports read directly."""
    from rsvpark.sources.sinks import write_report, write_report_from_exports
    from rsvpark.streaming.ingest import ingest_drops, read_registrations
    from tests.trap import TRAP_HEADER, TRAP_ROWS, write_csv
    drop = workdir + "/drop"
    write_csv(drop, "trap event.csv", TRAP_HEADER, TRAP_ROWS)
    write_csv(drop, "short.csv", "Order Date,Question for the guest", ["2025-09-01,Why?", "2025-09-02,no", "2025-09-02,How?"])
    write_csv(drop, "silent.csv", "Order Date,Question for the guest", ["2025-09-01,no", "2025-09-02,"])
    direct = write_report_from_exports(spark, drop, workdir + "/direct")
    ingest_drops(spark, drop, workdir + "/table")
    landed = write_report(read_registrations(spark, workdir + "/table"), workdir + "/landed")
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    for name, read in (("stats", spark.read.parquet), ("charts", spark.read.json), ("prompts", spark.read.json), ("themes", spark.read.parquet)):
        assert rows(read(direct[name])) == rows(read(landed[name])), name
    stats = {r.event_id: r for r in spark.read.parquet(landed["stats"]).collect()}
    assert stats["short"].attending == stats["short"].total == 3 and stats["short"].ticket_types == "General Admission"
    assert stats["trap-event"].attending == 6
    # an event without genuine answers is marked, not pending for ever
    from rsvpark.operators.themes import version
    from rsvpark.streaming.pending import pending_events, stored_themes
    store = stored_themes(spark, f"{workdir}/landed/theme-store-{version()}")
    assert pending_events(read_registrations(spark, workdir + "/table"), store).count() == 0
    assert "silent" not in {r.event_id for r in spark.read.parquet(landed["themes"]).collect()}


def test_insights_sql_cuts_long_labels_like_the_code(spark):
    import duckdb

    from rsvpark.operators import report
    from rsvpark.plans import more_queries as M
    labels = {"short": "Ops", "words": " ".join(["quite"] * 9), "long": "x" * 300, "edge": "y" * 112, "over": "z" * 113, "none": None}
    rows = [(e, None, "Mon Sep 01", 3, 30, 10) for e in labels]
    peak = spark.createDataFrame(rows, "event_id string, peak_day date, peak_label string, peak_n long, peak_pct int, total long")
    roles = spark.createDataFrame([(e, v, 7, 1) for e, v in labels.items() if v], "event_id string, label string, n long, pos long")
    got = {r.event_id: r.role_insight for r in report.insights(peak, roles).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE p (event_id VARCHAR, peak_day DATE, peak_label VARCHAR, peak_n BIGINT, peak_pct INT, total BIGINT)")
    con.execute("CREATE TABLE r (event_id VARCHAR, label VARCHAR, n BIGINT, pos BIGINT)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?, ?, ?, ?)", rows)
    con.executemany("INSERT INTO r VALUES (?, ?, 7, 1)", [(e, v) for e, v in labels.items() if v])
    want = dict(con.execute(f"SELECT p.event_id, {M._RL} FROM p LEFT JOIN r ON r.event_id = p.event_id AND r.pos = 1").fetchall())
    assert got == want and all(len(v) < 160 for v in got.values()) and got["long"].endswith("registrations).") and "…" in got["over"]


def test_prompt_rows_move_answers_by_chunk_only(spark):
    """No exchange by event (or list) lies above the answers: a hot event's texts never meet in one task."""
    import re
    rows = [("e", "speaker_q", i, f"answer {i}") for i in range(40)]
    ans = spark.createDataFrame(rows, "event_id string, key string, row_id long, answer string")
    ctx = spark.createDataFrame([("e", "{}", "{}")], "event_id string, daily_json string, role_json string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prompt_rows(ans, ctx, chunk=10)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in re.sub(r"SortMergeJoin [^\n]*LeftSemi", "", plan), plan
        assert sum(r.n_answers for r in out.collect()) == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
