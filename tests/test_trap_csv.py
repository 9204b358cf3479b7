"""Golden values on the 8-row trap export (FIXTURES.md section 2)."""

import datetime as dt

import pytest

from rsvpark.operators import counts, kpis, ranking, report, timeline
from rsvpark.sources.csv_export import read_exports
from tests.trap import TRAP_HEADER, TRAP_ROWS, write_csv


@pytest.fixture(scope="module")
def trap(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("trap"))
    write_csv(folder, "Trap Event (2025).csv", TRAP_HEADER, TRAP_ROWS)
    regs, cmap, miss = read_exports(spark, folder)
    regs = regs.cache()
    k = kpis.event_kpis(regs).cache()
    return regs, cmap, miss, k


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols[:1]).collect()]


def one(df):
    r = df.collect()
    assert len(r) == 1
    return r[0]


def test_event_key_and_mapping(trap):
    regs, cmap, miss, _ = trap
    assert {r.event_id for r in regs.select("event_id").distinct().collect()} == {"Trap-Event-2025"}
    m = {r.key: r.header for r in cmap.collect()}
    assert m["role"] == "Which role best describes you?"
    # "experience" hint matches the experience question before "how would you describe".
    assert m["experience"] == "How would you describe your AI experience?"
    assert m["speaker_q"] == "What would you like to ask the guest speaker?"
    assert m["future_topics"] == "Which future topic interests you?"
    assert miss.count() == 0


def test_total_daily_peak(trap):
    regs, _, _, k = trap
    assert one(k).total == 8
    d = timeline.daily_timeline(regs).orderBy("day").collect()
    assert [(r.day, r.n, r.cumulative) for r in d] == [
        (dt.date(2025, 9, 1), 2, 2), (dt.date(2025, 9, 2), 2, 4),
        (dt.date(2025, 9, 4), 2, 6), (dt.date(2025, 9, 5), 1, 7)]
    p = one(timeline.peak_day(regs))
    assert (p.peak_day, p.peak_n, p.peak_pct) == (dt.date(2025, 9, 1), 2, 25)
    assert p.peak_label == "Mon Sep 01"


def test_roles(trap):
    regs, _, _, k = trap
    rs = counts.role_split(regs).orderBy("pos").collect()
    assert [(r.label, r.n) for r in rs] == [
        ("Tech / IT", 5), ("Product", 2), ("Business / Entrepreneurship", 1), ("Data", 1), ("（学生）", 1)]
    combos = counts.role_combos(regs).collect()
    assert len(combos) == 7 and all(r.n == 1 for r in combos)
    assert {"Product,", "Tech / IT | Tech / IT"} <= {r.combo for r in combos}
    assert one(k).multi_role == 4


def test_experience(trap):
    regs, _, _, k = trap
    ed = counts.experience_dist(regs).orderBy("pos").collect()
    assert ed[0].label == "Intermediate" and ed[0].n == 2
    assert sorted(r.n for r in ed[1:]) == [1, 1, 1, 1, 1]
    e = one(kpis.experienced_kpi(k))
    assert (e.experienced, e.experienced_pct) == (5, 62)
    shorts = {r.short_label for r in report.experience_short(counts.experience_dist(regs)).collect()}
    assert {"Regular user", "Beginner", "advanced practitioner with many years of…"} <= shorts


def test_goals(trap):
    regs, _, _, k = trap
    gc = counts.goal_counts(regs).orderBy("pos").collect()
    assert [(r.label, r.n) for r in gc] == [("Networking", 4), ("Practical skills, tips", 2), ("（其他）", 1)]
    assert one(k).goals_answered == 6
    na = ranking.with_no_answer(counts.goal_counts(regs), k).orderBy("pos").collect()
    assert (na[-1].label, na[-1].n) == ("No answer", 2)
    s = one(report.goals_summary(counts.goal_counts(regs), k)).summary
    assert s == ("“Networking” leads with 4 of 6 attendees (67%), followed by “Practical skills, tips” "
                 "(2, 33%) and “（其他）” (1, 17%).")


def test_questions_and_filler(trap):
    _, _, _, k = trap
    r = one(k)
    assert r.engagement == 5
    assert r.speaker_filler == 2
    q = one(kpis.real_questions(k))
    assert (q.real_questions, q.real_pct) == (3, 38)


def test_topics(trap):
    regs, _, _, k = trap
    assert one(k).total - one(k).topics_answered == 2
    m = one(kpis.topic_mode(regs, k))
    assert m.topics_are_choices
    tc = counts.topic_option_counts(regs).orderBy("pos").collect()
    assert [(r.label, r.n) for r in tc] == [("Agents", 4), ("RAG", 3), ("Evals", 2)]
    tr = ranking.topic_rows(counts.topic_option_counts(regs), k).orderBy("pos").collect()
    assert (tr[-1].label, tr[-1].n, tr[-1].colour) == ("No specific ask / blank", 2, "var(--grey-bar)")
    assert [r.colour for r in tr[:3]] == ["var(--jade)", "var(--jade)", "var(--sage)"]


def test_tickets_money_attending(trap):
    _, _, _, k = trap
    r = one(k)
    assert r.ticket_types == "General Admission, Student, VIP"
    p = one(kpis.paid_total(k))
    assert (float(p.total_paid), p.money_blurb) == (0.0, "Free ($0 AUD)")
    a = one(kpis.attending(k))
    assert (a.attending, a.attending_pct) == (6, 75)


def test_na_tokens_and_whitespace(trap):
    regs, _, _, _ = trap
    by_row = {r.row_id: r for r in regs.collect()}
    ordered = [by_row[i] for i in sorted(by_row)]
    assert ordered[2].speaker_q is None          # n/a
    assert ordered[6].speaker_q is None          # None
    assert ordered[6].order_ts is None
    assert ordered[4].speaker_q == " What about cost,\nand risk?"
    assert ordered[7].speaker_q == 'How "safe" is it?'


def test_report_sentences_with_params(spark, trap):
    regs, _, _, k = trap
    mode = kpis.topic_mode(regs, k)
    stats = report.event_stats(k, timeline.peak_day(regs), mode)
    has_rows = mode.selectExpr("event_id", "n_labels > 0 AS has_topic_rows")
    params = spark.createDataFrame([("Trap-Event-2025", "Autumn Meetup")], "event_id string, event_name string")
    r = one(report.report_text(stats.join(has_rows, "event_id"), params))
    assert r.title == "Autumn Meetup · Registration Dashboard"
    assert r.kpi_total_sub == "General Admission, Student, VIP · Free ($0 AUD) · 75% confirmed Attending"
    assert r.kpi_peak_sub == "Mon Sep 01 — 25% of all registrations landed in one day"
    assert r.kpi_exp_sub == "5 of 8 attendees reported regular or advanced AI use"
    assert r.kpi_eng_sub.startswith("3 of 8 attendees")
    assert r.role_footnote.startswith("4 attendees selected more than one role")
    assert r.topics_desc.startswith("Options picked on the form")
    assert r.summary_text == ("Total registrations: 8 · Peak day: Sep 01 (2) · Regular/advanced AI users: 62% · "
                              "Asked a question: 38%")
