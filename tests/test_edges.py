"""Edge cases of the CSV source and the operators."""

import pytest

from rsvpark.operators import counts, kpis, timeline
from rsvpark.sources.csv_export import load_exports, read_exports
from tests.trap import TRAP_HEADER, TRAP_ROWS, write_csv


def test_header_only_export(spark, workdir):
    write_csv(workdir, "empty.csv", TRAP_HEADER, [])
    regs, cmap, _ = read_exports(spark, workdir)
    assert regs.count() == 0
    assert kpis.event_kpis(regs).count() == 0


def test_missing_optional_columns(spark, workdir):
    cols = TRAP_HEADER.split(",")
    keep = [i for i, c in enumerate(cols) if c not in ("Ticket Type", "Attendee Status")]
    header = ",".join(cols[i] for i in keep)
    rows = ["1,2025-09-01 09:00:00,0.00,Tech,Expert,A | B,Why?,X | Y",
            "2,2025-09-02 09:00:00,5.50,Data,Beginner,A,,X"]
    write_csv(workdir, "short form.csv", header, rows)
    regs, cmap, miss = read_exports(spark, workdir)
    k = kpis.event_kpis(regs).collect()[0]
    assert k.ticket_types == "General Admission"
    assert k.attending == 2
    m = miss.collect()[0]
    assert m.missing == ["attendee_status", "ticket_type"]
    assert float(k.total_paid) == 5.5


def test_missing_order_date_fails(spark, workdir):
    write_csv(workdir, "nodate.csv", "Name,Role", ["a,Tech"])
    with pytest.raises(ValueError):
        read_exports(spark, workdir)


def test_long_row_fails_short_row_pads(spark, workdir):
    write_csv(workdir, "long.csv", "Order Date,Role", ["2025-09-01,Tech,EXTRA"])
    regs, _, _ = read_exports(spark, workdir)
    with pytest.raises(Exception):
        regs.collect()
    d2 = workdir + "/short"
    write_csv(d2, "short.csv", "Order Date,Role,Which future topic?", ["2025-09-01,Tech"])
    regs, _, _ = read_exports(spark, d2)
    r = regs.collect()[0]
    assert r.role == "Tech" and r.future_topics is None


def test_duplicate_headers_first_wins(spark, workdir):
    write_csv(workdir, "dup.csv", "Order Date,Your role,Your role", ["2025-09-01,First,Second"])
    regs, cmap, _ = read_exports(spark, workdir)
    assert regs.collect()[0].role == "First"


def test_override_wins_and_is_checked(spark, workdir):
    write_csv(workdir, "ov.csv", "Order Date,Your role,Job title", ["2025-09-01,A,B"])
    regs, cmap, miss = read_exports(spark, workdir, overrides={"role": "Job title", "speaker_q": "Nope"})
    assert regs.collect()[0].role == "B"
    assert "speaker_q" in miss.collect()[0].missing


def test_event_key_from_odd_file_name(spark, workdir):
    write_csv(workdir, "My Event [Sep] (v2).csv", "Order Date", ["2025-09-01"])
    regs, _, _ = read_exports(spark, workdir)
    assert regs.collect()[0].event_id == "My-Event-Sep-v2"


def test_peak_tie_takes_earliest_and_windows_by_event(spark):
    df = spark.createDataFrame(
        [("a", 1, "2025-01-02 10:00:00"), ("a", 2, "2025-01-01 10:00:00"),
         ("b", 3, "2025-02-01 00:00:00"), ("b", 4, "2025-02-01 01:00:00"), ("b", 5, None)],
        "event_id string, row_id long, ts string").selectExpr(
        "event_id", "row_id", "to_timestamp_ntz(ts) AS order_ts")
    p = {r.event_id: r for r in timeline.peak_day(df).collect()}
    assert str(p["a"].peak_day) == "2025-01-01" and p["a"].peak_pct == 50
    assert p["b"].peak_n == 2 and p["b"].total == 3 and p["b"].peak_pct == 67


def test_result_independent_of_partitioning(spark):
    from tests.conftest import SF_SMALL
    from rsvpark.sources.fixture import load_reg
    reg = load_reg(spark, SF_SMALL)
    a = sorted(map(tuple, counts.role_split(reg).collect()))
    b = sorted(map(tuple, counts.role_split(reg.repartition(13, "row_id")).collect()))
    assert a == b


def test_timeline_properties(spark):
    from tests.conftest import SF_SMALL
    from rsvpark.sources.fixture import load_reg
    reg = load_reg(spark, SF_SMALL)
    d = timeline.daily_timeline(reg).collect()
    by_ev = {}
    for r in d:
        by_ev.setdefault(r.event_id, []).append(r)
    dated = {r.event_id: r.c for r in reg.where("order_ts IS NOT NULL").groupBy("event_id")
             .count().withColumnRenamed("count", "c").collect()}
    for ev, rows in by_ev.items():
        rows.sort(key=lambda r: r.day)
        assert sum(r.n for r in rows) == dated[ev] == rows[-1].cumulative


def test_mixed_layouts_in_one_read(spark, workdir):
    """Files with different header orders, wordings and a byte-order mark are
    read in one pass; every row takes its own file's layout."""
    write_csv(workdir, "a.csv", "Order Date,Your role,What would you like to ask the speaker?",
              ["2025-09-01 09:00:00,Tech,Why?", "2025-09-02 09:00:00,Data,How?"])
    write_csv(workdir, "b.csv", "\ufeffQuestion for the guest,Which industry?,Ticket Type,Order date",
              ["When?,Retail,VIP,2025-10-01 10:00:00"])
    write_csv(workdir, "c.csv", "Order Date,Role", ["2025-11-01 08:00:00,Ops", "2025-11-02 08:00:00,Dev,EXTRA"])
    regs, cmap, _ = read_exports(spark, workdir, on_bad="quarantine")
    got = sorted((r.event_id, r.role, r.speaker_q, r.ticket_type, str(r.order_ts)) for r in regs.collect())
    assert got == [("a", "Data", "How?", None, "2025-09-02 09:00:00"),
                   ("a", "Tech", "Why?", None, "2025-09-01 09:00:00"),
                   ("b", "Retail", "When?", "VIP", "2025-10-01 10:00:00"),
                   ("c", "Ops", None, None, "2025-11-01 08:00:00")]
    first = {(r.event_id, r.role) for r in regs.where("row_id IS NOT NULL").collect()}
    assert len(first) == 4
    b_map = {r.key: r.header for r in cmap.collect() if r.file_path.endswith("b.csv")}
    assert b_map["order_date"] == "Order date" and b_map["speaker_q"] == "Question for the guest"


@pytest.mark.parametrize("bits", [0, 3, 20])
def test_count_positions_match_one_window(spark, monkeypatch, bits):
    """Bounded-window positions equal one row_number over the whole group,
    with ties on counts across many first-row buckets."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F
    monkeypatch.setattr(counts, "ROW_BUCKET_BITS", bits)
    rnd = random.Random(7)
    # Distinct labels never share a first row and place (as in real counts).
    firsts = rnd.sample(range(1 << 24), 800)
    rows = [(ev, f"L{i}", rnd.choice([1, 1, 1, 2, 3, 7]), firsts[j * 400 + i], rnd.randrange(1, 4))
            for j, ev in enumerate(("a", "b")) for i in range(400)]
    agg = spark.createDataFrame(rows, "event_id string, label string, n long, _first_row long, _first_pos int")
    got = {(r.event_id, r.label): r.pos for r in counts.rank_by_count(agg).collect()}
    w = Window.partitionBy("event_id").orderBy(F.desc("n"), "_first_row", "_first_pos")
    want = {(r.event_id, r.label): r.pos for r in agg.select("event_id", "label", F.row_number().over(w)
                                                          .alias("pos")).collect()}
    assert got == want


@pytest.mark.parametrize("bits", [0, 2, 20])
def test_running_share_and_rank_match_one_window(spark, monkeypatch, bits):
    """Block running sums and histogram ranks equal whole-group windows."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from rsvpark.operators import ranking
    monkeypatch.setattr(ranking, "RUN_BLOCK_BITS", bits)
    rnd = random.Random(11)
    rows = [(ev, f"L{p}", rnd.choice([None, 1, 2, 2, 5, 9]), p) for ev in ("a", "b") for p in range(1, 301)]
    df = spark.createDataFrame(rows, "event_id string, label string, n long, pos long")
    w_run = Window.partitionBy("event_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    nn = df.fillna({"n": 0})
    want_cum = {(r.event_id, r.pos): r.c for r in nn.select("event_id", "pos", F.sum("n").over(w_run)
                                                             .alias("c")).collect()}
    got_cum = {(r.event_id, r.pos): r.cum for r in ranking.running_sum(nn, ["event_id"], "pos", "n", "cum")
               .collect()}
    assert got_cum == want_cum
    w_rank = Window.partitionBy("event_id").orderBy(F.desc(F.coalesce("n", F.lit(0))))
    want_rank = {(r.event_id, r.pos): r.rk for r in df.select("event_id", "pos", F.rank().over(w_rank)
                                                               .alias("rk")).collect()}
    got_rank = {(r.event_id, r.pos): r["rank"] for r in ranking.competition_rank(df).collect()}
    assert got_rank == want_rank


def test_trailing_empty_cell_is_not_a_long_row(spark, workdir):
    write_csv(workdir, "comma.csv", "Order Date,Role", ["2025-09-01 10:00:00,Tech,", "2025-09-02 10:00:00,Data"])
    regs, _, _ = read_exports(spark, workdir)
    assert sorted(r.role for r in regs.collect()) == ["Data", "Tech"]


def test_landing_never_broadcasts_document_texts(spark):
    """Documents carry whole texts: the landing plan moves them by a
    hash partitioning on doc_id (sort-merge join), never as a broadcast."""
    from tests.conftest import SF_SMALL
    from rsvpark.sources.fixture import build_reg
    plan = build_reg(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize("pos", [257, 300, 2000])
def test_value_far_past_the_header_is_not_lost(spark, workdir, pos):
    row = "2025-09-01,Tech" + "," * (pos - 2) + "LATE"
    write_csv(workdir, "far.csv", "Order Date,Role", [row, "2025-09-02,Ops"])
    regs, _, _ = read_exports(spark, workdir)
    with pytest.raises(Exception, match="more cells than the header"):
        regs.collect()
    e = load_exports(spark, workdir, on_bad="quarantine")
    assert [r.role for r in e.registrations.collect()] == ["Ops"]
    q = e.quarantine.collect()
    assert len(q) == 1 and q[0].cells[pos - 1] == "LATE" and q[0].event_id == "far"


def test_header_of_300_columns(spark, workdir):
    header = ",".join([f"Extra {i}" for i in range(298)] + ["Order Date", "Your role"])
    write_csv(workdir, "wide.csv", header, ["x," * 298 + "2025-09-01,Tech"])
    regs, _, _ = read_exports(spark, workdir)
    assert [(r.role, str(r.order_ts)) for r in regs.collect()] == [("Tech", "2025-09-01 00:00:00")]


def test_amounts_and_dates_are_read_or_refused(spark, workdir):
    rows = ['2025-09-01,"$1,200.50"', '"Sep 1, 2025",20 AUD', '9/2/2025 10:30,.5', '2025/9/3,-3', '3 Sep 2025,', "2025-09-04,NaN",
            '2025-09-05,"12,50"', "2025-09-06,USD 20", '2025-09-07,"12,50 EUR"', "2025-09-08,1 200 refunded", "someday,1", ",2"]
    write_csv(workdir, "mixed.csv", "Order Date,Total Paid", rows)
    e = load_exports(spark, workdir, on_bad="quarantine")
    got = sorted(((str(r.order_ts), None if r.total_paid is None else float(r.total_paid)) for r in e.registrations.collect()), key=str)
    assert got == sorted([("2025-09-01 00:00:00", 1200.5), ("2025-09-01 00:00:00", 20.0), ("2025-09-02 10:30:00", 0.5),
                          ("2025-09-03 00:00:00", -3.0), ("2025-09-03 00:00:00", None), ("2025-09-04 00:00:00", None), ("None", 2.0)], key=str)
    assert sorted(r.reason for r in e.quarantine.collect()) == ["unreadable amount"] * 4 + ["unreadable order date"]
    with pytest.raises(Exception, match="unreadable"):
        read_exports(spark, workdir)[0].collect()


def test_two_files_with_one_event_key_fail(spark, workdir):
    write_csv(workdir, "a.b.csv", "Order Date", ["2025-09-01"])
    write_csv(workdir, "a-b.csv", "Order Date", ["2025-09-02"])
    with pytest.raises(ValueError, match="a-b.csv.*a.b.csv|a.b.csv.*a-b.csv"):
        read_exports(spark, workdir)


def test_wrong_override_is_reported_and_detection_stands(spark, workdir):
    write_csv(workdir, "ov.csv", "Order Date,Your role", ["2025-09-01,A"])
    e = load_exports(spark, workdir, overrides={"role": "Job title"})
    assert e.registrations.collect()[0].role == "A"
    assert [(r.key, r.header) for r in e.wrong_overrides.collect()] == [("role", "Job title")]


def test_a_file_without_order_date_is_set_aside(spark, workdir):
    write_csv(workdir, "good.csv", "Order Date,Role", ["2025-09-01,A"])
    write_csv(workdir, "bad.csv", "Name,Role", ["x,B", "y,C"])
    e = load_exports(spark, workdir, on_bad="quarantine")
    assert [r.event_id for r in e.registrations.collect()] == ["good"]
    assert [(r.event_id, r.reason) for r in e.quarantine.collect()] == [("bad", "file has no order date column")] * 2


def test_headers_are_found_without_sorting_records(spark, workdir):
    from rsvpark.sources import csv_export as C
    write_csv(workdir, "e.csv", TRAP_HEADER, TRAP_ROWS)
    plan = C.scan_files(spark, C.list_csv_files(spark, workdir))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
