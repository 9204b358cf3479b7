"""Folder-drop ingestion: new exports land once; a second run adds nothing."""

import os

import pytest

from rsvpark.streaming.ingest import ingest_drops, read_registrations
from rsvpark.streaming.pending import pending_events, store_themes, stored_themes
from tests.trap import TRAP_HEADER, TRAP_ROWS, write_csv


def test_ingest_twice(spark, workdir):
    drop = os.path.join(workdir, "drop")
    table = os.path.join(workdir, "registrations")
    write_csv(drop, "event-a.csv", TRAP_HEADER, TRAP_ROWS)
    ingest_drops(spark, drop, table)
    assert read_registrations(spark, table).count() == 8
    ingest_drops(spark, drop, table)          # nothing new
    assert read_registrations(spark, table).count() == 8
    write_csv(drop, "event-b.csv", TRAP_HEADER, TRAP_ROWS[:3])
    ingest_drops(spark, drop, table)
    regs = read_registrations(spark, table)
    counts = {r.event_id: r["count"] for r in regs.groupBy("event_id").count().collect()}
    assert counts == {"event-a": 8, "event-b": 3}

    store = os.path.join(workdir, "themes")
    assert {r.event_id for r in pending_events(regs, stored_themes(spark, store)).collect()} == {
        "event-a", "event-b"}
    done = spark.createDataFrame([("event-a", "speaker_q", 0, "T", 1, ["q"])],
                                 "event_id string, key string, theme_id bigint, title string, "
                                 "count bigint, quotes array<string>")
    store_themes(done, store)
    assert [r.event_id for r in pending_events(regs, stored_themes(spark, store)).collect()] == ["event-b"]


@pytest.mark.parametrize("name,event", [("a b.csv", "a-b"), ("a+b%20c.csv", "a-b-20c"), ("My Event [Sep] (v2) 100%.csv", "My-Event-Sep-v2-100")])
def test_odd_file_names_are_ingested(spark, workdir, name, event):
    write_csv(f"{workdir}/drop", name, TRAP_HEADER, TRAP_ROWS)
    ingest_drops(spark, f"{workdir}/drop", f"{workdir}/t")
    regs = read_registrations(spark, f"{workdir}/t")
    assert regs.count() == 8 and regs.first().event_id == event


def test_ingested_tables_know_which_columns_an_export_has(spark, workdir):
    from rsvpark.operators import kpis
    write_csv(f"{workdir}/drop", "short.csv", "Order Date,Role", ["2025-09-01,A", "2025-09-02,B"])
    ingest_drops(spark, f"{workdir}/drop", f"{workdir}/t")
    k = kpis.event_kpis(read_registrations(spark, f"{workdir}/t")).collect()[0]
    assert (k.attending, k.ticket_types) == (2, "General Admission")


def test_a_later_file_with_a_landed_event_key_fails(spark, workdir):
    write_csv(f"{workdir}/drop", "a.b.csv", "Order Date", ["2025-09-01"])
    ingest_drops(spark, f"{workdir}/drop", f"{workdir}/t")
    write_csv(f"{workdir}/drop", "a-b.csv", "Order Date", ["2025-09-02", "2025-09-03"])
    with pytest.raises(Exception, match="event key"):
        ingest_drops(spark, f"{workdir}/drop", f"{workdir}/t")
    assert read_registrations(spark, f"{workdir}/t").count() == 1


def _roles(spark, table):
    return sorted((r.event_id, r.role) for r in read_registrations(spark, table).collect())


def test_a_rewritten_export_replaces_its_event(spark, workdir):
    drop, table = f"{workdir}/drop", f"{workdir}/t"
    write_csv(drop, "e.csv", "Order Date,Role", ["2025-09-01,A"])
    write_csv(drop, "other.csv", "Order Date,Role", ["2025-09-01,X"])
    assert ingest_drops(spark, drop, table) == 2
    write_csv(drop, "e.csv", "Order Date,Role", ["2025-09-01,A", "2025-09-02,B", "2025-09-03,C"])
    assert ingest_drops(spark, drop, table) == 1
    assert _roles(spark, table) == [("e", "A"), ("e", "B"), ("e", "C"), ("other", "X")]
    assert ingest_drops(spark, drop, table) == 0
    assert len(os.listdir(f"{table}/event_id=e")) == 1
    write_csv(drop, "e.csv", "Order Date,Role", [])          # an export without rows empties its event
    assert ingest_drops(spark, drop, table) == 1
    assert _roles(spark, table) == [("other", "X")]


def test_a_renamed_export_replaces_its_event_and_a_deleted_one_stays(spark, workdir):
    drop, table = f"{workdir}/drop", f"{workdir}/t"
    write_csv(drop, "a b.csv", "Order Date,Role", ["2025-09-01,A"])
    write_csv(drop, "c.csv", "Order Date,Role", ["2025-09-01,C"])
    ingest_drops(spark, drop, table)
    os.remove(f"{drop}/a b.csv")
    write_csv(drop, "a-b.csv", "Order Date,Role", ["2025-09-01,NEW"])
    assert ingest_drops(spark, drop, table) == 1
    assert _roles(spark, table) == [("a-b", "NEW"), ("c", "C")]
    os.remove(f"{drop}/c.csv")
    assert ingest_drops(spark, drop, table) == 0 and ("c", "C") in _roles(spark, table)
    ingest_drops(spark, drop, table, drop_deleted=True)
    assert _roles(spark, table) == [("a-b", "NEW")]
    write_csv(drop, "c.csv", "Order Date,Role", ["2025-09-01,BACK"])
    ingest_drops(spark, drop, table)
    assert _roles(spark, table) == [("a-b", "NEW"), ("c", "BACK")]


def test_a_run_that_stops_leaves_the_version_before(spark, workdir, monkeypatch):
    from rsvpark.streaming import ingest as I
    drop, table = f"{workdir}/drop", f"{workdir}/t"
    write_csv(drop, "e.csv", "Order Date,Role", ["2025-09-01,A"])
    ingest_drops(spark, drop, table)
    write_csv(drop, "e.csv", "Order Date,Role", ["2025-09-01,B", "2025-09-02,B"])
    with monkeypatch.context() as m:
        m.setattr(I, "_write_versions", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest_drops(spark, drop, table)
    assert _roles(spark, table) == [("e", "A")]
    ingest_drops(spark, drop, table, max_files=1)
    assert _roles(spark, table) == [("e", "B")] * 2


def test_quarantine_follows_the_versions(spark, workdir):
    from rsvpark.streaming.ingest import read_quarantine
    drop, table = f"{workdir}/drop", f"{workdir}/t"
    write_csv(drop, "e.csv", "Order Date,Role", ["2025-09-01,A", "someday,B"])
    ingest_drops(spark, drop, table, on_bad="quarantine")
    assert [r.reason for r in read_quarantine(spark, table).collect()] == ["unreadable order date"]
    write_csv(drop, "e.csv", "Order Date,Role", ["2025-09-01,A", "2025-09-02,B"])
    ingest_drops(spark, drop, table, on_bad="quarantine")
    assert read_quarantine(spark, table).count() == 0 and len(_roles(spark, table)) == 2
