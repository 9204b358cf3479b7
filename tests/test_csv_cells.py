"""No cell of an export is lost: quotes anywhere, wide rows, date orders and zones per file."""

import csv
import io
import random

import pytest

from rsvpark.sources.csv_export import load_exports, read_exports
from tests.trap import write_csv


def test_quotes_inside_unquoted_cells_hide_no_cell(spark, workdir):
    write_csv(workdir, "q.csv", "Order Date,Role,Note", ['2025-01-01,x 5" a,2 6" b,EXTRA', '2025-01-02,6" tall,ok'])
    with pytest.raises(Exception, match="more cells than the header"):
        read_exports(spark, workdir)[0].collect()
    e = load_exports(spark, workdir, on_bad="quarantine")
    assert [r.role for r in e.registrations.collect()] == ['6" tall']
    q = e.quarantine.collect()
    assert [c for c in q[0].cells if c] == ["2025-01-01", 'x 5" a', '2 6" b', "EXTRA"]


PIECES = ["a", '"', '""', ",", "\n", " ", "x,y", '5" 6"', "é", '"q"', "'", ""]


def _written(rng, n_rows, n_cells, style):
    """A CSV text and its cells as Python's csv reads them."""
    out = io.StringIO()
    rows = []
    for _ in range(n_rows):
        k = rng.choice([n_cells, n_cells, max(1, n_cells - 1), n_cells + rng.randrange(1, 4)])
        cells = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(4))) for _ in range(k)]
        if style == "bare":        # quotes inside cells that no quote opens
            cells = [c.replace(",", ";").replace("\n", " ").lstrip('"') for c in cells]
            line = ",".join(cells)
        else:
            b = io.StringIO()
            csv.writer(b, quoting=csv.QUOTE_ALL if style == "all" else csv.QUOTE_MINIMAL, lineterminator="").writerow(cells)
            line = b.getvalue()
        out.write("2025-01-01," + line + "\n")
    text = out.getvalue()
    for r in csv.reader(io.StringIO(text)):
        rows.append(r[1:])
    return text, rows


@pytest.mark.parametrize("style", ["minimal", "all", "bare"])
def test_random_cells_equal_pythons_csv(spark, workdir, style):
    """Each record is read back whole: in its columns, or set aside with all its cells."""
    rng = random.Random(style)
    want_good, want_bad = [], []
    for f in range(6):
        n = rng.randrange(1, 5)
        text, rows = _written(rng, 12, n, style)
        header = ",".join(["Order Date", "Your role", "Future topics", "Ask the guest", "AI experience"][:n + 1])
        with open(f"{workdir}/f{f}.csv", "w", encoding="utf-8", newline="") as h:
            h.write(header + "\n" + text)
        for r in rows:
            (want_bad if any(r[n:]) else want_good).append((f"f{f}", *[c for c in r[:n] + [""] * (n - len(r))] + [""] * (4 - n), *r[n:]))
    e = load_exports(spark, workdir, on_bad="quarantine")
    keys = ["role", "future_topics", "speaker_q", "experience"]
    good = [(r.event_id, *[r[k] or "" for k in keys]) for r in e.registrations.collect()]
    strip = lambda rows: sorted(r[:5] for r in rows)
    assert sorted(good) == strip(want_good)
    bad = sorted((r.event_id, "".join(c or "" for c in r.cells[1:])) for r in e.quarantine.collect())
    assert bad == sorted((r[0], "".join(r[1:])) for r in want_bad)


def _dates(e):
    return {r.event_id: [] for r in e.files.collect()} | {k: sorted(v) for k, v in _group(e).items()}


def _group(e):
    out = {}
    for r in e.registrations.collect():
        out.setdefault(r.event_id, []).append((str(r.order_ts), r.order_zone))
    return out


def test_date_order_is_the_files(spark, workdir):
    write_csv(workdir, "day-first.csv", "Order Date", ["13/01/2025", "02/01/2025 10:30", "3-1-2025", "4.1.2025 9:05 PM"])
    write_csv(workdir, "month-first.csv", "Order Date", ["01/13/2025", "01/02/2025"])
    write_csv(workdir, "open.csv", "Order Date", ["01/02/2025", "2025-03-04", '"Mar 5, 2025"'])
    write_csv(workdir, "mixed.csv", "Order Date", ["13/01/2025", "01/13/2025", "2025-01-14"])
    e = load_exports(spark, workdir, on_bad="quarantine")
    got = {k: [x[0] for x in v] for k, v in _dates(e).items()}
    assert got == {
        "day-first": ["2025-01-02 10:30:00", "2025-01-03 00:00:00", "2025-01-04 21:05:00", "2025-01-13 00:00:00"],
        "month-first": ["2025-01-02 00:00:00", "2025-01-13 00:00:00"],
        "open": ["2025-01-02 00:00:00", "2025-03-04 00:00:00", "2025-03-05 00:00:00"],
        "mixed": ["2025-01-14 00:00:00"]}
    q = e.quarantine.collect()
    assert [(r.event_id, r.reason, r.date_votes) for r in q] == [("mixed", "the file's dates fit no one order of day and month", 0)] * 2


def test_zones_are_kept_and_the_day_is_the_writers(spark, workdir):
    write_csv(workdir, "z.csv", "Order Date", ["2025-01-01T23:30:00+10:00", "2025-01-02 00:30:00Z", "2025-01-03 01:00:00.5 -0500", "13/01/2025 10:00 UTC",
                                               "2025-01-04 08:00", "2025-01-05 10:00 Europe/London", "2025-01-06 10:00 EST"])
    e = load_exports(spark, workdir, on_bad="quarantine")
    assert _dates(e)["z"] == [("2025-01-01 23:30:00", "+10:00"), ("2025-01-02 00:30:00", "Z"), ("2025-01-03 01:00:00.500000", "-0500"),
                              ("2025-01-04 08:00:00", None), ("2025-01-05 10:00:00", "Europe/London"), ("2025-01-13 10:00:00", "UTC")]
    assert [r.reason for r in e.quarantine.collect()] == ["unreadable order date"]
