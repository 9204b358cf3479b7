"""Dates of exports are parsed where their cells land, not again for votes, checks and rows."""

import io
from contextlib import redirect_stdout

from rsvpark.sources.csv_export import load_exports
from tests.trap import TRAP_HEADER, TRAP_ROWS, write_csv


def test_dates_are_parsed_once(spark, workdir):
    write_csv(workdir, "a.csv", TRAP_HEADER, TRAP_ROWS)
    out = io.StringIO()
    with redirect_stdout(out):
        load_exports(spark, workdir).registrations.explain("extended")
    assert "gettimestamp" not in out.getvalue().lower() and "order_ts" in out.getvalue()
