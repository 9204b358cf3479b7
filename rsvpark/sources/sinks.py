"""Report outputs (K1, K2, K4; K3 is the theme store in ``streaming/pending.py``).

Every sink writes one folder per event (``partitionBy("event_id")``) with
dynamic partition overwrite, so writing the same events again replaces just
their folders: a retried or repeated run leaves the same files.  Nothing is
collected to the driver; each event's rows are written by the tasks that
computed them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _writer(df: DataFrame, *partition_cols: str):
    return (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_cols))


def write_event_stats(stats: DataFrame, path: str) -> None:
    """K1: the stats record, one row per event, as Parquet."""
    _writer(stats, "event_id").parquet(path)


def write_chart_payloads(payloads: DataFrame, path: str) -> None:
    """K2: chart JSON per event, as JSON lines (one object per event)."""
    _writer(payloads, "event_id").json(path)


def write_prompts(prompts: DataFrame, path: str) -> None:
    """K4: theming requests as JSON lines per event: list, chunk and text, so
    that every request can be read back as it was."""
    _writer(prompts.select("event_id", "key", "chunk", "n_answers", "prompt"), "event_id").json(path)


def write_report(reg: DataFrame, out: str) -> dict[str, str]:
    """The reference's one run, for every event of ``reg`` at once: stats
    record, chart payloads, prompts, and themes (computed for events that have
    none stored under ``out`` yet).

    ``reg`` are registrations however they came: read exports, a landed table
    of the folder drop, or a view.  Returns the folder of each output.
    """
    from rsvpark.operators import report, timeline
    from rsvpark.operators.themes import version
    from rsvpark.plans.theme_queries import chart_payload, context_json, prompt_rows
    from rsvpark.plans.theme_store import theme_list, themes_for, topic_rows_of

    out = out.rstrip("/")
    paths = {name: f"{out}/{name}" for name in ("stats", "charts", "prompts", "themes")}
    store = f"{out}/theme-store-{version()}"
    k, mode, ans = theme_list(reg)
    write_event_stats(report.event_stats(k, timeline.peak_day(reg), mode), paths["stats"])
    write_chart_payloads(chart_payload(reg, lambda r, kk, m: topic_rows_of(r, kk, m, store)), paths["charts"])
    write_prompts(prompt_rows(ans, context_json(reg)), paths["prompts"])
    _writer(themes_for(reg, store), "event_id").parquet(paths["themes"])
    return paths


def write_report_from_exports(spark: SparkSession, exports: str, out: str, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """From a folder of CSV exports to the report in one call."""
    from rsvpark.session import materialize
    from rsvpark.sources.csv_export import load_exports
    return write_report(materialize(load_exports(spark, exports, overrides).registrations, "report-registrations"), out)
