"""Stored themes (K3) reused for events that have them (A10), and the topic
bar rows that need themes for free-text events (F3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rsvpark.operators import counts, kpis, ranking, themes
from rsvpark.session import has_jvm, materialize, no_shuffles_left, work_scope
from rsvpark.sources.fixture import land_reg, landing_version, load_reg
from rsvpark.streaming.pending import empty_marks, pending_events, store_themes, stored_themes


def theme_list(reg: DataFrame):
    """``(kpis, topic mode, theme inputs)`` of registrations."""
    k = kpis.event_kpis(reg)
    mode = kpis.topic_mode(reg, k)
    return k, mode, themes.theme_inputs(reg, mode)


def _inputs(spark, sf_dir):
    reg = load_reg(spark, sf_dir)
    return (reg, *theme_list(reg))


def themes_for(reg: DataFrame, store: str) -> DataFrame:
    """A10 + K3: themes of every event of ``reg``, computed only for pending events.

    Themes stored under ``store`` (Parquet by ``event_id``) are reused; events
    without stored themes are themed in one distributed job and their
    partitions written.  An event without genuine answers gets an empty mark,
    so it is not looked at again; a failed job stores nothing and is retried.
    """
    spark = reg.sparkSession
    pending = pending_events(reg, stored_themes(spark, store))
    # Event ids only (the partition column of both tables): when every event
    # has stored themes, the answer list is not built at all.
    if pending.limit(1).count():
        # The answers are read where they lie and never written again; only the
        # topic mode, which decides on a list, is counted once for all readings.
        # Work tables of the job are removed once the store is written.
        with work_scope(spark), no_shuffles_left(spark):
            todo = materialize(pending, "pending")
            mode = materialize(kpis.topic_mode(reg, kpis.event_kpis(reg)), "topic-mode")
            mine = themes.theme_inputs(reg, mode).join(F.broadcast(todo), "event_id", "left_semi")
            if mine.limit(1).count():
                store_themes(themes.themes(mine), store)
            store_themes(empty_marks(pending_events(todo, stored_themes(spark, store))), store)
    return stored_themes(spark, store).where("theme_id >= 0")


def themes_with_store(spark, sf_dir) -> DataFrame:
    """Themes of the test registrations, stored next to their landing.

    The store's name holds the landing's version and that of the theme
    parameters, so neither new rows nor new rules meet old themes.
    """
    if not has_jvm(spark):
        return themes.themes(materialize(_inputs(spark, sf_dir)[3], "answers"))
    return themes_for(load_reg(spark, sf_dir), landing_store(spark, sf_dir))


def landing_store(spark, sf_dir) -> str:
    landing = land_reg(spark, sf_dir)
    return f"{landing}-themes-{landing_version(spark, landing)}-{themes.version()}"


def topic_bar_rows(reg: DataFrame, k: DataFrame, mode: DataFrame, topic_themes: DataFrame | None) -> DataFrame:
    """F3 + H2: option counts for choice events; for free-text events the
    theme rows (title, count) by count descending, theme order on ties; then
    the blank row for every event."""
    choice = mode.where("topics_are_choices").select("event_id")
    rows = (counts.topic_option_counts(reg).join(choice, "event_id", "left_semi")
            .select("event_id", "label", "n", "pos"))
    if topic_themes is not None:
        free = mode.where(~F.col("topics_are_choices")).select("event_id")
        th = topic_themes.where(F.col("key") == "future_topics").join(free, "event_id", "left_semi")
        w = Window.partitionBy("event_id").orderBy(F.desc("count"), "theme_id")   # <= 6 rows per event
        rows = rows.unionByName(th.select("event_id", F.col("title").alias("label"),
                                          F.col("count").alias("n"),
                                          F.row_number().over(w).cast("bigint").alias("pos")))
    return ranking.topic_rows(rows, k)


def topic_rows_of(reg: DataFrame, k: DataFrame, mode: DataFrame, store: str) -> DataFrame:
    """Topic bar rows; stored themes are only looked up when some event's
    topics are free text (a cheap check on the per-event mode table)."""
    free = mode.where(~F.col("topics_are_choices") & (F.col("n_labels") > 0))
    th = themes_for(reg, store) if free.limit(1).count() else None
    return topic_bar_rows(reg, k, mode, th)


def topic_rows_for(spark, sf_dir, reg: DataFrame, k: DataFrame, mode: DataFrame) -> DataFrame:
    """``topic_rows_of`` with the store of the test registrations."""
    if not has_jvm(spark):
        return topic_bar_rows(reg, k, mode, themes_with_store(spark, sf_dir))
    return topic_rows_of(reg, k, mode, landing_store(spark, sf_dir))
