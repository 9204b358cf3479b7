"""Folder-drop ingestion (A9): exports land in the registrations table, the latest version of each event's.

A run lists the drop folder (path, time and length of every export; contents
are not read) and compares it with the versions that have landed.  An export
that is new, or was written again under its old name, is read with the CSV
source and lands as ``event_id=<event>/file_version=<version>``, a folder of
its own; when its rows are complete one line in the version list makes it the
event's current version, and only then do readers see it and the folder before
it goes.  A run that stops in between leaves the old version in place, and a
second run with nothing new adds nothing.

A renamed export (its old file is gone, the new one has the same event key)
replaces its event too.  Two files in the folder with one event key fail with
both names.  A deleted export leaves its event as it landed, unless
``drop_deleted`` says that it goes.  Unreadable rows fail the run, or with
``on_bad="quarantine"`` land beside the table, by the same versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rsvpark.session import materialize, release
from rsvpark.sources.csv_export import check_collisions, event_key, load_exports
from rsvpark.sources.schema import HAS_COLUMNS, REG_COLUMNS, REGISTRATIONS

MAX_FILES = 1000

VERSIONS = "event_id string, source_file string, file_version string, run long, gone boolean"
_REGS = T.StructType(REGISTRATIONS.fields + [T.StructField("source_file", T.StringType()), *[T.StructField(c, T.BooleanType()) for c in HAS_COLUMNS],
                                             T.StructField("order_zone", T.StringType()), T.StructField("file_version", T.StringType())])
_HELD = "event_id string, source_file string, row_id long, reason string, cells array<string>, date_votes int, file_version string"


def _path(spark: SparkSession, text: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(text)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _plain_path(spark: SparkSession, uri: str) -> str:
    """The path that a file's URI names."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def dropped_files(spark: SparkSession, drop_dir: str, pattern: str = "*.csv", key=event_key) -> DataFrame:
    """``(listed, event_id, file_version)`` of every export in the drop folder; only its listing is read."""
    p, fs = _path(spark, drop_dir)
    if not fs.exists(p):
        return spark.createDataFrame([], "listed string, event_id string, file_version string")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(drop_dir)
             .select(F.col("_metadata.file_path").alias("listed"), F.col("_metadata.file_modification_time").alias("written"),
                     F.col("_metadata.file_size").alias("length")))
    version = F.sha2(F.concat_ws("|", "listed", F.unix_micros("written"), "length"), 256)
    return files.select("listed", key("listed").alias("event_id"), F.substring(version, 1, 20).alias("file_version"))


def landed_versions(spark: SparkSession, table_path: str) -> DataFrame:
    """The current ``(event_id, source_file, file_version, run)`` of every landed event."""
    where = table_path.rstrip("/") + "-versions"
    p, fs = _path(spark, where)
    if not fs.exists(p):
        return spark.createDataFrame([], VERSIONS).drop("gone")
    last = F.max_by(F.struct("source_file", "file_version", "run", "gone"), "run").alias("v")
    return (spark.read.schema(VERSIONS).parquet(where).groupBy("event_id").agg(last)
            .where("not v.gone").select("event_id", "v.source_file", "v.file_version", "v.run"))


def _write_versions(df: DataFrame, table_path: str) -> None:
    df.select("event_id", "source_file", "file_version", "run", "gone").coalesce(1).write.mode("append").parquet(table_path.rstrip("/") + "-versions")


def _write_batch(spark: SparkSession, files: list, table_path: str, run: int, overrides, on_bad: str, key) -> None:
    """Land the rows of ``files`` (listed, event_id, file_version), then make them current."""
    paths = [_plain_path(spark, f.listed) for f in files]
    e = load_exports(spark, sorted(paths), overrides, on_bad, key)
    version = spark.createDataFrame([(f.event_id, f.file_version) for f in files], "event_id string, file_version string")
    regs = e.registrations.select(*REG_COLUMNS, "source_file", *HAS_COLUMNS, "order_zone").join(version, "event_id")
    # the same version again (after a run that stopped) replaces its own folder
    (regs.hint("rebalance", "event_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_id", "file_version").parquet(table_path))
    if on_bad == "quarantine":
        (e.quarantine.join(version, "event_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_id", "file_version").parquet(table_path.rstrip("/") + "-quarantine"))
    now = (e.files.join(version, "event_id", "right").withColumn("source_file", F.coalesce("source_file", F.lit("")))
           .select("event_id", "source_file", "file_version", F.lit(run).cast("long").alias("run"), F.lit(False).alias("gone")))
    _write_versions(now, table_path)


def _remove_stale(spark: SparkSession, events: list[tuple[str, str]], table_path: str) -> None:
    """Folders of versions that are no longer current, at most one a file of the batch."""
    for event, version in events:
        for table in (table_path, table_path.rstrip("/") + "-quarantine"):
            p, fs = _path(spark, f"{table.rstrip('/')}/event_id={event}/file_version={version}")
            if fs.exists(p):
                fs.delete(p, True)


def ingest_drops(spark: SparkSession, drop_dir: str, table_path: str, overrides: dict[str, str] | None = None,
                 on_bad: str = "fail", max_files: int = MAX_FILES, drop_deleted: bool = False,
                 pattern: str = "*.csv", key=event_key) -> int:
    """Land every export that is new or changed since the last run; the number of files that were.

    At most ``max_files`` are read at a time, so what the driver holds is bounded by a batch.  Folders below
    the drop folder count too; ``pattern`` says which files are exports, ``key`` gives a path's event key.
    """
    listed = materialize(dropped_files(spark, drop_dir, pattern, key), "drops")
    check_collisions(listed.select("event_id", F.col("listed").alias("source_file")))
    before = materialize(landed_versions(spark, table_path), "drop-versions")
    run = int(before.agg(F.max("run")).first()[0] or 0) + 1
    old = before.select("event_id", F.col("file_version").alias("old_version"))
    changed = listed.join(old, "event_id", "left").where("old_version is null or old_version <> file_version")
    changed = materialize(changed.withColumn("batch", F.pmod(F.xxhash64("listed"), F.lit(1 << 20))), "drop-changed")
    n = changed.count()
    for i in range(-(-n // max_files)):
        part = changed.orderBy("batch", "listed").offset(i * max_files).limit(max_files).collect()
        _write_batch(spark, part, table_path, run, overrides, on_bad, key)
        _remove_stale(spark, [(f.event_id, f.old_version) for f in part if f.old_version], table_path)
    if drop_deleted:
        gone = before.join(listed.select("event_id"), "event_id", "left_anti")
        _write_versions(gone.withColumn("run", F.lit(run).cast("long")).withColumn("gone", F.lit(True)), table_path)
    release(listed, before, changed)
    return n


def _current(spark: SparkSession, df: DataFrame, table_path: str) -> DataFrame:
    """The rows of current versions: versions are a row per event, joined by their size."""
    return df.join(landed_versions(spark, table_path).select("event_id", "file_version"), ["event_id", "file_version"], "left_semi")


def read_registrations(spark: SparkSession, table_path: str) -> DataFrame:
    """The landed registrations (partition column kept as a string) with their ``has_<key>`` flags."""
    p, fs = _path(spark, table_path)
    rows = spark.read.schema(_REGS).parquet(table_path) if fs.exists(p) else spark.createDataFrame([], _REGS)
    return _current(spark, rows, table_path).select(*REG_COLUMNS, "source_file", *HAS_COLUMNS, "order_zone")


def read_quarantine(spark: SparkSession, table_path: str) -> DataFrame:
    """What could not be read of the current versions, with the reason."""
    where = table_path.rstrip("/") + "-quarantine"
    p, fs = _path(spark, where)
    rows = spark.read.schema(_HELD).parquet(where) if fs.exists(p) else spark.createDataFrame([], _HELD)
    return _current(spark, rows, table_path).drop("file_version")
