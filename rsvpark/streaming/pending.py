"""Which events still need themes (A10, G4), and the theme store (K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

THEME_STORE_SCHEMA = ("event_id string, key string, theme_id bigint, title string, count bigint, "
                      "quotes array<string>")


def stored_themes(spark: SparkSession, path: str) -> DataFrame:
    """The theme table stored at ``path`` (partitioned by event), or an empty one."""
    from rsvpark.session import has_jvm
    if has_jvm(spark):
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return spark.read.schema(THEME_STORE_SCHEMA).parquet(path)
        return spark.createDataFrame([], THEME_STORE_SCHEMA)
    try:
        df = spark.read.schema(THEME_STORE_SCHEMA).parquet(path)
        df.limit(0).collect()
        return df
    except Exception:  # noqa: BLE001  (no store yet)
        return spark.createDataFrame([], THEME_STORE_SCHEMA)


def pending_events(reg: DataFrame, themes: DataFrame) -> DataFrame:
    """Events of ``reg`` that have no stored themes yet."""
    done = themes.select("event_id").distinct()
    return reg.select("event_id").distinct().join(done, "event_id", "left_anti")


def store_themes(themes: DataFrame, path: str) -> None:
    """Write only successful theme rows, replacing just the events present."""
    (themes.where(F.col("title").isNotNull())
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_id").parquet(path))


def empty_marks(events: DataFrame) -> DataFrame:
    """A store row per event that has no genuine answers: themed, with nothing to show."""
    none = F.array().cast("array<string>")
    return events.select("event_id", F.lit("").alias("key"), F.lit(-1).cast("bigint").alias("theme_id"), F.lit("").alias("title"),
                         F.lit(0).cast("bigint").alias("count"), none.alias("quotes"))
