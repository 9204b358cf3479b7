"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Duplicate day labels in a context map keep the last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "rsvpark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(k, conf[k])
    checkpoint_dir(spark)
    return spark


def has_jvm(spark: SparkSession) -> bool:
    """True for a classic session (driver JVM reachable), False for Spark Connect."""
    try:
        return spark._jvm is not None
    except Exception:  # noqa: BLE001  (Connect sessions have no JVM handle)
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the master is this
    process (local tests) is a fresh scratch folder created and registered.
    """
    if not has_jvm(spark):
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return d
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/").rsplit("/", 1)[0] if _is_generated(d) else d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            # a folder of this machine would be another folder on every executor
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="rsvpark-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001  (static in some deployments; the context setting below suffices)
            pass
    sc.setCheckpointDir(d)
    return d


def _is_generated(path: str) -> bool:
    # SparkContext.setCheckpointDir appends a random UUID folder.
    last = path.rstrip("/").rsplit("/", 1)[-1]
    return len(last) == 36 and last.count("-") == 4


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local tmp)."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


ARROW_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of about ``ARROW_BYTES`` between executors and Python workers.

    Spark's bounds are 10,000 rows and 64 MB: a batch is then held once by the
    JVM, outside its heap, and once by the worker, per running task.  A batch
    still has one row at least; a session that asks for less keeps its own.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(key, "64m").strip().lower())
    if not now or int(now[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[now[2]] > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def env_cpus(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))


def materialize(df, tag: str = "work"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back (one computation, survives executor loss)."""
    import uuid
    spark = df.sparkSession
    path = shared_path(spark, "rsvpark-work", f"{tag}-{uuid.uuid4().hex}")
    _note(path=path)
    _keep(spark, path)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._rsvpark_work = path
    return out


#: Work tables of this driver that nobody has released yet; they go when the driver ends.
_KEPT: dict[str, SparkSession] = {}


def _keep(spark: SparkSession, path: str) -> None:
    if not _KEPT:
        atexit.register(_drop_kept)
    _KEPT[path] = spark


def _drop_kept() -> None:
    for path, spark in list(_KEPT.items()):
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    _KEPT.pop(path, None)
    try:
        if has_jvm(spark):
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  (best effort: a leftover folder is harmless)
        pass


def release(*tables) -> None:
    """Remove tables that ``materialize`` or ``bucketed`` wrote, as soon as nothing reads them any more.

    Only the frames it returned count; anything else (None too) is left alone.
    """
    for df in tables:
        path = getattr(df, "_rsvpark_work", None)
        if path and path in _KEPT:
            if getattr(df, "_rsvpark_table", None):
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._rsvpark_table}")
            _remove(df.sparkSession, path)


def bucketed(df, keys: list[str], tag: str = "work", buckets: int | None = None, prepartitioned: bool = False):
    """Write ``df`` as a bucketed table under the shared checkpoint folder.

    Reads of the table know the hash layout on ``keys``, so later joins and
    aggregations on those keys (or a superset of them) need no shuffle.
    """
    import uuid
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"rsvpark_{tag}_{uuid.uuid4().hex[:12]}"
    path = shared_path(spark, "rsvpark-work", name)
    # ``prepartitioned``: the caller already hash-partitioned ``df`` on ``keys``
    # into ``spark.sql.shuffle.partitions`` parts (one bucket file per task).
    src = df if prepartitioned else df.repartition(n, *keys)
    _note(path=path, table=name)
    _keep(spark, path)
    src.write.bucketBy(n, *keys).mode("overwrite").option("path", path).saveAsTable(name)
    out = spark.table(name)
    out._rsvpark_work, out._rsvpark_table = path, name
    return out


# Work tables written inside ``work_scope`` blocks (innermost last), per
# driver thread: a scope never records or removes another thread's tables.
_LOCAL = threading.local()


def _scopes() -> list[list[tuple[str, str | None]]]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def _note(path: str, table: str | None = None) -> None:
    if _scopes():
        _scopes()[-1].append((path, table))


@contextmanager
def work_scope(spark: SparkSession):
    """Remove the work tables written inside the block when it ends.

    For jobs whose result is itself written elsewhere (the theme store): the
    intermediate tables (points, centroids, labels ...) would otherwise stay
    in the shared folder after every run.  Nothing read lazily after the
    block may come from a table written inside it.
    """
    created: list[tuple[str, str | None]] = []
    _scopes().append(created)
    try:
        yield
    finally:
        _scopes().remove(created)
        for path, table in reversed(created):
            try:
                if table:
                    spark.sql(f"DROP TABLE IF EXISTS {table}")
                _remove(spark, path)
            except Exception:  # noqa: BLE001  (best effort: a leftover folder is harmless)
                pass


@contextmanager
def no_shuffles_left(spark: SparkSession):
    """Shuffle files go with the query that wrote them, not when the driver happens to collect its garbage.

    For jobs of many written rounds, whose tables are what later rounds read.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)
