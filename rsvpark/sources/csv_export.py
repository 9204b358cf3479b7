"""Registration-form CSV exports: one file per event, header wording varies
(A1-A6, A8, B5).

Plan (whatever the number of files or layouts):

1. ``scan_files`` parses every file once.  ``multiLine`` CSV is not splittable,
   so a file is read in order inside one task and its first record is its
   header: a streaming pass gives one row per file with the header record's text
   and id and an upper bound of the cells of its widest record.  Header cells
   are cut from that text (``from_csv``), so headers need no further read.
2. ``column_map`` finds each logical key's header with a theta join of the
   header cells against the fixed hint table (broadcast: about twenty rows),
   then the least ``(hint_ord, pos)``: first hint, then first column.  An
   override wins if the file has that header; overrides that name no header of
   a file are reported and detection stands.
3. One layout row per file (header record id, width, position of each key)
   is joined to the records of a second parse, whose positional all-string
   schema has room for the widest record and one cell more.  The nine cells
   are landed as Parquet: whatever reads the registrations reads that.  A record
   with a non-empty cell past its file's header width is a long row.  Dates (in
   each order) and money are parsed there, once, for votes, checks and rows.
4. Dates are read per file.  A cell votes, with a bit for each order of day and
   month that reads it; the bits common to all cells of a file (``bit_and``) say
   which one the file means, month first if both do.  Zones are kept.
5. Cells equal to a missing-value token become null; dates and money are
   parsed strictly.  What cannot be read (long rows, dates, files whose dates
   fit no one order, money, files without an order date) fails the read, or with
   ``quarantine`` goes to a table with the reason and the cells, never to a null
   or nowhere.

A file's header width is its last non-empty header cell: the reader cannot
tell an empty trailing header cell from a missing one, so a value under an
unnamed trailing column counts as a long row.  Empty extra cells (a trailing
comma) are not long rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rsvpark import constants as K
from rsvpark.functions.text import col_, na_null, slug
from rsvpark.session import materialize
from rsvpark.sources.schema import ANSWER_KEYS, HAS_COLUMNS, REG_COLUMNS

_RAW = "_raw"


# ---------------------------------------------------------------------------
# File names -> event keys
# ---------------------------------------------------------------------------

def file_stem(name: Column | str) -> Column:
    """Path stem: drop the last ``.suffix`` unless the dot leads or ends the name."""
    n = col_(name)
    return F.when(n.rlike(r"^.+\.[^.]+$"), F.regexp_extract(n, r"^(.+)\.[^.]+$", 1)).otherwise(n)


def event_key(file_path: Column | str) -> Column:
    """Event key from a file URI: decode, take the stem, make it folder-safe."""
    decoded = F.url_decode(F.replace(col_(file_path), F.lit("+"), F.lit("%2B")))
    return slug(file_stem(F.regexp_extract(decoded, r"([^/]*)$", 1)))


def slug_collisions(files: DataFrame) -> DataFrame:
    """Event keys that more than one file claims, with two of the files."""
    return (files.groupBy("event_id")
            .agg(F.min("source_file").alias("one"), F.max("source_file").alias("other"))
            .where("one <> other"))


def check_collisions(files: DataFrame) -> None:
    """Fail, with both names, if two files of ``files(event_id, source_file)`` have one event key."""
    hit = slug_collisions(files).limit(1).collect()
    if hit:
        raise ValueError(f"two exports have the event key {hit[0].event_id!r}: {hit[0].one} and {hit[0].other}")


# ---------------------------------------------------------------------------
# Header metadata
# ---------------------------------------------------------------------------

def list_csv_files(spark: SparkSession, path: str) -> list[str]:
    """CSV files under ``path`` (a file or a folder), as plain path strings."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    st = fs.getFileStatus(p)
    if not st.isDirectory():
        return [st.getPath().toString()]
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isFile() and name.lower().endswith(".csv") and not name.startswith((".", "_")):
            out.append(s.getPath().toString())
    return sorted(out)


MAX_CELLS = 1_000_000               # cells the parser makes room for in one record; more fail the job


def _reader(spark: SparkSession, schema: T.StructType):
    return (spark.read.schema(schema).option("header", False).option("multiLine", True).option("escape", '"')
            .option("mode", "PERMISSIVE").option("enforceSchema", True).option("maxColumns", MAX_CELLS))


def cell_bound(raw: Column) -> Column:
    """No fewer than the cells of a record's text: one more than the commas outside quoted cells.

    A quote opens a cell only at its start; inside, doubled quotes are text.  With every pair of
    quotes made one mark from left to right, an opening run is marks and one quote, and the next
    single quote closes the cell.  Quotes anywhere else are text, and so are commas after them.
    """
    paired = F.replace(raw, F.lit('""'), F.lit("\ue000"))
    bare = F.regexp_replace(paired, '(^[\\r\\n]*+|,)\ue000*+"[^"]*+("|\\z)', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


_SCAN = "file_path string, header_id long, widest int, first_cell string, first_text string"


def _first_records(batches):
    """Records in file order to one row per file; a header's text is all that is held."""
    path, row = None, None
    for b in batches:
        if not b.num_rows:
            continue
        of = b.column(0).dictionary_encode().indices.to_numpy()
        cells = b.column(2).to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        for at, most in zip(starts.tolist(), np.maximum.reduceat(cells, starts).tolist()):
            name = b.column(0)[at].as_py()
            if name == path:
                row[2] = max(row[2], most)
                continue
            if row:
                yield _scan_row(row)
            path, row = name, [name, b.column(1)[at].as_py(), most, b.column(3)[at].as_py(), b.column(4)[at].as_py()]
    if row:
        yield _scan_row(row)


def _scan_row(row) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=[f.split()[0] for f in _SCAN.split(", ")])


def scan_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """One row per file with a record: ``file_path, header_id, widest, first_cell, first_text``.

    A record of more than one cell comes with its raw text (``first_text``); a record of one has only the cell.
    """
    schema = T.StructType([T.StructField("c0", T.StringType()), T.StructField(_RAW, T.StringType())])
    raw = _reader(spark, schema).option("columnNameOfCorruptRecord", _RAW).csv([_escape_glob(f) for f in files])
    # the parser only gives the raw text beside a cell that is asked for too
    return (raw.select(F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("header_id"),
                       F.coalesce(cell_bound(F.col(_RAW)), F.lit(1)).cast("int").alias("widest"), "c0", _RAW)
            .mapInArrow(_first_records, _SCAN))


def raw_records(spark: SparkSession, files: list[str], width: int) -> DataFrame:
    """Every record of every file: ``cells`` (array of ``width``), ``file_path``,
    ``rec_id`` (increasing in file order)."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    raw = _reader(spark, schema).csv([_escape_glob(f) for f in files])
    # Exploding an array of one keeps the cells one array: projections above
    # would else each build it again from ``width`` columns.
    cells = F.explode(F.array(F.array(*[F.col(f"c{i}") for i in range(width)])))
    return raw.select(F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("rec_id"), cells.alias("cells"))


def header_records(scan: DataFrame, width: int) -> DataFrame:
    """``(file_path, rec_id, cells)``: the first record of each file, cut into cells."""
    names = [f"c{i}" for i in range(width)]
    text = F.regexp_replace("first_text", r"^[\r\n]+", "")
    cut = F.from_csv(text, ", ".join(f"{n} string" for n in names), {"escape": '"', "mode": "PERMISSIVE", "maxColumns": str(MAX_CELLS)})
    cells = F.when(F.col("first_text").isNull(), F.array("first_cell")).otherwise(F.array(*[F.col("cut")[n] for n in names]))
    # exploding an array of one keeps the text cut once, not once per cell
    return scan.withColumn("cut", F.explode(F.array(cut))).select("file_path", F.col("header_id").alias("rec_id"), cells.alias("cells"))


def read_headers(first: DataFrame) -> DataFrame:
    """``headers(file_path, pos, header)``: one row per named column of each file."""
    h = first.select("file_path", F.posexplode("cells").alias("pos", "header")).where(F.col("header").isNotNull())
    # A byte-order mark at the start of a file belongs to no header.
    return h.select("file_path", F.col("pos").cast("int").alias("pos"),
                    F.when(F.col("pos") == 0, F.regexp_replace("header", "^\ufeff", ""))
                    .otherwise(F.col("header")).alias("header"))


def hints_table(spark: SparkSession) -> DataFrame:
    rows = [(k, i, h) for k, hs in K.COLUMN_HINTS.items() for i, h in enumerate(hs)]
    return spark.createDataFrame(rows, "key string, hint_ord int, hint string")


def column_map(headers: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """``column_map(file_path, key, header, pos)`` per file (A3, A4).

    Hints are fixed (about twenty rows), so the substring theta join
    broadcasts them and streams the header table.
    """
    spark = headers.sparkSession
    hints = F.broadcast(hints_table(spark))
    m = (headers.join(hints, F.lower(headers["header"]).contains(hints["hint"]))
         .groupBy("file_path", "key")
         .agg(F.min_by(F.struct("header", "pos"), F.struct("hint_ord", "pos")).alias("hit"))
         .select("file_path", "key", F.col("hit.header").alias("header"), F.col("hit.pos").alias("pos")))
    if not overrides:
        return m
    ov = F.broadcast(spark.createDataFrame(list(overrides.items()), "key string, header string"))
    ov_hit = (headers.join(ov, "header").groupBy("file_path", "key")
              .agg(F.min(F.struct("pos", "header")).alias("o"))
              .select("file_path", "key", F.col("o.header").alias("header"), F.col("o.pos").alias("pos")))
    kept = m.join(ov_hit.select("file_path", "key"), ["file_path", "key"], "left_anti")
    return kept.unionByName(ov_hit)


def wrong_overrides(headers: DataFrame, overrides: dict[str, str] | None) -> DataFrame:
    """``(file_path, key, header)``: overrides that name no header of a file."""
    spark = headers.sparkSession
    ov = spark.createDataFrame(list((overrides or {}).items()), "key string, header string")
    wanted = headers.groupBy("file_path").agg(F.collect_set("header").alias("named")).join(F.broadcast(ov))
    return wanted.where(~F.array_contains("named", F.col("header"))).select("file_path", "key", "header")


def missing_keys(headers: DataFrame, cmap: DataFrame) -> DataFrame:
    """A5: keys without a header per file, with the headers that are there."""
    found = (cmap.where(F.col("header").isNotNull())
             .groupBy("file_path").agg(F.collect_set("key").alias("found")))
    files = headers.groupBy("file_path").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "header"))), lambda x: x["header"])
        .alias("available"))
    all_keys = F.array(*[F.lit(k) for k in K.KEYS])
    missing = F.array_except(all_keys, F.coalesce(F.col("found"), F.array().cast("array<string>")))
    return (files.join(found, "file_path", "left")
            .select("file_path", missing.alias("missing"), "available")
            .where(F.size("missing") > 0))


# ---------------------------------------------------------------------------
# Reading the rows
# ---------------------------------------------------------------------------

def _escape_glob(path: str) -> str:
    """File readers expand glob characters; exports may have them in names."""
    return "".join("\\" + ch if ch in "[]{}*?\\" else ch for ch in path)


# A plain amount: digits with a point (thousands in groups of three commas), an
# optional dollar sign, and no currency but that of the report.
MONEY_RE = r"^\s*(?:AUD\s*)?\$?\s*(-?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?|-?\.\d+)\s*(?:AUD)?\s*$"
_TIME = r"( \d{1,2}:\d{2}(:\d{2})?)?$"
_CLOCK = "[ H:mm[:ss]]"
# Date forms beside the ISO one that read a text in one way only: what it must look like, and its pattern.
DATE_FORMS = [
    (r"^\d{4}/\d{1,2}/\d{1,2}" + _TIME, "yyyy/M/d" + _CLOCK),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}" + _TIME, "MMM d, yyyy" + _CLOCK),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4} \d{1,2}:\d{2} [AP]M$", "MMM d, yyyy h:mm a"),
    (r"^[A-Z][a-z]{3,} \d{1,2}, \d{4}" + _TIME, "MMMM d, yyyy" + _CLOCK),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}" + _TIME, "d MMM yyyy" + _CLOCK),
    (r"^\d{1,2} [A-Z][a-z]{3,} \d{4}" + _TIME, "d MMMM yyyy" + _CLOCK),
]
# Numbers whose order a single cell may leave open: its bit, the date pattern; the first common to a file counts.
ORDERS = [(1, "M/d/yyyy"), (2, "d/M/yyyy")]
ANY_ORDER = sum(bit for bit, _ in ORDERS)
_NUMERIC = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}"
_ISO = r"^\d{4}(-\d{1,2}(-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?)?)?$"
_ZONE = r"(?<=:\d{2}|\.\d{1,9}|[AP]M)\s*(Z|UTC|GMT|[A-Z][A-Za-z]+/[A-Za-z_]+|[+-]\d{2}(:?\d{2})?)$"


def parse_money(c: Column) -> Column:
    """Exact amount, or null for text that is not one plain amount."""
    digits = F.replace(F.regexp_extract(c, MONEY_RE, 1), F.lit(","), F.lit(""))
    return F.when(c.rlike(MONEY_RE), digits.try_cast("decimal(18,2)"))


def zone_of(c: Column) -> Column:
    """The zone written after a time of day, or null."""
    z = F.regexp_extract(F.trim(c), _ZONE, 1)
    return F.when(z != "", z)


def _clock(c: Column) -> Column:
    """A date text without its zone: the time on the writer's clock, whose day is the one counted."""
    return F.regexp_replace(F.trim(c), _ZONE, "")


def _numeric(t: Column, date: str) -> Column:
    """Timestamp of a numeric date in the given order, or null."""
    t = F.regexp_replace(t, r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})", "$1/$2/$3")
    # a number that is no month is not parsed just to fail: that costs far more than the parse
    month = t.rlike(r"^(0?[1-9]|1[0-2])/" if date.startswith("M") else r"^\d{1,2}/(0?[1-9]|1[0-2])/")
    return F.when(month, F.coalesce(F.when(t.rlike(r"^[\d/]+" + _TIME), F.try_to_timestamp(t, F.lit(date + _CLOCK))),
                      F.when(t.rlike(r"^[\d/]+ \d{1,2}:\d{2} [AP]M$"), F.try_to_timestamp(t, F.lit(date + " h:mm a"))))).cast("timestamp_ntz")


def _one_way(t: Column) -> Column:
    """Timestamp of the ISO form or of one of ``DATE_FORMS``, or null."""
    return F.coalesce(F.when(t.rlike(_ISO), t.try_cast("timestamp_ntz")),
                      *[F.when(t.rlike(look), F.try_to_timestamp(t, F.lit(form))).cast("timestamp_ntz") for look, form in DATE_FORMS])


def date_columns(c: Column) -> list[Column]:
    """What a date cell says whatever its file's order: ``date_numeric``, its ``order_zone``, ``date_ts`` if it reads
    one way, and for each order ``date_<bit>``.  A text is parsed here and nowhere else."""
    t = _clock(c)
    return [t.rlike(_NUMERIC).alias("date_numeric"), zone_of(c).alias("order_zone"), _one_way(t).alias("date_ts"),
            *[F.when(t.rlike(_NUMERIC), _numeric(t, date)).alias(f"date_{bit}") for bit, date in ORDERS]]


def file_orders(cells: DataFrame) -> DataFrame:
    """``(file_path, date_votes)``: the orders that read every numeric date of a file that any order reads; 0 where none does."""
    bits = sum((F.when(F.col(f"date_{bit}").isNotNull(), bit).otherwise(0) for bit, _ in ORDERS), F.lit(0))
    votes = cells.select("file_path", F.when(F.col("date_numeric"), bits).alias("v"))
    return votes.where("v > 0").groupBy("file_path").agg(F.bit_and("v").alias("date_votes"))


def layouts(first: DataFrame, headers: DataFrame, cmap: DataFrame) -> DataFrame:
    """One row per file: header record id, header width, position of each key."""
    width = headers.groupBy("file_path").agg((F.max("pos") + 1).alias("width"))
    pos = cmap.groupBy("file_path").agg(
        *[F.max(F.when(F.col("key") == k, F.col("pos"))).alias(f"pos_{k}") for k in K.KEYS])
    return (first.select("file_path", F.col("rec_id").alias("header_id"))
            .join(width, "file_path", "left").join(pos, "file_path", "left")
            .fillna({"width": 0}))


@dataclass
class Exports:
    """What a read of exports gives.

    ``registrations`` carry ``source_file``, ``has_<key>`` flags (an absent
    column is not the same as an all-null one: see ticket types and attending)
    and the ``order_zone`` written with a date; ``quarantine(event_id,
    source_file, row_id, reason, cells, date_votes)`` holds what could not be
    read (empty unless asked for).  Records are parsed and landed when either is
    first asked for; headers alone need no such parse.
    """

    read: Callable[[], tuple[DataFrame, DataFrame]]
    column_map: DataFrame
    missing: DataFrame
    wrong_overrides: DataFrame
    files: DataFrame

    @functools.cached_property
    def _read(self) -> tuple[DataFrame, DataFrame]:
        return self.read()

    @property
    def registrations(self) -> DataFrame:
        return self._read[0]

    @property
    def quarantine(self) -> DataFrame:
        return self._read[1]


def landed_cells(raw: DataFrame, layout: DataFrame, width: int, keep_cells: bool) -> DataFrame:
    """Data records with the cells of their file's keys."""
    # the layout is a written table of one row per file: Spark broadcasts it by its size in bytes, or shuffles
    j = raw.join(layout, "file_path").where(F.col("rec_id") > F.col("header_id"))
    cells = F.col("cells")
    past_header = F.slice(cells, F.col("width") + 1, F.greatest(F.lit(width) - F.col("width"), F.lit(0)))

    def cell(key: str) -> Column:
        return na_null(F.element_at(cells, F.col(f"pos_{key}") + 1))

    long_row = F.exists(past_header, lambda x: x.isNotNull())
    # all cells of a record are kept only where it may have to be shown
    return j.select("file_path", "rec_id", *[F.col(f"pos_{k}").isNotNull().alias(f"has_{k}") for k in K.KEYS],
                    long_row.alias("long_row"), *[cell(k).alias(f"cell_{k}") for k in K.KEYS],
                    *date_columns(cell("order_date")), parse_money(cell("total_paid")).alias("paid"),
                    F.when(long_row | F.col("pos_order_date").isNull() | F.lit(keep_cells), cells).alias("cells"))


def _judged(landed: DataFrame, orders: DataFrame) -> DataFrame:
    """Landed records with dates, money and what is wrong with them."""
    votes = F.coalesce("date_votes", F.lit(ANY_ORDER))
    order = F.element_at(F.array(*[F.lit(bit) for bit, _ in ORDERS]), F.greatest(F.array_position(
        F.array(*[votes.bitwiseAND(F.lit(bit)) > 0 for bit, _ in ORDERS]), True), F.lit(1)).cast("int"))
    date, numeric = F.col("cell_order_date"), F.col("date_numeric")
    read = F.coalesce("date_ts", *[F.when(order == bit, F.col(f"date_{bit}")) for bit, _ in ORDERS])
    return (landed.join(orders, "file_path", "left")
            .withColumn("order_ts", read)
            .withColumn("reason", F.when(F.col("long_row"), F.lit("row has more cells than the header"))
                        .when(~F.col("has_order_date"), F.lit("file has no order date column"))
                        .when(numeric & (votes == 0), F.lit("the file's dates fit no one order of day and month"))
                        .when(date.isNotNull() & F.col("order_ts").isNull(), F.lit("unreadable order date"))
                        .when(F.col("cell_total_paid").isNotNull() & F.col("paid").isNull(), F.lit("unreadable amount"))))


def records(landed: DataFrame, orders: DataFrame, on_bad: str = "fail", key=event_key) -> tuple[DataFrame, DataFrame]:
    """Data records in the registrations schema, and the quarantined ones.

    ``on_bad``: ``fail`` raises on the first unreadable record, ``quarantine``
    sets it aside with the reason.
    """
    j = _judged(landed, orders)
    bad = j.where(F.col("reason").isNotNull())
    if on_bad == "fail":
        # A filter (not a projection) so column pruning cannot drop the check.
        good = j.where(F.when(F.col("reason").isNotNull(), F.raise_error(
            F.concat(F.col("reason"), F.lit(": "), F.col("file_path")))).otherwise(F.lit(True)))
        bad = bad.where(F.lit(False))
    else:
        good = j.where(F.col("reason").isNull())
    out = good.select(
        key("file_path").alias("event_id"), F.col("rec_id").alias("row_id"), "order_ts",
        F.col("cell_attendee_status").alias("attendee_status"), F.col("cell_ticket_type").alias("ticket_type"),
        F.col("paid").alias("total_paid"),
        *[F.col(f"cell_{k}").alias(k) for k in ("role", "experience", "session_goals", "speaker_q", "future_topics")],
        F.col("file_path").alias("source_file"), *HAS_COLUMNS, "order_zone")
    held = bad.select(key("file_path").alias("event_id"), F.col("file_path").alias("source_file"),
                      F.col("rec_id").alias("row_id"), "reason", "cells", "date_votes")
    return out.select(*REG_COLUMNS, "source_file", *HAS_COLUMNS, "order_zone"), held


def load_exports(spark: SparkSession, path: str | list[str], overrides: dict[str, str] | None = None,
                 on_bad: str = "fail", key=event_key) -> Exports:
    """Read every export under ``path`` (a folder, a file, or a list of files).

    ``key`` maps a file path to its event key.  Two files with one key fail.
    """
    files = sorted(path) if isinstance(path, list) else list_csv_files(spark, path)
    if not files:
        raise FileNotFoundError(path)
    scan = materialize(scan_files(spark, files), "csv-scan")     # one row per file
    named = scan.select(key("file_path").alias("event_id"), F.col("file_path").alias("source_file"))
    check_collisions(named)
    width = int(scan.agg(F.max("widest")).first()[0] or 1) + 1
    first = header_records(scan, width)
    headers = materialize(read_headers(first), "csv-headers")
    cmap = materialize(column_map(headers, overrides), "csv-map")
    if on_bad == "fail":
        dated = cmap.where(F.col("key") == "order_date").select("file_path").distinct().count()
        if dated < len(files):
            raise ValueError("no order date column: add an override for 'order_date'")
    layout = materialize(layouts(first, headers, cmap), "csv-layouts")
    return Exports(lambda: _rows(spark, files, layout, width, on_bad, key), cmap, missing_keys(headers, cmap),
                   wrong_overrides(headers, overrides), named)


def _rows(spark: SparkSession, files: list[str], layout: DataFrame, width: int, on_bad: str, key) -> tuple[DataFrame, DataFrame]:
    raw = raw_records(spark, files, width)
    landed = materialize(landed_cells(raw, layout, width, on_bad == "quarantine"), "csv-cells")
    return records(landed, materialize(file_orders(landed), "csv-orders"), on_bad, key)


def read_exports(spark: SparkSession, path: str | list[str], overrides: dict[str, str] | None = None,
                 on_bad: str = "fail") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(registrations, column_map, missing_keys)`` of ``load_exports``."""
    e = load_exports(spark, path, overrides, on_bad)
    return e.registrations, e.column_map, e.missing


# ---------------------------------------------------------------------------
# Long form
# ---------------------------------------------------------------------------

def answers_long(reg: DataFrame, keys: list[str] = ANSWER_KEYS) -> DataFrame:
    """``answers(event_id, row_id, key, answer)``, null answers dropped."""
    return (reg.unpivot(["event_id", "row_id"], keys, "key", "answer")
            .where(F.col("answer").isNotNull()))
