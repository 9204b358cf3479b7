"""Driver queries of the CSV source: exports written from the registrations view, read back.

``write_exports`` writes one CSV per event (order status and month) under the
shared folder: header wording, column order and extra columns vary with the
month, some cells hold missing-value tokens or quotes that open no cell, dates
are ISO, day first or with a zone, and one month's exports have no status and
ticket columns.  The queries read those files with the CSV source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.plans import oracle as O
from rsvpark.plans.registry import register
from rsvpark.sources.csv_export import load_exports
from rsvpark.sources.fixture import land_reg, landing_version, load_reg, path_exists

# Header wording by layout (month mod 3); every wording is found by a hint.
HEADERS = {
    "order_date": ["Order Date", "ORDER DATE (UTC)", "Order date"],
    "attendee_status": ["Attendee Status", "Current attendee status", "attendee status"],
    "ticket_type": ["Ticket Type", "Your ticket type", "ticket type"],
    "total_paid": ["Total Paid", "total paid", "Total paid (AUD)"],
    "role": ["Which role best describes you?", "Which industry are you in?", "This best describes me"],
    "experience": ["AI experience", "How would you describe your level?", "Experience"],
    "session_goals": ["What would you most like to get?", "What to get from this session", "最希望从本次活动"],
    "speaker_q": ["Question for the panel", "What would you love to ask?", "Ask the guest"],
    "future_topics": ["Which topic next?", "Future ideas", "What should we explore?"],
}
LAYOUTS = [
    ["note", "order_date", "attendee_status", "ticket_type", "total_paid", "role", "experience", "session_goals", "speaker_q", "future_topics"],
    ["speaker_q", "role", "order_date", "total_paid", "ticket_type", "attendee_status", "note", "future_topics", "experience", "session_goals"],
    ["future_topics", "experience", "note", "note2", "order_date", "role", "session_goals", "speaker_q", "ticket_type", "total_paid", "attendee_status"],
]
DATES = ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]     # by layout
ZONE = "+10:00"                 # written after the dates of the third layout
LACKING_MONTH = 7               # its exports have no status and ticket columns
LACKING = ("attendee_status", "ticket_type")
TOKEN_KEYS = ("role", "experience", "future_topics")


def _tokens(n: int) -> list[str]:
    return [K.NA_TOKENS[(i * 5 + 1) % len(K.NA_TOKENS)] for i in range(n)]


def _with_tokens(c: Column, at: int) -> Column:
    """The cell, or for every 11th row (shifted per key) a missing-value token."""
    toks = F.array(*[F.lit(t) for t in _tokens(7)])
    return F.when(F.col("row_id") % 11 == at, F.element_at(toks, (F.col("row_id") % 7 + 1).cast("int"))).otherwise(c)


def _event(reg: DataFrame) -> DataFrame:
    return (reg.withColumn("month", F.month("order_ts")).withColumn("event", F.concat("event_id", F.lit("-"), F.date_format("order_ts", "yyyy-MM"))))


def write_exports(reg: DataFrame, path: str) -> str:
    """One CSV per event under ``path/event=<event>/``; a file is written by one task, in row order."""
    e = _event(reg)
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    cell = {k: F.col(k) for k in K.KEYS if k != "order_date"}
    dates = [F.date_format("order_ts", form) for form in DATES]
    cell["order_date"] = F.when(F.col("month") % 3 == 0, dates[0]).when(F.col("month") % 3 == 1, dates[1]).otherwise(F.concat(dates[2], F.lit(ZONE)))
    cell["total_paid"] = F.col("total_paid").cast("string")
    for at, k in enumerate(TOKEN_KEYS):
        cell[k] = _with_tokens(cell[k], at)
    cell["note"], cell["note2"] = F.concat(F.lit("row, "), F.col("row_id")), F.lit(None).cast("string")
    lines, heads = F.lit(None), F.lit(None)
    for i, keys in enumerate(LAYOUTS):
        for lacking in (False, True):
            use = [k for k in keys if not (lacking and k in LACKING)]
            here = (F.col("month") % 3 == i) & ((F.col("month") == LACKING_MONTH) == F.lit(lacking))
            # a quote inside a cell that none opens is text, and hides no comma after it
            bare = F.concat(F.lit('5" by 6" no '), F.col("row_id"))
            line = F.concat_ws(",", *[bare if k == "note" and i == 1 else F.when(cell[k].isNull(), F.lit("")).otherwise(quote(cell[k])) for k in use])
            head = ",".join(f'"{HEADERS[k][i]}"' if k in HEADERS else k for k in use)
            lines, heads = F.when(here, line).otherwise(lines), F.when(here, F.lit(head)).otherwise(heads)
    body = e.select("event", F.col("row_id").alias("ord"), lines.alias("value"))
    top = e.groupBy("event", "month").agg(F.lit(-1).cast("long").alias("ord")).select("event", "ord", heads.alias("value"))
    (body.unionByName(top).repartition("event").sortWithinPartitions("event", "ord").select("event", "value")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event").text(path))
    return path


def event_of_folder(path: Column | str) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"event=([^/]*)/", 1)


def _files(spark, path: str) -> list[str]:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    it, out = fs.listFiles(p, True), []
    while it.hasNext():
        f = it.next().getPath()
        if not f.getName().startswith((".", "_")):
            out.append(f.toString())
    return sorted(out)


def _exports(spark, sf_dir, overrides: dict[str, str] | None = None):
    """The exports of a landing, written once and read back."""
    landing = land_reg(spark, sf_dir)
    path = f"{landing}-exports-2-{landing_version(spark, landing)}"
    if not path_exists(spark, path + "/_SUCCESS"):
        write_exports(load_reg(spark, sf_dir), path)
    return load_exports(spark, _files(spark, path), overrides, key=event_of_folder)


# ---------------------------------------------------------------------------
# SQL checks
# ---------------------------------------------------------------------------

_NA = ", ".join(O.lit(t) for t in K.NA_TOKENS)
_TOKS = "[" + ", ".join(O.lit(t) for t in _tokens(7)) + "]"


def _cell_sql(k: str) -> str:
    c = k
    if k in TOKEN_KEYS:
        c = f"CASE WHEN row_id % 11 = {TOKEN_KEYS.index(k)} THEN {_TOKS}[(row_id % 7 + 1)::INT] ELSE {k} END"
    c = f"CASE WHEN ({c}) IN ({_NA}) THEN NULL ELSE ({c}) END"
    return f"CASE WHEN month(order_ts) = {LACKING_MONTH} THEN NULL ELSE {c} END" if k in LACKING else c


_EV = "event_id || '-' || strftime(order_ts, '%Y-%m')"
# The order of day and month is the file's: without a day past the 12th, a day-first file reads as month first.
_READ_TS = f"""CASE WHEN month(order_ts) % 3 = 1 AND max(day(order_ts)) OVER (PARTITION BY {_EV}) <= 12
  THEN make_timestamp(year(order_ts), day(order_ts), month(order_ts), hour(order_ts), minute(order_ts), second(order_ts)::DOUBLE)
  ELSE order_ts END"""
_TEXT_KEYS = ["attendee_status", "ticket_type", "role", "experience", "session_goals", "speaker_q", "future_topics"]


@register("csv_round_trip", O.with_reg() + f"""
SELECT {_EV} AS event_id, {_READ_TS} AS order_ts, CASE WHEN month(order_ts) % 3 = 2 THEN '{ZONE}' END AS order_zone,
  CAST(total_paid AS DECIMAL(18,2)) AS total_paid,
  {", ".join(f"{_cell_sql(k)} AS {k}" for k in _TEXT_KEYS)},
  month(order_ts) <> {LACKING_MONTH} AS has_attendee_status, month(order_ts) <> {LACKING_MONTH} AS has_ticket_type,
  true AS has_role
FROM reg""")
def q_csv_round_trip(spark, sf_dir):
    """Every registration, back from its event's export."""
    return _exports(spark, sf_dir).registrations.select(
        "event_id", "order_ts", "order_zone", "total_paid", *_TEXT_KEYS, "has_attendee_status", "has_ticket_type", "has_role")


def _header_rows_sql() -> str:
    rows = []
    for i, keys in enumerate(LAYOUTS):
        for lacking in (0, 1):
            use = [k for k in keys if not (lacking and k in LACKING)]
            rows += [f"({i}, {bool(lacking)}, {pos}, {O.lit(HEADERS[k][i] if k in HEADERS else k)})" for pos, k in enumerate(use)]
    return ", ".join(rows)


_HINT_ROWS = ", ".join(f"({O.lit(k)}, {i}, {O.lit(h)})" for k, hs in K.COLUMN_HINTS.items() for i, h in enumerate(hs))
# The wording rule in SQL: of all (hint, column) matches of a key the first hint's first column.
_MAP_CTES = [
    f"ev AS (SELECT DISTINCT {_EV} AS event_id, month(order_ts) AS m FROM reg)",
    f"hd(layout, lacking, pos, header) AS (VALUES {_header_rows_sql()})",
    f"hint(key, ord, hint) AS (VALUES {_HINT_ROWS})",
    f"eh AS (SELECT ev.event_id, hd.pos, hd.header FROM ev JOIN hd ON hd.layout = ev.m % 3 AND hd.lacking = (ev.m = {LACKING_MONTH}))",
    """mp AS (SELECT event_id, key, header, pos, row_number() OVER (PARTITION BY event_id, key ORDER BY ord, pos) AS rn
            FROM eh JOIN hint ON contains(lower(eh.header), hint.hint))""",
]


@register("header_map", O.with_reg(*_MAP_CTES) + "SELECT event_id, key, header, CAST(pos AS INTEGER) AS pos FROM mp WHERE rn = 1")
def q_header_map(spark, sf_dir):
    """A3 G1: the column of each logical key, per event."""
    m = _exports(spark, sf_dir).column_map
    return m.select(event_of_folder("file_path").alias("event_id"), "key", "header", F.col("pos").cast("int").alias("pos"))


@register("missing_keys", O.with_reg(
    *_MAP_CTES, f"keys(ord, key) AS (VALUES {', '.join(f'({i}, {O.lit(k)})' for i, k in enumerate(K.KEYS))})") + """
SELECT ev.event_id, string_agg(keys.key, ',' ORDER BY keys.ord) AS missing,
       (SELECT string_agg(header, '|' ORDER BY pos) FROM eh WHERE eh.event_id = ev.event_id) AS available
FROM ev CROSS JOIN keys LEFT JOIN mp ON mp.event_id = ev.event_id AND mp.key = keys.key
WHERE mp.key IS NULL GROUP BY ev.event_id""")
def q_missing_keys(spark, sf_dir):
    """A5: keys that an export has no column for, and the headers it has."""
    m = _exports(spark, sf_dir).missing
    return m.select(event_of_folder("file_path").alias("event_id"), F.array_join("missing", ",").alias("missing"),
                    F.array_join("available", "|").alias("available"))


# A4: the first names a header of every export, the second only of some layouts, the third of none.
OVERRIDES = {"role": "note", "experience": "Future ideas", "speaker_q": "No such header"}
_OV_ROWS = ", ".join(f"({O.lit(k)}, {O.lit(h)})" for k, h in OVERRIDES.items())


@register("override_map", O.with_reg(
    *_MAP_CTES, f"ov(key, header) AS (VALUES {_OV_ROWS})",
    "oh AS (SELECT eh.event_id, ov.key, eh.header, min(eh.pos) AS pos FROM eh JOIN ov USING (header) GROUP BY ALL)") + """
SELECT event_id, key, header, CAST(pos AS INTEGER) AS pos, 'override' AS source FROM oh
UNION ALL
SELECT mp.event_id, mp.key, mp.header, CAST(mp.pos AS INTEGER), 'hint' FROM mp
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM oh WHERE oh.event_id = mp.event_id AND oh.key = mp.key)
UNION ALL
SELECT ev.event_id, ov.key, ov.header, NULL, 'no such header' FROM ev CROSS JOIN ov
WHERE NOT EXISTS (SELECT 1 FROM eh WHERE eh.event_id = ev.event_id AND eh.header = ov.header)""")
def q_override_map(spark, sf_dir):
    """A4: the column of each key where overrides win if the file has their header; wrong ones are reported."""
    e = _exports(spark, sf_dir, OVERRIDES)
    rows = F.broadcast(spark.createDataFrame(list(OVERRIDES.items()), "key string, override string"))
    m = e.column_map.join(rows, "key", "left").select(
        event_of_folder("file_path").alias("event_id"), "key", "header", F.col("pos").cast("int").alias("pos"),
        F.when(F.col("header") == F.col("override"), F.lit("override")).otherwise(F.lit("hint")).alias("source"))
    wrong = e.wrong_overrides.select(event_of_folder("file_path").alias("event_id"), "key", "header", F.lit(None).cast("int").alias("pos"),
                                     F.lit("no such header").alias("source"))
    return m.unionByName(wrong)


@register("drop_replaced", O.with_reg() + f"""
SELECT {_EV} AS event_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(total_paid) AS DECIMAL(28,2)) AS total_paid
FROM reg WHERE month(order_ts) % 2 = 0 OR row_id % 2 = 0 GROUP BY 1""")
def q_drop_replaced(spark, sf_dir):
    """Exports of every other row land; those of even months are written again whole and replace their events."""
    import uuid

    from rsvpark.session import _keep, shared_path
    from rsvpark.streaming.ingest import ingest_drops, read_registrations
    where = shared_path(spark, "rsvpark-work", f"drops-{uuid.uuid4().hex}")
    _keep(spark, where)
    drop, table = f"{where}/drop", f"{where}/table"
    reg, read = load_reg(spark, sf_dir), {"pattern": "*.txt", "key": event_of_folder}
    for version in (reg.where("row_id % 2 = 0"), reg.where("month(order_ts) % 2 = 0")):
        write_exports(version, drop)
        ingest_drops(spark, drop, table, **read)
    return (read_registrations(spark, table).groupBy("event_id")
            .agg(F.count("*").alias("n"), F.sum("total_paid").cast("decimal(28,2)").alias("total_paid")))
