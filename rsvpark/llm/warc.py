"""WARC archives: a writer of gzip-member records and a splittable reader.

**Writing.**  Every page becomes one record in a gzip member of its own.  Of
pages with equal payloads the one with the smallest id is a ``response``; the
others are ``revisit`` records that refer to it.  The members are written by
Spark's text sink (so any file system Spark can reach, with its commit
protocol): a member's last byte is the high byte of its length field, zero
below 16 MiB, so rows hold the member without it and the line separator is
``\\x00``.  Longer records are followed by an empty member, which ends in zeros.

**Reading.**  Tasks scan byte ranges of the archives for the gzip magic
(``1f 8b 08``, given to Spark's splittable text source as the separator), so a
task owns the pieces that start inside its range.  The magic also occurs inside
compressed data, so a piece is only a candidate: it is a record if it
inflates to its end with the right checksum and its WARC header parses.  A
candidate that does not end is joined with the pieces after it; the few that
reach past the task's range are finished in a second step, per file, from the
pieces that no record of the next ranges claimed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpark.session import shared_path

MIN_BYTES = 0
LEVEL = 6
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = MAGIC + b"\x00" * 5 + b"\x00\x03" + b"\x03\x00" + b"\x00" * 8
FIXED_DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD = ("page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, "
          "record_id string, digest_ok boolean")
#: Archives are read as they are, in byte ranges, whatever their names say.  Hadoop takes the codec of the last suffix
#: that sorts before a name, if the name ends in it; a suffix that sorts right after ``.gz`` and fits no archive's name leaves
#: ``x.gz`` without a codec.  The key stands twice: as Hadoop has it, and as Spark's own build of Hadoop does.
AS_IT_IS = {"io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec"} | {
    f"{prefix}io.compress.passthrough.extension": "!.gz" for prefix in ("", "org.apache.hadoop.shaded.")}
_UNPACKED = r"([\x00-!]|%[01][0-9A-F]|%2[01])\.(?i:gz)$"        # the names that the suffix does not shield


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(text: str | None) -> str:
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def _id(page_id) -> str:
    return "" if page_id is None else f"<urn:page:{page_id}>"


def record_bytes(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    block = HTTP + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}",
            f"WARC-Date: {FIXED_DATE}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
            f"X-Payload-Length: {len(payload)}"]
    if url is None:
        head.append("X-No-URI: true")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_id(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = LEVEL) -> bytes:
    """``record`` as a gzip member that ends in a zero byte."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = z.compress(record) + z.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def _write_batches(level: int):
    def run(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "first_id", "revisit")))
            out = []
            size = 0
            for page_id, url, payload, first, revisit in rows:
                out.append(member(record_bytes(page_id, url, payload or b"", first, revisit), level)[:-1])
                size += len(out[-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
    return run


def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(page_id, url, payload, first_id, revisit)``: which record each page becomes.

    Equal payloads are found by SHA-256 and length; only digests are grouped, so
    a payload that a third of the pages share is one partial aggregate.  A null
    id never becomes the response of others; rows that repeat the smallest id
    are responses too.
    """
    p = (pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
         .withColumn("n", F.octet_length("payload")))
    key = F.concat(F.sha2("payload", 256), F.lit(":"), F.col("n"))
    p = p.withColumn("key", F.when(F.col("n") >= min_bytes, key))
    firsts = (p.where("key is not null and page_id is not null").groupBy("key")
              .agg(F.min("page_id").alias("first_id"))
)
    j = p.join(firsts, "key", "left")
    revisit = F.coalesce(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    return j.select("page_id", "url", "payload", "first_id", revisit.alias("revisit"))


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, level: int = LEVEL) -> str:
    """Write one record per row of ``pages(page_id, url, html)`` under ``path``; null html is an empty payload."""
    (plan_records(pages, min_bytes)
     .mapInArrow(_write_batches(level), "member binary")
     .select(F.col("member").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", "\x00").text(path))
    return path


class _Inflate:
    """One candidate member: fed pieces until it ends, fails, or needs more."""

    def __init__(self):
        self.z = zlib.decompressobj(31)
        self.out = []
        self.pieces = 0

    def feed(self, data: bytes) -> str:
        self.pieces += 1
        try:
            self.out.append(self.z.decompress(data))
        except zlib.error:
            return "bad"
        return "end" if self.z.eof else "more"

    def record(self):
        return parse_record(b"".join(self.out))


def parse_record(raw: bytes):
    """A WARC record as the tuple of ``RECORD``, or None if the bytes are no record."""
    if not raw.startswith(b"WARC/1."):
        return None
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep:
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, colon, v = line.partition(":")
        if not colon:
            return None
        fields[k.strip().lower()] = v.strip()
    try:
        n = int(fields["content-length"])
        kind = fields["warc-type"]
    except (KeyError, ValueError):
        return None
    if len(rest) < n:
        return None
    block = rest[:n]
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    url = None if "x-no-uri" in fields else fields.get("warc-target-uri", "")
    name, stated = fields.get("warc-record-id", ""), fields.get("warc-payload-digest", "")
    if kind == "revisit":
        return (_page(name), url, kind, None, _whole(fields.get("x-payload-length")), stated.removeprefix("sha1:") or None,
                _page(fields.get("warc-refers-to", "")), name or None, None)
    own = digest(payload)
    # another algorithm's digest is not compared
    ok = stated.removeprefix("sha1:").upper() == own if stated.startswith("sha1:") else None
    return (_page(name), url, kind, payload, len(payload), own, None, name or None, ok)


def _whole(v: str | None) -> int | None:
    return int(v) if v and v.isdecimal() else None


def _page(v: str) -> int | None:
    """The page id in an id that ``write`` gave; None for ids of others."""
    found = _PAGE.fullmatch(v)
    return int(found[1]) if found else None


_PAGE = re.compile(r"<urn:page:(-?\d+)>")
_N = len(RECORD.split(", "))
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
                   ("digest_ok", pa.bool_()), ("file", pa.string()), ("at", pa.int64()), ("seq", pa.int64()), ("piece", pa.binary())])


def _decode(pieces):
    """Records of consecutive pieces, and the pieces that belong to none: yields ("record", tuple) and ("loose", seq, piece).

    A piece that cannot begin a record (its member does not inflate to a WARC
    header) belongs to a record of the range before, or is the empty member
    after a long record.
    """
    held: list[tuple[int, bytes]] = []
    job = None
    queue: list[tuple[int, bytes]] = []
    for item in pieces:
        queue.append(item)
        while queue:
            seq, piece = queue.pop(0)
            if job is None:
                job = _Inflate()
                held = []
                data = MAGIC + piece
            else:
                data = MAGIC + piece
            held.append((seq, piece))
            state = job.feed(data)
            if state == "end":
                got = job.record()
                if got is not None:
                    yield ("record", got)
                elif b"".join(job.out):
                    for h in held:
                        yield ("loose", *h)
                job = None
            elif state == "bad":
                yield ("loose", *held[0])
                queue[:0] = held[1:]
                job = None
    while job is not None:
        # the member goes on past this range, or it was no member at all
        head = b"".join(job.out)[:7]
        if head == b"WARC/1."[: len(head)] and head:
            for h in held:
                yield ("loose", *h)
            job = None
            break
        yield ("loose", *held[0])
        rest = held[1:]
        job = None
        if rest:
            yield from _decode(iter(rest))


def _read_batches(batches):
    """Pieces of one task, range by range, to records and loose pieces."""
    cols: list[list] = [[] for _ in _READ]
    size = 0

    def flush():
        nonlocal cols, size
        b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _READ)], schema=_READ)
        cols, size = [[] for _ in _READ], 0
        return b

    def put(key, item):
        nonlocal size
        if item[0] == "record":
            row = (*item[1], None, None, None, None)
            size += len(item[1][3] or b"")
        else:
            row = (None,) * _N + (key[0], key[1], item[1], item[2])
            size += len(item[2])
        for c, v in zip(cols, row):
            c.append(v)

    def rows():
        for b in batches:
            yield from zip(b.column("file").to_pylist(), b.column("at").to_pylist(), b.column("piece").to_pylist())

    import itertools
    for key, run in itertools.groupby(rows(), key=lambda r: (r[0], r[1])):
        # what stands before a file's first magic is empty: not a piece
        numbered = ((i, r[2]) for i, r in enumerate(run) if not (i == 0 and key[1] == 0))
        for item in _decode(numbered):
            put(key, item)
            if size > 8 << 20:
                yield flush()
    if cols[0]:
        yield flush()


def _stitch(key, batches):
    """Loose pieces of one file, in file order, to the records that cross ranges."""
    rows = []
    for b in batches:
        rows += zip(b.column("at").to_pylist(), b.column("seq").to_pylist(), b.column("piece").to_pylist())
    rows.sort(key=lambda r: (r[0], r[1]))
    out = [item[1] for item in _decode(iter([(i, r[2]) for i, r in enumerate(rows)])) if item[0] == "record"]
    schema = pa.schema([_READ.field(i) for i in range(_N)])
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], schema.field(i).type) for i in range(_N)], schema=schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path`` as ``RECORD`` columns, one row each, in no order.

    ``digest_ok`` says whether a payload has its stated SHA-1 (null where none, or
    another algorithm's, is stated); a revisit has a null payload and states the
    digest of the payload it stands for (and its length, in archives of ``write``).
    Records of any kind and writer are read: a payload is what follows the HTTP
    header of an HTTP record, the whole block of others.  ``page_id`` and
    ``refers_to`` are those that ``write`` gave, null for ids of others, which
    ``record_id`` has.  Files named ``.gz`` give the same records, by byte ranges
    like others; a name with a blank or ``!`` before ``.gz`` fails, as it would be
    unpacked on the way.
    """
    raw = (spark.read.options(**AS_IT_IS).option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
           .where(F.when(F.col("_metadata.file_name").rlike(_UNPACKED), F.raise_error(F.concat(F.lit("rename this archive: "), "_metadata.file_path")))
                  .otherwise(F.lit(True)))
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                   F.col("value").cast("binary").alias("piece")))
    from rsvpark.session import materialize
    both = materialize(raw.mapInArrow(_read_batches, RECORD + ", file string, at long, seq long, piece binary"), "warc-read")
    names = [f.split()[0] for f in RECORD.split(", ")]
    whole = both.where("piece is null").select(*names)
    crossing = (both.where("piece is not null").select("file", "at", "seq", "piece")
                .groupBy("file").applyInArrow(_stitch, RECORD))
    return whole.unionByName(crossing)


def round_trip(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write ``pages`` as archives under ``path`` (default: the shared folder) and read them back.

    Nulls: html reads as an empty payload, url stays null, a null page_id is
    written without an id.  Repeated rows are records of their own; an empty
    table gives archives without records.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "rsvpark-work", f"warc-{uuid.uuid4().hex}")
    write(pages, path, min_bytes)
    return read(spark, path)
