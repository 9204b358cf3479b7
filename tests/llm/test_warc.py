"""WARC archives: exact round trip, at any split size."""

import base64
import hashlib
import os
import random
import zlib

import pytest

from rsvpark.llm import warc
from rsvpark.llm.queries import QUERIES, table
from tests.conftest import SF_SMALL

SCHEMA = "page_id long, url string, html string, payload string"


def sha(b: bytes) -> str:
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def expected(pages):
    first = {}
    for i, html in pages:
        b = (html or "").encode()
        if i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, html in pages:
        b = (html or "").encode()
        rev = b in first and first[b] != i
        out.append((i, len(b), sha(b), "revisit" if rev else "response", first[b] if rev else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def random_pages(n, seed):
    rng = random.Random(seed)
    text = lambda k: "".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(0x400, 0x4FF)))) for _ in range(k))
    pages = [(i, text(rng.randrange(0, 6000))) for i in range(n)]
    pages += [(n + i, pages[rng.randrange(n)][1]) for i in range(n // 3)]
    return pages


@pytest.mark.parametrize("split", ["4k", "64k", "128m"])
def test_round_trip_at_any_split_size(spark, workdir, split):
    pages = random_pages(150, 1)
    df = spark.createDataFrame([(i, f"http://x/{i}", h) for i, h in pages], "page_id long, url string, html string").repartition(3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        back = warc.round_trip(df, f"{workdir}/{split}")
        assert got(back) == expected(pages)
        payload = {r.page_id: r.payload for r in back.where("record_type = 'response'").collect()}
        assert all(bytes(payload[i]) == (h or "").encode() for i, h in pages if i in payload)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_nulls_empty_repeats_and_extra_columns(spark, workdir):
    rows = [(1, "u", "a", "x"), (2, None, None, "x"), (3, "u\r\nv", "", None), (None, "n", "a", "x"), (None, "n", "only", "x"),
            (1, "u", "a", "x"), (7, "é", "a", None), (5, "u", "\x1f\x00 é 漢", "y")]
    back = warc.round_trip(spark.createDataFrame(rows, SCHEMA), f"{workdir}/a")
    assert got(back) == expected([(r[0], r[2]) for r in rows])
    urls = {(r.page_id, r.url) for r in back.collect()}
    assert (2, None) in urls and (3, "u%0D%0Av") in urls and (7, "é") in urls


def test_empty_table(spark, workdir):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string"), f"{workdir}/e").count() == 0


def test_members_are_plain_gzip_and_end_in_zero():
    for n in (0, 10, 70_000, (1 << 24) + 5):
        rec = warc.record_bytes(1, "u", b"z" * n, None, False)
        m = warc.member(rec)
        assert m[-1] == 0
        d = zlib.decompressobj(31)
        assert d.decompress(m) == rec and d.eof
        assert d.unused_data in (b"", warc.EMPTY_MEMBER)


def test_record_longer_than_16_mib(spark, workdir):
    rng = random.Random(3)
    big = "".join(rng.choice("abcdefgh ") for _ in range(1 << 16)) * 270
    pages = [(1, "small"), (2, big), (3, "after")]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string").coalesce(1)
    assert got(warc.round_trip(df, f"{workdir}/big")) == expected(pages)


def test_false_magic_inside_a_member():
    """Pieces cut at a magic inside a member are joined again; leading strays stay loose."""
    rec = [warc.record_bytes(i, "u", bytes([i]) * 50, None, False) for i in range(3)]
    # stored (level 0) members keep a magic of the payload as it is
    rec[1] = warc.record_bytes(1, "u", b"xx" + warc.MAGIC + b"yy" + warc.MAGIC + b"zz", None, False)
    stream = b"".join(warc.member(r, 0) for r in rec)
    pieces = stream.split(warc.MAGIC)[1:]
    items = list(warc._decode((i, p) for i, p in enumerate(pieces)))
    assert [x[1][0] for x in items if x[0] == "record"] == [0, 1, 2]
    # a range that begins inside the second member
    k = next(i for i, p in enumerate(pieces) if p.startswith(b"yy"))
    items = list(warc._decode((i, p) for i, p in enumerate(pieces[k:])))
    assert [x[1][0] for x in items if x[0] == "record"] == [2]
    assert [x[2] for x in items if x[0] == "loose"] == pieces[k:k + 2]
    # and one that ends there
    items = list(warc._decode((i, p) for i, p in enumerate(pieces[:k])))
    assert [x[1][0] for x in items if x[0] == "record"] == [0]
    assert [x[2] for x in items if x[0] == "loose"] == pieces[k - 1:k]


def test_query_matches_brute_force(spark):
    pages = [(r.page_id, r.html) for r in table(spark, SF_SMALL, "pages").collect()]
    assert got(QUERIES["op5_warc"](spark, SF_SMALL)) == expected(pages)


def _archive(records):
    return b"".join(warc.member(r, 6) for r in records)


def _foreign(kind, body, **more):
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:00000000-0000-0000-0000-00000000000a>", "WARC-Date": "2024-01-01T00:00:00Z", **more,
            "Content-Length": str(len(body))}
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items())).encode() + b"\r\n" + body + b"\r\n\r\n"


@pytest.mark.parametrize("name", ["x.warc.gz", "x.gz", "X.GZ", "plain", "x.warc"])
def test_the_name_of_an_archive_does_not_matter(spark, workdir, name):
    """The same bytes, in ranges of 4 kB, with magics inside members."""
    rng = random.Random(8)
    pages = [(i, "".join(rng.choice("abc \x1f") for _ in range(rng.randrange(3000)))) for i in range(60)]
    with open(f"{workdir}/{name}", "wb") as f:
        f.write(_archive([warc.record_bytes(i, "u", h.encode(), None, False) for i, h in pages]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = warc.read(spark, f"{workdir}/{name}").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.page_id, r.payload.decode()) for r in rows) == sorted(pages) and all(r.digest_ok for r in rows)
    for other in ("x !.gz", "x .gz"):
        os.rename(f"{workdir}/{name}", f"{workdir}/{other}")
        name = other
        with pytest.raises(Exception, match="rename this archive"):
            warc.read(spark, f"{workdir}/{other}").collect()


def test_foreign_records_are_rows_with_a_flag(spark, workdir):
    http = "application/http;msgtype=response"
    good = warc.digest(b"hello")
    records = [
        _foreign("warcinfo", b"software: x\r\n", **{"Content-Type": "application/warc-fields"}),
        _foreign("response", warc.HTTP + b"hello", **{"Content-Type": http, "WARC-Payload-Digest": f"sha1:{good.lower()}"}),
        _foreign("response", warc.HTTP + b"hello", **{"Content-Type": http, "WARC-Payload-Digest": "sha1:" + "A" * 32}),
        _foreign("response", warc.HTTP + b"hello", **{"Content-Type": http, "WARC-Payload-Digest": "sha256:abcd"}),
        _foreign("request", b"GET / HTTP/1.1\r\n\r\n", **{"Content-Type": "application/http;msgtype=request"}),
        _foreign("resource", b"a\r\n\r\nb", **{"Content-Type": "text/plain"}),
        _foreign("revisit", warc.HTTP, **{"Content-Type": http, "WARC-Payload-Digest": f"sha1:{good}", "WARC-Refers-To": "<urn:uuid:1>"}),
        _foreign("metadata", b"", **{"X-Payload-Length": "many"})]
    with open(f"{workdir}/f.warc.gz", "wb") as f:
        f.write(_archive(records))
    rows = warc.read(spark, f"{workdir}/f.warc.gz").collect()
    got_rows = sorted(((r.record_type, r.payload, r.payload_bytes, r.payload_digest, r.digest_ok, r.page_id, r.refers_to) for r in rows), key=str)
    d = warc.digest
    assert got_rows == sorted([
        ("warcinfo", b"software: x\r\n", 13, d(b"software: x\r\n"), None, None, None), ("response", b"hello", 5, good, True, None, None),
        ("response", b"hello", 5, good, False, None, None), ("response", b"hello", 5, good, None, None, None),
        ("request", b"", 0, d(b""), None, None, None), ("resource", b"a\r\n\r\nb", 6, d(b"a\r\n\r\nb"), None, None, None),
        ("revisit", None, None, good, None, None, None), ("metadata", b"", 0, d(b""), None, None, None)], key=str)
    assert {r.record_id for r in rows} == {"<urn:uuid:00000000-0000-0000-0000-00000000000a>"}
