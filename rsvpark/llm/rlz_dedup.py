"""Substring dedup by equality with indexed reference blocks, in place of a greedy relative Lempel-Ziv parse.

Every document is cut into reference blocks at content-defined points: the
10-word gram with the smallest hash among those of a 50-word window anchors the
window, and neighbouring windows with the same anchor form one block, so equal
windows of any two documents lie in blocks with equal anchors.  There is no
greedy parse, and no factor extends past a block: a block whose whole
content occurs in a document with a smaller id is a factor, and its windows are
duplicates at once.  A block that shares its anchor but not its content ends or
begins a repeat somewhere inside; there every window is
looked up among the windows of the first document of each such block.

One row per block (about one for 21 words) is shuffled, then single windows
only for blocks that are shared in part.  Smallest ids are grouped minimums
with map-side partials and their joins can be split, so a passage that a third
of the documents hold is never one task's.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.llm.words import chunks, mix, signed, words
from rsvpark.session import materialize

WINDOW = 50
GRAM = 10

_K = 0xC2B2AE3D27D4EB4F | 1
_K_INV = pow(_K, -1, 1 << 64)
_POW = np.ones(1, np.uint64)
_IPOW = np.ones(1, np.uint64)


def _spans_hash(h: np.ndarray):
    """Function ``(start, end) -> hash`` of the word sequence between two word indexes."""
    global _POW, _IPOW
    n = len(h) + 1
    if len(_POW) < n:
        a, b = np.full(n, _K, np.uint64), np.full(n, _K_INV, np.uint64)
        a[0] = b[0] = 1
        _POW, _IPOW = np.cumprod(a), np.cumprod(b)
    s = np.zeros(n, np.uint64)
    np.cumsum(h * _POW[: n - 1], out=s[1:])
    return lambda a, b: mix((s[b] - s[a]) * _IPOW[a] + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def reference_blocks(w, window: int = WINDOW, gram: int = GRAM):
    """Blocks of the windows of all texts: ``doc, lo, n, anchor, content``.

    A block is ``n`` consecutive windows, the first at word ``lo`` (an index
    into all words), that share their anchor gram.
    """
    z = np.zeros(0, np.int64)
    nw = len(w.hash)
    if nw < window:
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    g = np.zeros(nw - gram + 1, np.uint64)
    for i in range(gram):
        g = g * np.uint64(_K) + w.hash[i: nw - gram + 1 + i]
    g = mix(g)
    # leftmost smallest gram of each window, doubling the stretch compared
    best, reach, width = np.arange(len(g)), 1, window - gram + 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(g[a] <= g[b], a, b)
        reach += step
    best = best[: nw - window + 1]
    starts = np.flatnonzero(w.doc[: nw - window + 1] == w.doc[window - 1:])
    if not len(starts):
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    p = best[starts]
    new = np.concatenate(([True], (p[1:] != p[:-1]) | (starts[1:] != starts[:-1] + 1)))
    at = np.flatnonzero(new)
    lo, n, anchor = starts[at], np.diff(np.append(at, len(starts))), p[at]
    content = _spans_hash(w.hash)(lo, lo + n + window - 1)
    content = mix(content ^ mix((anchor - lo).astype(np.uint64) + np.uint64(17)))
    return w.doc[lo], lo, n, g[anchor], content


def _block_batches(window, gram):
    def run(batches):
        for b in batches:
            for c in chunks(b, "text"):
                w = words(c.column(2))
                doc, lo, n, anchor, content = reference_blocks(w, window, gram)
                ids, th = c.column(0), c.column(1)
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), th.take(take), pa.array((lo - w.first[doc]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(signed(anchor)), pa.array(signed(content))],
                    ["doc_id", "th", "lo", "n", "anchor", "content"])
    return run


def _window_batches(window):
    """Hashes of the single windows of the listed blocks of each text."""
    def run(batches):
        for b in batches:
            for c in chunks(b, "text"):
                w = words(c.column(2))
                runs = c.column(3)
                owner = np.repeat(np.arange(c.num_rows), np.diff(runs.offsets.to_numpy()))
                flat = runs.flatten()
                lo, n = flat.field("lo").to_numpy().astype(np.int64), flat.field("n").to_numpy().astype(np.int64)
                first = np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else n, n)
                doc = np.repeat(owner, n)
                pos = np.repeat(lo, n) + np.arange(n.sum()) - first
                at = w.first[doc] + pos
                h = _spans_hash(w.hash)(at, at + window)
                h2 = _spans_hash(mix(w.hash + np.uint64(1)))(at, at + window) >> np.uint64(32)
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [c.column(0).take(take), c.column(1).take(take), pa.array(pos.astype(np.int32)), pa.array(signed(h)),
                     pa.array(h2.astype(np.uint32).view(np.int32))], ["doc_id", "th", "lo", "h", "h2"])
    return run


def _cut_batches(with_text: bool):
    """Drop the words of the listed spans and digest what is left."""
    return lambda batches: _cut(batches, with_text)


def _cut(batches, with_text):
    for b in batches:
        ids, texts, spans = b.column(0), b.column(1).to_pylist(), b.column(2)
        n_words, n_removed, digest, kept_text = [], [], [], []
        for i, text in enumerate(texts):
            ws = (text or "").encode().split()
            n = len(ws)
            sp = spans[i]
            removed = 0
            if sp.is_valid and len(sp):
                v = sp.values
                lo = v.field("lo").to_numpy()
                hi = v.field("hi").to_numpy()
                d = np.bincount(lo, minlength=n + 1) - np.bincount(hi, minlength=n + 1)
                keep = np.cumsum(d)[:n] <= 0
                removed = n - int(keep.sum())
                ws = list(compress(ws, keep))
            rest = b" ".join(ws)
            n_words.append(n)
            n_removed.append(removed)
            digest.append(hashlib.sha256(rest).hexdigest())
            if with_text:
                kept_text.append(rest.decode())
        cols = [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            cols.append(pa.array(kept_text, pa.string()))
            names.append("kept_text")
        yield pa.RecordBatch.from_arrays(cols, names)


def duplicate_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, th, spans)``: the word spans ``[lo, hi)`` of each document that repeat smaller ones.

    ``th`` is a hash of the text, so that rows which repeat a doc_id keep apart.
    Spans may overlap; documents without any are left out.
    """
    blocks = docs.mapInArrow(_block_batches(window, gram), "doc_id long, th long, lo int, n int, anchor long, content long")
    blocks = materialize(blocks, "rlz-blocks")
    # the grouped sides are written tables, so that Spark can split the hot keys of the joins
    shared = (blocks.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor"))
    shared = materialize(shared, "rlz-anchors")
    blocks = materialize(blocks.join(shared, "anchor", "left_semi"), "rlz-shared")
    firsts = materialize(blocks.groupBy("anchor", "content").agg(F.min("doc_id").alias("first")), "rlz-firsts")
    mixed = (firsts.groupBy("anchor").agg(F.min("content").alias("c1"), F.max("content").alias("c2"))
             .select("anchor", (F.col("c1") != F.col("c2")).alias("mixed")))
    firsts = firsts.join(mixed, "anchor")
    b = blocks.join(materialize(firsts, "rlz-contents"), ["anchor", "content"])
    b = materialize(b.select("doc_id", "th", "lo", "n", (F.col("doc_id") > F.col("first")).alias("factor"), "mixed"), "rlz-parse")
    factors = b.where("factor").select("doc_id", "th", "lo", (F.col("lo") + F.col("n") + (window - 1)).cast("int").alias("hi"))
    edges = (b.where("not factor and mixed").groupBy("doc_id", "th")
             .agg(F.collect_set(F.struct("lo", "n")).alias("runs")))
    texts = docs.join(edges, ["doc_id", "th"]).select("doc_id", "th", "text", "runs")
    singles = texts.mapInArrow(_window_batches(window), "doc_id long, th long, lo int, h long, h2 int")
    singles = materialize(singles, "rlz-windows")
    least = (singles.groupBy("h", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .where("first < last").select("h", "h2", "first"))
    least = materialize(least, "rlz-least")
    found = (singles.join(least, ["h", "h2"]).where("doc_id > first")
             .select("doc_id", "th", "lo", (F.col("lo") + window).cast("int").alias("hi")))
    return (factors.unionByName(found).groupBy("doc_id", "th")
            .agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, ``with_text``, ``kept_text`` for every document.

    Null, empty and short texts (under ``window`` words) keep all their words;
    equal windows inside one document, or in rows with the same doc_id, remove
    nothing; a row without doc_id is neither a reference nor cut; other columns
    are ignored.
    """
    d = docs.select("doc_id", "text").where("doc_id is not null").withColumn("th", F.xxhash64("text"))
    d = d.select("doc_id", "th", "text")
    spans = duplicate_spans(d, window, gram)
    none = F.lit(None).cast("array<struct<lo:int,hi:int>>").alias("spans")
    cut = (d.join(spans, ["doc_id", "th"], "left").select("doc_id", "text", "spans")
           .unionByName(docs.select("doc_id", "text", none).where("doc_id is null")))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return cut.mapInArrow(_cut_batches(with_text), out)
