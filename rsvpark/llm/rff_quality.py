"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

About twenty statistics of a text are standardised and mapped to cosines whose
products approximate a Gaussian kernel; a ridge regression on the labels is
fitted from normal equations summed per partition, and its raw score is made a
probability by isotonic regression over binned scores of labelled rows that the
ridge did not see.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.llm.labels import remainder, training_sample
from rsvpark.llm.repetition import _covered, _runs
from rsvpark.llm.words import SMALL_CHUNK, chunks, mix, words
from rsvpark.session import bound_batches, materialize

MOD, HELD_OUT = 3, 1
MAX_LABELS = 20_000
FEATURES = 256
WIDTH = 3.0
RIDGE = 1.0
BINS = 1000
PARTS = 8

STATS = ["log_words", "log_bytes", "word_len", "word_len_sd", "upper", "symbols", "digits", "stops", "bangs", "marked_words",
         "same_as_before", "distinct_words", "covered_3", "top_word", "lone_signs", "not_ascii", "log_lines", "dup_lines",
         "words_per_line", "spaces"]


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_SYMBOLS = _table("#*$%&|<>{}[]=~^_\\@")
_DIGITS = _table("0123456789")
_STOPS = _table(".,;:?")
_BANG = _table("!")
_MARK = _SYMBOLS | _BANG
_ALNUM = _UPPER | _LOWER | _DIGITS
_ALNUM[128:] = True


def statistics(texts) -> np.ndarray:
    """``len(STATS)`` numbers per text; a null or blank text has zeros."""
    w = words(texts)
    n, nw = w.n_docs, len(w.start)
    off = w.offsets
    size = np.diff(off)
    count = w.counts
    nz_b, nz_w = np.maximum(size, 1), np.maximum(count, 1)

    def share(mask):
        c = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (c[off[1:]] - c[off[:-1]]) / nz_b

    def mean_w(v):
        c = np.concatenate(([0.0], np.cumsum(v, dtype=np.float64)))
        return (c[w.first[1:]] - c[w.first[:-1]]) / nz_w

    length = (w.end - w.start).astype(np.float64)
    mean = mean_w(length)
    sd = np.sqrt(np.maximum(mean_w(length ** 2) - mean ** 2, 0))
    letters = np.maximum(share(_UPPER[w.data]) + share(_LOWER[w.data]), 1e-9)
    last = w.data[w.end - 1] if nw else np.zeros(0, np.uint8)
    ascii_alnum = np.concatenate(([0], np.cumsum(_ALNUM[w.data], dtype=np.int64)))
    lone = (ascii_alnum[w.end] == ascii_alnum[w.start]) if nw else np.zeros(0, bool)
    same = np.zeros(nw, bool)
    if nw > 1:
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(0x51ED270B))
    order, run, reps = _runs(mix(w.hash ^ salt[w.doc]) if nw else w.hash)
    distinct = np.bincount(w.doc[order[run]], minlength=n) if nw else np.zeros(n)
    top = np.zeros(n, np.int64)
    if nw:
        np.maximum.at(top, w.doc[order[run]], reps)
    cover = np.zeros(nw, bool)
    if nw > 2:
        k = np.uint64(0xD6E8FEB86659FD93)
        at = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        h = (w.hash[:-2] * k + w.hash[1:-1]) * k + w.hash[2:]
        o, _, reps = _runs(mix(h[at] ^ salt[w.doc[at]]))
        cover = _covered(nw, at[o[np.repeat(reps > 1, reps)]], 3)
    # lines: word sequences between line feeds
    feed = np.concatenate(([0], np.cumsum(w.data == 10, dtype=np.int64)))
    n_lines = feed[off[1:]] - feed[off[:-1]] + 1
    dup = np.zeros(n)
    if nw:
        line = feed[w.start]
        new = np.concatenate(([True], (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])))
        ls = np.flatnonzero(new)
        lh = np.add.reduceat(mix(w.hash + np.uint64(3) * (np.arange(nw) - np.repeat(ls, np.diff(np.append(ls, nw)))).astype(np.uint64)), ls)
        ld = w.doc[ls]
        o, run_l, _ = _runs(mix(lh ^ salt[ld]))
        filled = np.bincount(ld, minlength=n)
        dup = 1 - np.bincount(ld[o[run_l]], minlength=n) / np.maximum(filled, 1)
    x = np.stack([np.log1p(count), np.log1p(size), mean, sd, share(_UPPER[w.data]) / letters, share(_SYMBOLS[w.data]),
                  share(_DIGITS[w.data]), share(_STOPS[w.data]), share(_BANG[w.data]), mean_w(_MARK[last]), mean_w(same),
                  distinct / nz_w, mean_w(cover), top / nz_w, mean_w(lone), share(w.data >= 128), np.log1p(n_lines), dup,
                  np.log1p(count / n_lines), share((w.data == 32) | (w.data == 10))], axis=1) if n else np.zeros((0, len(STATS)))
    x[count == 0] = 0
    return x


def document_statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default ``doc_id``) and ``x``, the statistics of ``text``."""
    keep = keep or ["doc_id"]

    def run(batches):
        for b in batches:
            for c in chunks(b, limit=SMALL_CHUNK):
                x = statistics(c.column(c.schema.get_field_index("text")))
                flat = pa.array(x.ravel(), pa.float64())
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(STATS))
                cols = [c.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(offsets, flat)], [*keep, "x"])

    bound_batches(docs.sparkSession)
    df = docs.select(*[F.col(f"`{c}`") for c in keep], "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1])
    return df.mapInArrow(run, f"{fields}, x array<double>")


def _matrix(col) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


@dataclass
class Model:
    """Standardisation, random frequencies, ridge weights and the calibration's knots."""

    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        f = np.cos(z @ self.freq + self.phase) * np.sqrt(2 / self.freq.shape[1])
        return np.concatenate([f, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a thousandth of the raw score keeps the order inside flat steps."""
        r = self.raw(x)
        return 0.999 * np.interp(r, self.knots, self.values) + 0.001 * np.clip(r, 0, 1)


def _partition_sums(df: DataFrame, rows_of) -> np.ndarray:
    """Sum over all rows of the matrix ``rows_of(x, y)`` gives per batch: summed per
    partition in the tasks, then per matrix row, which moves whole (its numbers one
    by one would be rows of hash maps and sorts)."""
    def run(batches):
        acc = None
        for b in batches:
            if b.num_rows:
                m = rows_of(_matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(float))
                acc = m if acc is None else acc + m
        if acc is not None:
            offsets = pa.array(np.arange(len(acc) + 1, dtype=np.int32) * acc.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(acc), dtype=np.int32)),
                                              pa.ListArray.from_arrays(offsets, pa.array(acc.ravel()))], ["i", "v"])

    def total(table):
        v = _matrix(table.column("v")).sum(0)
        return pa.table({"i": table.column("i")[:1], "v": pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v))})

    sums = df.select("x", "y").mapInArrow(run, "i int, v array<double>").groupBy("i").applyInArrow(total, "i int, v array<double>")
    return np.array([r.v for r in sorted(sums.collect(), key=lambda r: r.i)])


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing fit by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS, mod: int = MOD, held_out: int = HELD_OUT) -> Model:
    """Fit on the texts of about ``limit`` labelled rows outside the held-out remainder.

    A fifth of them (by hash of doc_id) calibrates, the rest fits the ridge.
    Without labels every score is 0.5; with one class only, its label.
    """
    sample = training_sample(labels, "quality", mod, held_out, limit)
    # the sample has about ``limit`` rows of two numbers, so it can be broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(sample.withColumn("y", F.col("y").cast("double"))), "doc_id")
    rows = materialize(document_statistics(texts, ["doc_id", "y"]).repartition(PARTS, "doc_id"), "rff-train")
    d = len(STATS)
    rng = np.random.default_rng(11)
    freq, phase = rng.normal(size=(d, FEATURES)) / (WIDTH * np.sqrt(d / 4)), rng.uniform(0, 2 * np.pi, FEATURES)
    sums = _partition_sums(rows, lambda x, y: np.stack([np.append(x.sum(0), [len(x), y.sum()]), np.append((x ** 2).sum(0), [0, 0])]))
    if not len(sums):
        return Model(np.zeros(d), np.ones(d), freq, phase, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    n, pos = sums[0, d], sums[0, d + 1]
    mean = sums[0, :d] / n
    scale = np.sqrt(np.maximum(sums[1, :d] / n - mean ** 2, 0))
    scale = np.where(scale < 1e-9, 1.0, scale)
    model = Model(mean, scale, freq, phase, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([pos / n, pos / n]))
    if pos in (0, n):
        return model
    # both classes weigh alike, so a rare class is not drowned
    up = {1.0: n / (2 * pos), 0.0: n / (2 * (n - pos))}

    def normal(x, y):
        f = model.features(x) * np.sqrt(np.where(y > 0, up[1.0], up[0.0]))[:, None]
        return f.T @ np.concatenate([f, (y * np.sqrt(np.where(y > 0, up[1.0], up[0.0])))[:, None]], axis=1)

    calibrate = F.expr("pmod(xxhash64(doc_id, 'calibrate'), 5) = 0")
    eq = _partition_sums(rows.where(~calibrate), normal)
    if not len(eq):
        return model
    model.weights = np.linalg.solve(eq[:, :-1] + RIDGE * np.eye(FEATURES + 1), eq[:, -1])

    def binned(batches):
        for b in batches:
            r = np.clip(np.round(model.raw(_matrix(b.column(0))) * BINS), -BINS, 2 * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(r), b.column(1)], ["bin", "y"])

    held = rows.where(calibrate)
    bins = (held.select("x", "y").mapInArrow(binned, "bin int, y double").groupBy("bin")
            .agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect())
    if len(bins) < 20 or not 0 < sum(b.y for b in bins) < sum(b.n for b in bins):
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])  # too few rows to calibrate
        return model
    at = np.array([b.bin for b in bins]) / BINS
    model.knots = at
    model.values = isotonic(np.array([b.y / b.n for b in bins]), np.array([float(b.n) for b in bins]))
    return model


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``score`` and ``predicted``; texts are read once, without a shuffle."""
    bound_batches(docs.sparkSession)
    m = docs.sparkSession.sparkContext.broadcast(model)
    cols = list(dict.fromkeys([*keep, "text"]))

    def run(batches):
        for b in batches:
            for c in chunks(b, limit=SMALL_CHUNK):
                s = m.value.score(statistics(c.column(c.schema.get_field_index("text"))))
                yield pa.RecordBatch.from_arrays([*[c.column(i) for i in range(len(keep))], pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 [*keep, "score", "predicted"])

    df = docs.select(*[F.col(f"`{c}`") for c in cols])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Null, empty and blank texts have the statistics zero and are scored like
    any other; repeated rows get equal scores; a null doc_id never joins a
    label; extra columns are ignored.
    """
    model = fit(docs, labels, limit)
    return score(docs, model, ["doc_id"]).select("doc_id", (remainder(MOD) == HELD_OUT).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """The documents that the classifier accepts, with their own columns and no others."""
    model = fit(docs, labels, limit)
    own = [c for c in docs.columns if c not in ("score", "predicted")]
    renamed = {c: f"__{c}" for c in docs.columns if c in ("score", "predicted")}
    d = docs
    for a, b in renamed.items():
        d = d.withColumnRenamed(a, b)
    kept = score(d, model, [*own, *renamed.values()]).where("predicted = 1").drop("score", "predicted")
    for a, b in renamed.items():
        kept = kept.withColumnRenamed(b, a)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
