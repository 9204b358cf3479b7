"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its distinct lower-cased words and their leading 4 to 7
bytes (inflected forms share them), hashed into a fixed table.  The model adds
a weight per term and, for every pair of terms, the product of their factor
vectors, so that a pair such as an insult and a group mention can count more
(or less) than its parts.  It is fitted with Adagrad on the logistic loss over a
bounded sample of labelled rows, in one task, and broadcast for scoring.

In long texts most terms say nothing and their products would drown the rest,
so terms are chosen first, by what they do alone or together: a term has
parameters if the share of toxic rows among those with it differs from the
sample's by ``MIN_Z`` standard deviations, or if it is in a pair of words whose
rows are toxic more (or less) often, by ``PAIR_Z`` of them, than the two words'
own shares add up to.  All pairs of words of ``PAIR_LABELS`` rows are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.llm import words as W
from rsvpark.llm.labels import remainder, training_sample
from rsvpark.llm.words import chunks, mix

MOD, HELD_OUT = 5, 0
MAX_LABELS = 20_000
BITS = 18
FACTORS = 8
MIN_ROWS = 3
MIN_Z = 3.5
PAIR_ROWS = 5
PAIR_Z = 7.0
PAIR_LABELS = 5_000             # labelled rows in which pairs of words are counted
PAIRS_AT_ONCE = 2_000_000
PAIR_CELLS = 4_000_000
PREFIXES = (4, 5, 6, 7)
EPOCHS = 12
MIN_STEPS = 250                 # small samples go round more often
BATCH = 256
RATE = 0.1
L1 = 2e-4
L2 = 1e-4
CLIP = 12.0

#: Bytes that end a term: ASCII other than letters and digits.
_BREAK = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _BREAK[_a:_b] = False
#: A-Z, and second bytes 80-9E of two-byte Latin letters, fold to their lower-case form.
_CODE = W._CODE.copy()
_CODE[65:91] = _CODE[97:123]
_CODE[0x80:0x9F] = _CODE[0xA0:0xBF]


def terms(texts) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashed terms of every text: ``(ids, first, n)`` with ``ids[first[i]:first[i+1]]`` those of text ``i``.

    Words have even ids, beginnings of words odd ones.
    """
    data, off = W.text_buffers(texts)
    n, size = len(off) - 1, len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64), n
    inside = ~_BREAK[data]
    edge = off[(off > 0) & (off < size)]
    before = np.concatenate(([False], inside[:-1]))
    before[edge] = False
    after = np.concatenate((inside[1:], [False]))
    after[edge - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64), n
    doc = np.searchsorted(off, start, side="right") - 1
    pw, ipw = W._powers(size + 1)
    s = np.zeros(size + 1, np.uint64)
    np.cumsum(_CODE[data] * pw[:size], out=s[1:])
    full = mix((s[end] - s[start]) * ipw[start] + (end - start).astype(np.uint64))
    # distinct words of each text
    key = mix(full ^ mix(doc.astype(np.uint64)))
    order = np.argsort(key)
    k = key[order]
    keep = np.sort(order[np.concatenate(([True], k[1:] != k[:-1]))])
    start, end, doc, full = start[keep], end[keep], doc[keep], full[keep]
    ids, owner = [full], [doc]
    for p in PREFIXES:
        at = end - start > p
        st = start[at]
        ids.append(mix((s[st + p] - s[st]) * ipw[st] + np.uint64(1000 + p)))
        owner.append(doc[at])
    part = np.repeat([0, 1], [len(full), sum(map(len, ids)) - len(full)])
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    ids = (ids[order] >> np.uint64(64 - BITS)).astype(np.int64) & ~1 | part[order]
    return ids, np.searchsorted(owner[order], np.arange(n + 1)), n


@dataclass
class Model:
    """Bias, a row of weights and factors per known term, and the row of every table slot (-1: none)."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    slot: np.ndarray

    def margin(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of the texts whose terms are ``ids[first[i]:first[i+1]]``."""
        n = len(first) - 1
        row = self.slot[ids]
        known = row >= 0
        at = np.concatenate(([0], np.cumsum(known)))[first]
        row = row[known]
        out = np.full(n, self.bias)
        if not len(row):
            return out
        doc = np.repeat(np.arange(n), np.diff(at))
        out += np.bincount(doc, self.weight[row], minlength=n)
        for f in range(self.factor.shape[1]):
            v = self.factor[row, f]
            s = np.bincount(doc, v, minlength=n)
            out += 0.5 * (s * s - np.bincount(doc, v * v, minlength=n))
        return np.clip(out, -CLIP, CLIP)

    def score(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(ids, first)))


def acting_together(pair: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Words in pairs whose rows are toxic more or less often than the two words' own shares add up to.

    ``pair`` holds ``text * 2^BITS + word``, ascending.  Words are taken in stretches; a stretch is counted
    against all words after its own in one table, so memory is bounded and every pair is counted.
    """
    slots = 1 << BITS
    text, word = pair // slots, pair % slots
    ids, inv, rows = np.unique(word, return_inverse=True, return_counts=True)
    keep = rows[inv] >= PAIR_ROWS
    ids = ids[rows >= PAIR_ROWS]
    v = len(ids)
    if not v:
        return ids
    text, word = text[keep], np.searchsorted(ids, word[keep])
    last = np.searchsorted(text, text, side="right")            # where the text of an entry ends
    toxic = y[text] > 0
    rate = np.bincount(word, weights=toxic, minlength=v) / np.bincount(word, minlength=v)
    by = np.argsort(word, kind="stable")
    first = np.searchsorted(word[by], np.arange(v + 1))
    after = (last - np.arange(len(word)) - 1)[by]
    work = np.concatenate(([0], np.cumsum(after)))[first]
    spread = np.sqrt(share * (1 - share))
    found, a = [], 0
    while a < v:
        z = max(a + 1, min(a + PAIR_CELLS // v, int(np.searchsorted(work, work[a] + PAIRS_AT_ONCE, side="right")) - 1))
        entry, n = by[first[a]:first[z]], after[first[a]:first[z]]
        other = np.repeat(entry + 1, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cell = np.repeat((word[entry] - a) * v, n) + word[other]
        both = np.bincount(cell, minlength=(z - a) * v)
        excess = np.bincount(cell[np.repeat(toxic[entry], n)], minlength=(z - a) * v).astype(float)
        at = np.flatnonzero(both >= PAIR_ROWS)
        one, two = at // v + a, at % v
        excess = excess[at] - both[at] * np.clip(rate[one] + rate[two] - share, 0, 1)
        ok = np.abs(excess) >= PAIR_Z * spread * np.sqrt(both[at])
        found += [one[ok], two[ok]]
        a = z
    return ids[np.unique(np.concatenate(found))]


def train(ids: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 5) -> Model:
    """Fit on texts given as terms; both classes present or the bias alone."""
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    slots = 1 << BITS
    doc = np.repeat(np.arange(n), np.diff(first))
    pair = np.unique(doc * slots + ids)
    rows_with = np.bincount(pair % slots, minlength=slots)
    slot = np.full(slots, -1, np.int32)
    toxic_with = np.bincount(pair % slots, weights=y[pair // slots], minlength=slots)
    z = (toxic_with - share * rows_with) / np.sqrt(np.maximum(rows_with, 1) * share * (1 - share))
    alone = (rows_with >= MIN_ROWS) & (np.abs(z) >= MIN_Z)
    some = np.zeros(n, bool)
    some[np.random.default_rng(seed).permutation(n)[:PAIR_LABELS]] = True
    alone[acting_together(pair[(pair % 2 == 0) & some[pair // slots]], y, share)] = True
    known = np.flatnonzero(alone)
    slot[known] = np.arange(len(known))
    m = len(known)
    rng = np.random.default_rng(seed)
    model = Model(float(np.log(share / (1 - share))), np.zeros(m), rng.normal(scale=0.01, size=(m, FACTORS)), slot)
    if not m or not 0 < y.sum() < n:
        return model
    row = slot[ids]
    ok = row >= 0
    at = np.concatenate(([0], np.cumsum(ok)))[first]
    row = row[ok]
    # rare toxic rows weigh up to three times as much
    boost = np.where(y > 0, min(3.0, (n - y.sum()) / y.sum()), 1.0)
    gw, gv, gb = np.full(m, 1e-6), np.full((m, FACTORS), 1e-6), 1e-6
    steps = max(1, n // BATCH)
    for epoch in range(max(EPOCHS, -(-MIN_STEPS // steps))):
        for part in np.array_split(rng.permutation(n), steps):
            size = at[part + 1] - at[part]
            d = np.repeat(np.arange(len(part)), size)
            pos = np.repeat(at[part] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            r = row[pos]
            v = model.factor[r]
            sums = np.stack([np.bincount(d, v[:, f], minlength=len(part)) for f in range(FACTORS)], axis=1)
            sq = np.bincount(d, (v * v).sum(1), minlength=len(part))
            z = model.bias + np.bincount(d, model.weight[r], minlength=len(part)) + 0.5 * ((sums ** 2).sum(1) - sq)
            p = 1 / (1 + np.exp(-np.clip(z, -CLIP, CLIP)))
            g = (p - y[part]) * boost[part] / len(part)
            used, inv = np.unique(r, return_inverse=True)
            u = len(used)
            grad_w = np.bincount(inv, g[d], minlength=u) + L2 * model.weight[used]
            gw[used] += grad_w ** 2
            step = RATE / np.sqrt(gw[used])
            w = model.weight[used] - step * grad_w
            model.weight[used] = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
            pull = g[d][:, None] * (sums[d] - v)
            grad_v = np.stack([np.bincount(inv, pull[:, f], minlength=u) for f in range(FACTORS)], axis=1) + L2 * model.factor[used]
            gv[used] += grad_v ** 2
            model.factor[used] -= 0.2 * RATE / np.sqrt(gv[used]) * grad_v
            gb += g.sum() ** 2
            model.bias -= RATE / np.sqrt(gb) * g.sum()
    return model


def _train_batches(batches):
    ids, size, ys = [], [], []
    for b in batches:
        for c in chunks(b):
            i, first, _ = terms(c.column(0))
            ids.append(i.astype(np.int32))
            size.append(np.diff(first))
            ys.append(c.column(1).to_numpy(zero_copy_only=False).astype(float))
    if not ys:
        return
    first = np.concatenate(([0], np.cumsum(np.concatenate(size))))
    m = train(np.concatenate(ids).astype(np.int64), first, np.concatenate(ys))
    known = np.flatnonzero(m.slot >= 0).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array([m.bias]), pa.array([known.tobytes()], pa.binary()),
                                      pa.array([m.weight.astype(np.float32).tobytes()], pa.binary()),
                                      pa.array([m.factor.astype(np.float32).tobytes()], pa.binary())],
                                     ["bias", "known", "weight", "factor"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> Model:
    """Fit on the texts of about ``limit`` labelled rows outside the held-out remainder.

    The sample's bound makes both its broadcast and the one training task
    bounded.  Without labels every score is 0.5.
    """
    sample = training_sample(labels, "toxic", MOD, HELD_OUT, limit)
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select("text", F.col("y").cast("double").alias("y"), "doc_id")
            .repartition(1).sortWithinPartitions("doc_id", "text").select("text", "y"))
    got = rows.mapInArrow(_train_batches, "bias double, known binary, weight binary, factor binary").collect()
    if not got:
        return Model(0.0, np.zeros(0), np.zeros((0, FACTORS)), np.full(1 << BITS, -1, np.int32))
    g = got[0]
    known = np.frombuffer(g.known, np.int32)
    slot = np.full(1 << BITS, -1, np.int32)
    slot[known] = np.arange(len(known))
    return Model(g.bias, np.frombuffer(g.weight, np.float32), np.frombuffer(g.factor, np.float32).reshape(-1, FACTORS), slot)


def score(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    A text without known terms (null, empty, unseen words) scores the bias, the
    share of toxic rows; repeated rows get equal scores; other columns of
    ``docs`` are never read.  Texts are scored where they are read, without a
    shuffle; the broadcast model is at most 2^18 terms of nine floats.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, limit))

    def run(batches):
        for b in batches:
            for c in chunks(b):
                ids, first, _ = terms(c.column(1))
                s = model.value.score(ids, first)
                yield pa.RecordBatch.from_arrays([c.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 ["doc_id", "score", "predicted"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (remainder(MOD) == HELD_OUT).alias("held_out"), "score", "predicted")
