"""Exact n-gram Jaccard join by universe partitions.

Sets of 5-word shingles link at a Jaccard similarity of 0.75 or more, i.e. if
they differ in at most ``(|r| + |s|) / 7`` shingles.  Sizes fall into bands (a
set can link only inside its band or with the next); for each band the universe
of shingles is hashed into ``m`` segments.  If ``r`` differs from ``s`` in ``H``
shingles and segments of ``r`` with one credit each (the segment's subsets are
equal) or two (equal up to one deletion) hold ``H + 1`` credits, one of them
matches: the pigeonhole.  So

1. every distinct set indexes its segment subsets, small sets their
   one-deletion neighbourhoods too, and probes the band below;
2. a segment whose subset no smaller set shares is a free credit.  A set with
   ``H + 1`` free credits has no partner: that ends the search for most;
3. the others, and their possible partners (which share all but ``n / 3`` of
   their own segments with somebody), keep their shingles at hand.  Each set that
   lacks free credits pays for the cheapest buckets, by the sets ahead in them,
   until it has enough;
4. in a small bucket the payer meets the sets ahead one by one, unless parity
   sketches show that they differ in too many shingles, and is verified against
   them;
5. sets that meet in large buckets are families (near copies of one text).  A
   family is cut into blocks by hash, every two blocks are one task's work, and
   that task counts common shingles of all its pairs by array products and gives
   only pairs that connect what links: a row per set, never a row per pair.

Verification counts common shingles exactly.  Equal sets are one set all along.
The few sets whose credits can never suffice (crowded segments) are compared
with all sets, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rsvpark.llm.components import components
from rsvpark.llm.names import fresh
from rsvpark.llm.words import SMALL_CHUNK, chunks, mix, ngram_hashes, signed, words
from rsvpark.session import bound_batches, bucketed, materialize, release

SHINGLE = 5
NUM, DEN = 3, 4                 # similarity 3/4
SEGMENTS = 0.45                 # segments of a band for each shingle of its largest set
DELETE_UPTO = 128               # bands up to this size index one-deletion neighbourhoods
GROUP_SHINGLES = 2_000_000       # shingles whose index entries are one group of buckets, on average
MIN_GROUPS = 8
FLUSH = 250_000                 # entries a task holds before it packs them
FILTER_WORDS = 1 << 17
LIGHT = 16                      # buckets with more sets ahead than this are compared as families
SKETCH = 4                      # words of a set's parity sketch
KINDS = [np.int64, np.int32, np.int8] + [np.int64] * SKETCH     # columns of a set in the buckets: id, size, short, sketch
BLOCK_SETS = 2000               # sets of a block of a large family
PAIRS_AT_ONCE = 4_000_000
COLUMNS = 1024
BLOCK_SHINGLES = 500_000        # shingles of a block; also of the sets that a pass compares with all

_BOUND = [1]
while _BOUND[-1] < 1 << 40:
    _BOUND.append(max(_BOUND[-1] + 1, -(-_BOUND[-1] * DEN // NUM)))
BOUND = np.array(_BOUND)
TOP = BOUND[1:] - 1
M = np.ceil(SEGMENTS * TOP).astype(np.int64) + 3
SALT = mix(np.arange(len(BOUND), dtype=np.uint64) + np.uint64(0xA5A5))
_C1, _C2, _C3 = np.uint64(0x632BE59BD9B4E019), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)

OWN, OWN_DEL, LOW, LOW_DEL = range(4)


def most_different(r, s):
    """Largest difference of two linked sets of sizes ``r`` and ``s``."""
    return (r + s) * (DEN - NUM) // (DEN + NUM)


class Sets:
    """Distinct shingle hashes of texts: ``h[first[i]:first[i+1]]`` sorted, with sizes, ids and check sums."""

    def __init__(self, h, first):
        self.h, self.first = h, first
        self.n = np.diff(first)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)

    def ids(self):
        full = self.n > 0
        at = self.first[:-1][full]
        out = []
        for c in (_C1, _C2):
            s = np.zeros(len(self.n), np.uint64)
            if len(at):
                s[full] = np.add.reduceat(mix(self.h + c), at)
            out.append(signed(mix(s ^ (self.n.astype(np.uint64) * c))))
        return out


def shingle_sets(texts, k: int = SHINGLE) -> Sets:
    """Sets of the texts: shingles of ``k`` lower-cased words, or the whole of a shorter text as one."""
    w = words(texts, lower=True)
    h, at = ngram_hashes(w, k)
    doc = w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        first, count = w.first[short], w.counts[short]
        v = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            on = count > i
            v[on] = v[on] * _C3 + w.hash[first[on] + i]
        h = np.concatenate((h, mix(v + count.astype(np.uint64) * _C1 + _C2)))
        doc = np.concatenate((doc, short))
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16 if w.n_docs < 65536 else np.int64), kind="stable")]
    h, doc = h[order], doc[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
        h, doc = h[new], doc[new]
    return Sets(h, np.searchsorted(doc, np.arange(w.n_docs + 1)))


def _segments(s: Sets, low: bool):
    """Segments of the sets in their own band, or in the band below for those that can link there.

    Returns the sets that take part, and per segment: its set, number, size and
    hash sum; per shingle: its segment and hash.
    """
    band = np.searchsorted(BOUND, s.n, side="right") - 1
    if low:
        band = band - 1
        ok = (s.n > 0) & (band >= 0)
        ok[ok] = NUM * s.n[ok] <= DEN * TOP[band[ok]]
    else:
        ok = s.n > 0
    m = np.where(ok, M[np.maximum(band, 0)], 0)
    base = np.concatenate(([0], np.cumsum(m)))
    use = ok[s.doc]
    h, doc = s.h[use], s.doc[use]
    if not len(h):
        return ok, None
    salt = SALT[band[doc]]
    seg = (mix(h ^ salt) % m[doc].astype(np.uint64)).astype(np.int64)
    at = base[doc] + seg
    value = mix(h + _C3)
    total = np.zeros(base[-1], np.uint64)
    np.add.at(total, at, value)
    size = np.bincount(at, minlength=base[-1])
    owner = np.repeat(np.arange(len(s.n)), m)
    number = np.arange(base[-1]) - base[owner]
    key_base = number.astype(np.uint64) * _C1 + SALT[np.maximum(band, 0)][owner]
    deletes = (TOP[np.maximum(band, 0)] <= DELETE_UPTO) & ok
    return ok, (owner, number, size, total, key_base, at, value, deletes)


def credits(s: Sets):
    """Per set and band (own, below): filled segments, and those of two shingles or more that index deletions; -1 if it takes no part."""
    out = []
    for low in (False, True):
        ok, g = _segments(s, low)
        filled, double = np.where(ok, 0, -1), np.where(ok, 0, -1)
        if g is not None:
            owner, _, size, _, _, _, _, deletes = g
            n = len(s.n)
            filled = np.where(ok, np.bincount(owner[size > 0], minlength=n), -1)
            double = np.where(ok, np.bincount(owner[(size > 1) & deletes[owner]], minlength=n), -1)
        out += [filled, double]
    return out


def needed(n, low: bool):
    """Credits that rule out every smaller partner of the band."""
    if not low:
        return most_different(n, n) + 1
    band = np.searchsorted(BOUND, n, side="right") - 1
    return most_different(n, TOP[np.maximum(band - 1, 0)]) + 1


def entries(s: Sets, parts: int):
    """Index entries ``(group, key, set)``; a key holds 34 bits of hash, 12 of the segment's number and 2 of the role."""
    got = []
    for low in (False, True):
        _, g = _segments(s, low)
        if g is None:
            continue
        owner, number, size, total, key_base, at, value, deletes = g
        for role in ((LOW, LOW_DEL) if low else (OWN, OWN_DEL)):
            if role in (OWN, LOW):
                pick = np.flatnonzero(size > 0)
                full = mix(total[pick] + key_base[pick])
                seg = pick
            else:
                tok = np.flatnonzero((size[at] > 1) & deletes[owner[at]])
                seg = at[tok]
                full = mix(total[seg] - value[tok] + key_base[seg])
            key = ((full >> np.uint64(30)) << np.uint64(14)) | ((number[seg].astype(np.uint64) & np.uint64(0xFFF)) << np.uint64(2)) | np.uint64(role)
            got.append(((full & np.uint64(0x3FFFFFFF)) % np.uint64(parts), key, owner[seg]))
    if not got:
        z = np.zeros(0, np.uint64)
        return z, z, z.astype(np.int64)
    return tuple(np.concatenate(x) for x in zip(*got))


def _pack_keys(key: np.ndarray) -> bytes:
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack_keys(raw: bytes) -> np.ndarray:
    a = np.zeros((len(raw) // 6, 8), np.uint8)
    a[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return a.view("<u8").ravel()


_PACKED = "grp long, keys binary, sets binary"


def _packed(group, key, member, columns):
    """One row per group: its keys, and the sets they belong to (column after column) with the number of keys of each."""
    order = np.lexsort((member, group))
    group, key, member = group[order], key[order], member[order]
    cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    ends = np.append(cut[1:], len(group))
    rows = ([], [], [])
    for a, b in zip(cut, ends):
        m = member[a:b]
        at = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
        head = [c[m[at]].tobytes() for c in columns]
        rows[0].append(int(group[a]))
        rows[1].append(_pack_keys(key[a:b]))
        rows[2].append(b"".join([*head, np.diff(np.append(at, len(m))).astype(np.int32).tobytes()]))
    return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], ["grp", "keys", "sets"])


class _Packer:
    """Collects entries of sets until there are ``FLUSH``, then gives them as packed rows."""

    def __init__(self, parts, width):
        self.parts, self.width, self.rows, self.size, self.sets = parts, width, [], 0, 0

    def add(self, s: Sets, columns, of=None):
        g, k, m = of or entries(s, self.parts)
        self.rows.append((g, k, m + self.sets, columns))
        self.sets += len(s.n)
        self.size += len(k)

    def flush(self):
        if self.size:
            g, k, m = (np.concatenate([r[i] for r in self.rows]) for i in range(3))
            cols = [np.concatenate([r[3][j] for r in self.rows]) for j in range(self.width)]
            yield _packed(g, k, m, cols)
        self.rows, self.size, self.sets = [], 0, 0


def _set_batches(batches):
    for b in batches:
        for c in chunks(b, limit=SMALL_CHUNK):
            s = shingle_sets(c.column(2))
            sid, check = s.ids()
            yield pa.RecordBatch.from_arrays(
                [c.column(0), c.column(1), pa.array(sid), pa.array(check), pa.array(s.n.astype(np.int64)), *[pa.array(x.astype(np.int64)) for x in credits(s)]],
                ["doc_id", "tag", "sid", "chk", "n", "own", "own2", "low", "low2"])


def _entry_batches(parts):
    def run(batches):
        pack, seen = _Packer(parts, 2), set()
        for b in batches:
            for c in chunks(b, limit=SMALL_CHUNK):
                s = shingle_sets(c.column(0))
                sid, _ = s.ids()
                # each distinct set of the task once
                new = [i for i, x in enumerate(sid.tolist()) if x not in seen and not seen.add(x) and s.n[i]]
                if not new:
                    continue
                keep = np.zeros(len(s.n), bool)
                keep[new] = True
                t = Sets(s.h[keep[s.doc]], np.concatenate(([0], np.cumsum(s.n[keep]))))
                pack.add(t, [sid[keep], t.n.astype(np.int32)])
                if pack.size >= FLUSH:
                    yield from pack.flush()
        yield from pack.flush()
    return run


def _unpack(table, kinds):
    keys, heads = [], []
    each = sum(np.dtype(k).itemsize for k in kinds) + 4
    for k, h in zip(table.column("keys"), table.column("sets")):
        raw = h.as_py()
        m, at, cols = len(raw) // each, 0, []
        for kind in [*kinds, np.int32]:
            cols.append(np.frombuffer(raw, kind, m, at))
            at += m * np.dtype(kind).itemsize
        keys.append(_unpack_keys(k.as_py()))
        heads.append(np.repeat(np.stack([c.astype(np.int64) for c in cols[:-1]], axis=1), cols[-1], axis=0))
    return np.concatenate(keys), np.concatenate(heads)


def _buckets(table, kinds):
    """Entries of buckets with two sets or more, by bucket, then size and id; equal entries once."""
    key, head = _unpack(table, kinds)
    order = np.argsort(key)
    k = key[order] >> np.uint64(2)
    new = np.concatenate(([True], k[1:] != k[:-1]))
    size = np.diff(np.append(np.flatnonzero(new), len(k)))
    keep = order[np.repeat(size > 1, size)]
    key, head = key[keep], head[keep]
    order = np.lexsort((key & np.uint64(3), head[:, 0], head[:, 1], key >> np.uint64(2)))
    key, head = key[order], head[order]
    if len(key):
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (head[1:, 0] != head[:-1, 0])))
        key, head = key[new], head[new]
    return key, head


def _runs_of(bucket):
    start = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
    return start, np.diff(np.append(start, len(bucket)))


MET = "own", "own2", "low", "low2", "mem"


def _meet(parts: int):
    """Per set: the segments of a group of buckets in which it met a smaller set, by role, and those of its own
    band that any other set shares; packed by the hash of the set."""
    def run(key_of, table):
        ids, sums = _met(table)
        place = (mix(ids.view(np.uint64) ^ _C2) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        at = np.searchsorted(place[order], np.arange(parts + 1))
        rows = [(p, ids[o].tobytes() + b"".join(x[o].astype(np.int32).tobytes() for x in sums))
                for p in range(parts) if len(o := order[at[p]:at[p + 1]])]
        return pa.table({"place": pa.array([r[0] for r in rows], pa.int64()), "met": pa.array([r[1] for r in rows], pa.binary())})
    return run


def _sum_met(place, table):
    """The packed counts of a share of the sets, summed by set."""
    each = 8 + 4 * len(MET)
    ids, sums = [], []
    for raw in table.column("met"):
        raw = raw.as_py()
        m = len(raw) // each
        ids.append(np.frombuffer(raw, np.int64, m))
        sums.append(np.frombuffer(raw, np.int32, m * len(MET), 8 * m).reshape(len(MET), m))
    ids, inv = np.unique(np.concatenate(ids), return_inverse=True)
    sums = np.concatenate(sums, axis=1)
    out = {"sid": pa.array(ids)}
    for name, x in zip(MET, sums):
        out[f"h_{name}"] = pa.array(np.bincount(inv, weights=x, minlength=len(ids)).astype(np.int64))
    return pa.table(out)


def _met(table):
    """Ids of the sets of a group that share a segment, and their counts in the order of ``MET``."""
    key, head = _buckets(table, KINDS[:2])
    start, size = _runs_of(key >> np.uint64(2))
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, [z] * len(MET)
    sid, role = head[:, 0], (key & np.uint64(3)).astype(np.int64)
    pos, none = np.arange(len(key)), len(key)
    meets = {}
    for r in (OWN, OWN_DEL):
        first = np.repeat(np.minimum.reduceat(np.where(role == r, pos, none), start), size)
        meets[r] = (first < pos) & (sid[np.minimum(first, none - 1)] != sid)
    plain, low = (role == OWN) | (role == LOW), role >= LOW
    v0 = plain & meets[OWN]
    v1 = (plain & meets[OWN_DEL]) | (~plain & meets[OWN])
    ids, inv = np.unique(sid, return_inverse=True)
    sums = [np.bincount(inv, weights=x, minlength=len(ids)).astype(np.int64) for x in (v0 & ~low, v1 & ~low, v0 & low, v1 & low, role == OWN)]
    return ids, sums


def _price(key_of, table):
    """Per bucket that a set short of credits met: the number of sets it would be compared with."""
    key, head = _buckets(table, KINDS)
    out = pa.schema([("sid", pa.int64()), ("grp", pa.int64()), ("key", pa.int64()), ("low", pa.bool_()), ("deletion", pa.bool_()), ("cost", pa.int64())])
    start, size = _runs_of(key >> np.uint64(2))
    if not len(start):
        return out.empty_table()
    sid, short = head[:, 0], head[:, 2] > 0
    role = (key & np.uint64(3)).astype(np.int64)

    def before(mask):
        """Entries of ``mask`` ahead in the bucket."""
        c = np.cumsum(mask) - mask
        return c - np.repeat(c[start], size)

    plain = (role == OWN) | (role == LOW)
    b0, b1 = before((role == OWN).astype(np.int64)), before((role == OWN_DEL).astype(np.int64))
    rows = []
    for deletion, cost in ((False, np.where(plain, b0, 0)), (True, np.where(plain, b1, b0))):
        at = np.flatnonzero(short & (cost > 0))
        rows.append((sid[at], key[at], role[at] >= LOW, np.full(len(at), deletion), cost[at]))
    s, k, low, deletion, cost = (np.concatenate(x) for x in zip(*rows))
    return pa.table({"sid": pa.array(s), "grp": pa.array(np.full(len(s), key_of[0].as_py())), "key": pa.array(k.astype(np.int64)),
                     "low": pa.array(low), "deletion": pa.array(deletion), "cost": pa.array(cost)})


def _pay(key_of, table, chosen):
    """The comparisons of the small buckets paid for: pairs of sets, each once, whose sketches do not rule out a link."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    if not chosen.num_rows or not table.num_rows:
        return out.empty_table()
    key, head = _buckets(table, KINDS)
    sid, n, sketch = head[:, 0], head[:, 1], np.ascontiguousarray(head[:, 3:])
    role = (key & np.uint64(3)).astype(np.int64)
    start, size = _runs_of(key >> np.uint64(2))
    # where each payer stands in its bucket: entries are ordered by bucket, size and id
    first, payer, paid = (chosen.column(c).to_numpy() for c in ("key", "sid", "deletion"))
    order = np.lexsort((sid, key))
    k2, s2 = key[order], sid[order]
    spot = np.empty(len(first), np.int64)
    for i, (k, s) in enumerate(zip(first.view(np.uint64), payer)):
        lo, hi = np.searchsorted(k2, k), np.searchsorted(k2, k, side="right")
        spot[i] = order[lo + np.searchsorted(s2[lo:hi], s)]
    begin = np.repeat(start, size)[spot]
    k = spot - begin
    me = np.repeat(np.arange(len(spot)), k)
    c = np.repeat(begin, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    at = spot[me]
    partner = np.where(~paid | (role[spot] == OWN_DEL) | (role[spot] == LOW_DEL), OWN, OWN_DEL)[me]
    ok = (role[c] == partner) & (NUM * n[at] <= DEN * n[c])
    c, at = c[ok], at[ok]
    ok = np.bitwise_count((sketch[c] ^ sketch[at]).view(np.uint64)).sum(axis=1) <= most_different(n[c], n[at])
    p = np.unique(np.stack([sid[c[ok]], sid[at[ok]]], axis=1), axis=0)
    return pa.table({"a": pa.array(p[:, 0]), "b": pa.array(p[:, 1])})


def _crowds(key_of, table, chosen):
    """``(a, b)``: sets joined because they meet in the large buckets that somebody pays for; a set with the least id it meets."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    if not chosen.num_rows or not table.num_rows:
        return out.empty_table()
    key, head = _buckets(table, KINDS)
    bucket = key >> np.uint64(2)
    use = np.isin(bucket, np.unique(chosen.column("key").to_numpy().view(np.uint64) >> np.uint64(2)))
    bucket, ids, of = bucket[use], *np.unique(head[use, 0], return_inverse=True)
    start, size = _runs_of(bucket)
    label = np.arange(len(ids))
    while True:
        least = np.repeat(np.minimum.reduceat(label[of], start), size)
        new = label.copy()
        np.minimum.at(new, of, least)
        if (new == label).all():
            break
        label = new
    return pa.table({"a": pa.array(ids), "b": pa.array(ids[label])})


def sketches(s: Sets) -> np.ndarray:
    """Parities of the shingles in 64 * ``SKETCH`` cells: two sets differ in as many shingles at least as in cells."""
    cell = (mix(s.h ^ _C3) % np.uint64(64 * SKETCH)).astype(np.int64)
    odd = np.bincount(s.doc * (64 * SKETCH) + cell, minlength=len(s.n) * 64 * SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8").reshape(len(s.n), SKETCH)


def _families(unit, table):
    """Per family of a unit: the links of its sets, as pairs with the least set they lead to.

    A unit is some small families, or one or two blocks of a large one; of two blocks only sets of different
    blocks are compared.
    """
    family, block = table.column("family").to_numpy(), table.column("block").to_numpy()
    sid, n = table.column("sid").to_numpy(), table.column("n").to_numpy()
    h = table.column("h").combine_chunks()
    off = h.offsets.to_numpy()
    values = h.values.to_numpy()
    order = np.lexsort((block, family))
    cut = np.flatnonzero(np.concatenate(([True], family[order][1:] != family[order][:-1])))
    out = []
    for a, b in zip(cut, np.append(cut[1:], len(order))):
        rows = order[a:b]
        apart = block[rows] != block[rows[0]]
        split = (b - a) if not apart.any() else int(np.argmax(apart))
        label = _links(values, off, n, rows, split)
        joined = label != np.arange(len(rows))
        out.append(np.stack([sid[rows[label[joined]]], sid[rows[joined]]], axis=1))
    p = np.concatenate(out)
    return pa.table({"a": pa.array(p[:, 0]), "b": pa.array(p[:, 1])})


def _links(values, off, n, rows, split: int) -> np.ndarray:
    """The least row that each of ``rows`` leads to by links; with ``split`` only rows on different sides of it are compared.

    Common shingles are counted for all pairs at once: those that few rows have as pairs of rows, the others by
    products of 0/1 matrices.
    """
    m = len(rows)
    one = split == m
    left, right = (m, m) if one else (split, m - split)
    size = n[rows]
    k = off[rows + 1] - off[rows]
    at = np.repeat(off[rows], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    token, inv, count = np.unique(values[at], return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), k)
    common = np.zeros((left, right), np.float32)
    # rows by token
    by = np.argsort(inv, kind="stable")
    owner, first = owner[by], np.concatenate(([0], np.cumsum(count)))
    few = np.flatnonzero((count > 1) & (count <= max(8, m // 16)))
    held, size_held = [], 0

    def add():
        if held:
            common.reshape(-1)[:] += np.bincount(np.concatenate(held), minlength=left * right)
            held.clear()

    for c in np.unique(count[few]):
        some = few[count[few] == c]
        x, y = np.triu_indices(c, 1)
        for part in np.array_split(some, max(1, len(some) * len(x) // PAIRS_AT_ONCE)):
            own = owner[first[part][:, None] + np.arange(c)]            # a token's rows ascend
            a, b = own[:, x].ravel(), own[:, y].ravel()
            if not one:
                ok = (a < split) & (b >= split)
                a, b = a[ok], b[ok] - split
            held.append(a * right + b)
            size_held += len(a)
            if size_held > PAIRS_AT_ONCE:
                add()
                size_held = 0
    add()
    many = np.flatnonzero(count > max(8, m // 16))
    for i in range(0, len(many), COLUMNS):
        part = many[i:i + COLUMNS]
        dense = np.zeros((m, len(part)), np.float32)
        c = count[part]
        place = np.repeat(first[part], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        dense[owner[place], np.repeat(np.arange(len(part)), c)] = 1
        common += dense @ dense.T if one else dense[:split] @ dense[split:].T
    total = (size[:, None] + size[None, :]) if one else (size[:split, None] + size[None, split:])
    common = common.astype(np.int64)
    linked = DEN * common >= NUM * (total - common)
    if one:
        linked = np.triu(linked, 1)
    x, y = np.nonzero(linked)
    y = y if one else y + split
    label = np.arange(m)
    while len(x):
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of set ids whose sets link."""
    one = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("h").alias("ha"))
    two = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("h").alias("hb"))
    both = pairs.join(two, "b").where(F.col("hb").isNotNull()).join(one, "a").where(F.expr(f"{NUM} * greatest(na, nb) <= {DEN} * least(na, nb)"))
    common = F.size(F.array_intersect("ha", "hb"))
    return both.where(DEN * common >= NUM * (F.col("na") + F.col("nb") - common)).select("a", "b")


def _hash_batches(batches):
    for b in batches:
        for c in chunks(b, limit=SMALL_CHUNK):
            s = shingle_sets(c.column(1))
            sid, _ = s.ids()
            same = np.flatnonzero(sid == c.column(0).to_numpy())
            arr = pa.LargeListArray.from_arrays(pa.array(s.first), pa.array(signed(s.h))).cast(pa.list_(pa.int64()))
            take = pa.array(same)
            yield pa.RecordBatch.from_arrays([pa.array(sid[same]), pa.array(s.n[same].astype(np.int64)), arr.take(take)], ["sid", "n", "h"])


def _sets_in(b) -> Sets:
    h = b.column(2)
    off = h.offsets.to_numpy()
    return Sets(h.flatten().to_numpy().view(np.uint64), (off - off[0]).astype(np.int64))


def _credit_batches(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x.astype(np.int64)) for x in credits(_sets_in(b))]],
                                         ["sid", "n", "own", "own2", "low", "low2"])


def _active_batches(parts):
    def run(batches):
        pack = _Packer(parts, len(KINDS))
        for b in batches:
            s = _sets_in(b)
            pack.add(s, [b.column(0).to_numpy(), s.n.astype(np.int32), b.column(3).to_numpy(zero_copy_only=False).astype(np.int8), *sketches(s).T])
            if pack.size >= FLUSH:
                yield from pack.flush()
        yield from pack.flush()
    return run


def _against_all(block):
    """Links of the sets of a broadcast block with the sets of all texts."""
    def run(batches):
        h, owner, sid_b, n_b = block.value
        for b in batches:
            for c in chunks(b, limit=SMALL_CHUNK):
                s = shingle_sets(c.column(0))
                sid, _ = s.ids()
                lo, hi = np.searchsorted(h, s.h, side="left"), np.searchsorted(h, s.h, side="right")
                hit = np.flatnonzero(hi > lo)
                k = hi[hit] - lo[hit]
                at = np.repeat(lo[hit], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                pair = np.repeat(s.doc[hit], k) * len(sid_b) + owner[at]
                pair, common = np.unique(pair, return_counts=True)
                d, f = pair // len(sid_b), pair % len(sid_b)
                ok = (DEN * common >= NUM * (s.n[d] + n_b[f] - common)) & (sid[d] != sid_b[f])
                yield pa.RecordBatch.from_arrays([pa.array(sid[d[ok]]), pa.array(sid_b[f[ok]])], ["a", "b"])
    return run


def _crowded_links(docs: DataFrame, crowded: DataFrame, reps: DataFrame) -> DataFrame | None:
    """Links of the sets whose credits cannot suffice, found against all sets, block by block."""
    total = crowded.agg(F.sum("n")).first()[0]
    if not total:
        return None
    spark = docs.sparkSession
    blocks = math.ceil(total / BLOCK_SHINGLES)
    sets = _sets_of(docs, crowded.select("sid"), reps)
    sets = materialize(sets, "ngram-crowded")
    out = None
    for i in range(blocks):
        rows = sets.where(F.expr(f"pmod(xxhash64(sid), {blocks}) = {i}")).dropDuplicates(["sid"]).collect()
        if not rows:
            continue
        h = np.concatenate([np.array(r.h, np.int64) for r in rows]).view(np.uint64)
        owner = np.repeat(np.arange(len(rows)), [r.n for r in rows])
        order = np.argsort(h)
        block = spark.sparkContext.broadcast((h[order], owner[order], np.array([r.sid for r in rows]), np.array([r.n for r in rows])))
        got = materialize(docs.select("text").mapInArrow(_against_all(block), "a long, b long"), "ngram-crowded-links")
        out = got if out is None else out.unionByName(got)
    return out


def _sets_of(docs: DataFrame, sids: DataFrame, reps: DataFrame) -> DataFrame:
    """``(sid, n, h)``: the shingle hashes of the listed sets, from one document of each."""
    want = sids.join(reps, "sid").select(F.col("rep").alias("doc_id"), "sid")
    # a hash filter of FILTER_WORDS rows at most thins the texts out before they are shuffled
    place = lambda c: F.expr(f"pmod(xxhash64({c}), {64 * FILTER_WORDS})")
    bits = (want.select(place("doc_id").alias("p")).groupBy(F.expr("p div 64").alias("__word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("__bits")))
    some = (docs.select("doc_id", "text").withColumn("__p", place("doc_id")).withColumn("__word", F.expr("__p div 64")).join(F.broadcast(bits), "__word")
            .where("shiftright(__bits, cast(__p % 64 as int)) & 1 = 1").select("doc_id", "text"))
    return some.join(want, "doc_id").select("sid", "text").mapInArrow(_hash_batches, "sid long, n long, h array<long>")


_CREDITS = "sid long, n long, own long, own2 long, low long, low2 long"


def _needs(sets: DataFrame) -> DataFrame:
    """``sets`` (columns of ``_CREDITS``) with the credits that rule out every smaller partner, per band."""
    band = F.size(F.filter(F.array(*[F.lit(int(x)) for x in BOUND]), lambda b: b <= F.col("n")))  # 1-based
    top = F.element_at(F.array(*[F.lit(int(x)) for x in TOP]), F.greatest(F.expr("band - 1"), F.lit(1)).cast("int"))
    return (sets.withColumn("band", band).withColumn("need", F.expr(f"(2 * n) * {DEN - NUM} div {DEN + NUM} + 1"))
            .withColumn("need_low", 1 + F.floor((F.col("n") + top) * (DEN - NUM) / (DEN + NUM)))
            .select("sid", "n", "own", "own2", "low", "low2", "need", "need_low"))


def _crowded(needs: DataFrame) -> DataFrame:
    """Sets whose credits can never suffice."""
    return needs.where("own + own2 < need or (low >= 0 and low + low2 < need_low)")


def paid_buckets(hashes: DataFrame, packed: DataFrame) -> DataFrame:
    """``(grp, sid, key, deletion, cost)``: the buckets in which the sets short of credits are compared.

    Each pays for the cheapest of its buckets until its credits suffice.
    """
    price = materialize(packed.groupBy("grp").applyInArrow(_price, "sid long, grp long, key long, low boolean, deletion boolean, cost long"), "ngram-price")
    met = price.groupBy("sid", "low").agg(F.sum(F.expr("if(deletion, 0, 1)")).alias("v0"), F.sum(F.expr("if(deletion, 1, 0)")).alias("v1"))
    have = _needs(hashes.where("short").select("sid", "n", "h").mapInArrow(_credit_batches, _CREDITS))
    have = materialize(have, "ngram-credits")
    owns = have.select("sid", F.lit(False).alias("low"), F.col("own").alias("c"), F.col("own2").alias("c2"), "need")
    lows = have.where("low >= 0").select("sid", F.lit(True).alias("low"), F.col("low").alias("c"), F.col("low2").alias("c2"), F.col("need_low").alias("need"))
    due = (owns.unionByName(lows).join(met, ["sid", "low"])
           .withColumn("due", F.expr("need - (c - v0 + greatest(0, c2 - v1 - v0))")).where("due > 0")
           .select("sid", "low", "due", (F.col("c") < F.col("need")).alias("all_of_it")))
    rank = F.row_number().over(Window.partitionBy("sid", "low", "deletion").orderBy("cost", "key"))
    chosen = (price.join(due, ["sid", "low"]).withColumn("rank", rank).where("all_of_it or (not deletion and rank <= due)")
              .select("grp", "sid", "key", "deletion", "cost"))
    chosen = materialize(chosen, "ngram-paid")
    release(price, have)
    return chosen


def family_links(hashes: DataFrame, packed: DataFrame, crowd: DataFrame) -> DataFrame:
    """Links of the sets that meet in the large buckets ``crowd(grp, sid, key, ...)``, as pairs that connect the same sets.

    Sets that meet there, directly or by others, are one family.  Small families share a unit; a large one is
    dealt by hash into blocks, and each two of its blocks are a unit.  A unit counts its common shingles itself
    and gives a pair per set at most, so rows grow with a family's size times its blocks.
    """
    met = materialize(packed.groupBy("grp").cogroup(crowd.groupBy("grp")).applyInArrow(_crowds, "a long, b long").distinct(), "ngram-crowds")
    # a set that only meets itself in a group is in none of them
    family = materialize(components(met.where("a <> b")), "ngram-families")
    release(met)
    sized = hashes.join(family, hashes.sid == family.id).select("sid", "n", "h", F.col("label").alias("family"))
    blocks = (hashes.select("sid", "n").join(family, hashes.sid == family.id).groupBy(F.col("label").alias("family"))
              .agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).alias("blocks")))
    dealt = sized.join(blocks, "family").withColumn("block", F.expr("pmod(xxhash64(sid, 11), blocks)"))
    n = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = F.struct(F.lit(-1).cast("long").alias("family"), F.expr(f"pmod(xxhash64(family), {8 * n})").alias("one"), F.lit(0).cast("long").alias("two"))
    # a block alone is the unit (i, i); otherwise it meets every other block of its family
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                       lambda j: F.struct(F.col("family"), F.least(F.col("block"), j).alias("one"), F.greatest(F.col("block"), j).alias("two")))
    units = dealt.withColumn("unit", F.explode(F.when(F.col("blocks") == 1, F.array(small)).otherwise(pair)))
    return (units.select("unit.*", "sid", "n", "h", F.col("family").alias("of"), "block")
            .select(F.struct("family", "one", "two").alias("unit"), F.col("of").alias("family"), "block", "sid", "n", "h")
            .groupBy("unit").applyInArrow(_families, "a long, b long"))


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets of all documents, and ``(sid, label)`` of the sets that link with others.

    ``sets(doc_id, sid, n, ...)`` has a row per document; sets with equal
    ``label`` are one component.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    d = docs.select("doc_id", "text")
    tagged = d.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    sets = materialize(tagged.mapInArrow(_set_batches, "doc_id long, tag long, sid long, chk long, n long, own long, own2 long, low long, low2 long"), "ngram-sets")
    named = sets.where("doc_id is not null and n > 0")
    total, clash = (named.groupBy("sid").agg(F.max("n").alias("n"), (F.min("chk") != F.max("chk")).alias("clash"))
                    .agg(F.sum("n"), F.max(F.col("clash").cast("int"))).first())
    if clash:
        raise ValueError("two different shingle sets have the same 64-bit id")
    parts = max(MIN_GROUPS, math.ceil((total or 0) / GROUP_SHINGLES))
    reps = (named.groupBy("sid").agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "own", "own2", "low", "low2")]))
    reps = materialize(reps, "ngram-reps")
    needs = _needs(reps)

    texts = d.where("doc_id is not null").select("text")
    met = (texts.mapInArrow(_entry_batches(parts), _PACKED).groupBy("grp").applyInArrow(_meet(parts), "place long, met binary")
           .groupBy("place").applyInArrow(_sum_met, "sid long, " + ", ".join(f"h_{c} long" for c in MET)))
    hits = materialize(met, "ngram-met")

    def lacks(c):
        """Free credits of a band do not reach what is needed."""
        need = "need" if c == "own" else "need_low"
        return f"({c} >= 0 and {c} - h_{c} + greatest(0, {c}2 - h_{c}2 - h_{c}) < {need})"

    crowded = _crowded(needs).select("sid", "n")
    # the smaller set of a linked pair differs in n / 3 shingles at most, so it shares all its segments but as many
    active = (needs.join(hits, "sid").withColumn("short", F.expr(f"{lacks('own')} or {lacks('low')}"))
              .withColumn("partner", F.expr(f"own - h_mem <= n * {DEN - NUM} div {NUM}")).where("short or partner"))
    active = materialize(active.select("sid", "n", "own", "own2", "low", "low2", "need", "need_low", "short", "partner"), "ngram-active")
    hashes = bucketed(_sets_of(d, active.select("sid"), reps).dropDuplicates(["sid"]).join(active.select("sid", "short"), "sid"), ["sid"], "ngram_hashes")
    release(active, hits)
    # read by group three times: its layout is written once
    packed = bucketed(hashes.select("sid", "n", "h", "short").mapInArrow(_active_batches(parts), _PACKED), ["grp"], "ngram_buckets")
    chosen = paid_buckets(hashes, packed)
    light, heavy = chosen.where(F.col("cost") <= LIGHT), chosen.where(F.col("cost") > LIGHT)
    pairs = materialize(packed.groupBy("grp").cogroup(light.groupBy("grp")).applyInArrow(_pay, "a long, b long").distinct(), "ngram-pairs")
    edges = [materialize(verified(pairs, hashes), "ngram-links"), materialize(family_links(hashes, packed, heavy), "ngram-links")]
    release(packed, chosen, pairs, hashes)
    more = _crowded_links(d.where("doc_id is not null"), crowded, reps)
    if more is not None:
        edges.append(more)
    labels = materialize(components(_all(edges)).withColumnRenamed("id", "sid"), "ngram-labels")
    release(reps, *edges)
    return sets, labels


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def join(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document.

    A document without words, or without a doc_id, links with nothing (its
    component is itself); rows with equal texts are one set; rows that repeat a
    doc_id are one vertex only if their texts link; other columns are ignored.
    """
    return _components(docs).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, tag, n_shingles, component_id``; ``tag`` is a hash of the text."""
    sets, labels = links(docs)
    named = sets.where("doc_id is not null and n > 0")
    least = named.groupBy("sid").agg(F.min("doc_id").alias("least"))
    of = least.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    smallest = of.groupBy("label").agg(F.min("least").alias("component_id"))
    of = of.join(smallest, "label").select("sid", "component_id")
    out = named.select("doc_id", "tag", "sid", F.col("n").alias("n_shingles")).join(of, "sid").select("doc_id", "tag", "n_shingles", "component_id")
    alone = sets.where("doc_id is null or n = 0").select("doc_id", "tag", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with its own columns.

    Documents without words or without doc_id all stay; of rows that repeat a
    doc_id and a text one stays.
    """
    of = materialize(_components(docs), "ngram-components")
    chosen = (of.where("doc_id is not null and n_shingles > 0").groupBy("component_id")
              .agg(F.min(F.struct("doc_id", "tag")).alias("k")).select("k.doc_id", "k.tag"))
    empty = of.where("doc_id is not null and n_shingles = 0").select("doc_id", "tag").distinct()
    doc, tag = fresh(docs.columns, "kept_doc", "kept_tag")
    keep = chosen.unionByName(empty).select(F.col("doc_id").alias(doc), F.col("tag").alias(tag))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.where("doc_id is not null").withColumns({tag: F.xxhash64("text"), doc: F.col("doc_id")})
    # rows that repeat a doc_id and a text are few keys; only those are brought together, after a partial pick
    more = of.where("doc_id is not null").groupBy(F.col("doc_id").alias(doc), F.col("tag").alias(tag)).count().where("count > 1").select(doc, tag)
    kept = rows.join(keep, [doc, tag], "left_semi")
    once = kept.join(more, [doc, tag], "left_anti").select(*cols)
    again = (kept.join(more, [doc, tag], "left_semi").groupBy(doc, tag).agg(F.first(F.struct(*cols)).alias(tag + "_row"))
             .select(*[F.col(f"{tag}_row.`{c}`") for c in docs.columns]))
    return once.unionByName(again).unionByName(docs.where("doc_id is null").select(*cols))
