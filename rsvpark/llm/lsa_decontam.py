"""Benchmark decontamination by latent semantic retrieval.

TF-IDF passages (of the benchmark items and of all documents) form a matrix
whose leading right singular vectors are found by a randomised SVD: products
with the matrix are summed per partition in Spark, only ``terms x rank`` numbers
reach the driver.  Every passage of every document is
then folded into that space; passages whose cosine with an item is high enough
are candidates, and a candidate is a leak if the longest common subsequence of
the item and the text around the passage covers most of the item, or a good
part of it and the item's answer (its last sentence) too.

Nothing rests on the subspace alone: a stretch of text of up to twice an item's
length that holds enough of the item's words for those shares is a candidate
too.  It must hold some of the item's rarest words (at most ``n - least`` of
``n`` words may be missing), so these are counted per tile of the text; the
count rules out only what the LCS would reject.

Term weights and the list of terms that say nothing come from all documents:
each task sums its passages by slot, so the driver gets one array.  A passage of
the fit is written as its counts on the items' terms and the mass of its other
terms, which is all that its unit vector needs.

Documents are read twice per block of items (for the fit and to be judged) and never shuffled: passages go to
the subspace only if enough of their TF-IDF mass is on terms of the items (that
share bounds what the cosine can mean), so most passages end there.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.llm.names import fresh
from rsvpark.llm.words import chunks, words
from rsvpark.session import materialize, release

BITS = 18
RANK = 128
EXTRA = 8
POWER = 3
PARTS = 8
ITEM_BLOCK = 4096
PIECE = 64
STRIDE = 16
SPANS = (2, 4)
STOP_SHARE = 0.02
MASS = 0.15
COSINE = 0.55
LCS_ALONE = 0.70
LCS_WITH_ANSWER = 0.55
ANSWER = 0.80
MIN_TILE = 32
CELLS = 1 << 20
GRAM_CELLS = 1 << 13
BLOCK = 1024


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _passages(batches):
    """Per chunk of text, ``(passage, slot, count)`` of its consecutive passages of ``PIECE`` words."""
    for b in batches:
        for c in chunks(b):
            w = words(c.column(0), lower=True)
            if not len(w.hash):
                continue
            pos = np.arange(len(w.hash)) - w.first[w.doc]
            row = np.cumsum(pos % PIECE == 0) - 1
            key = row << BITS | _slots(w.hash)
            if key[-1] >> 32 == 0:
                key = key.astype(np.uint32)     # sorted in half the time; only a long text alone has more passages
            key, n = np.unique(key, return_counts=True)
            key = key.astype(np.int64)
            yield key >> BITS, key & ((1 << BITS) - 1), n


def _passage_batches(model):
    """Counts of the items' terms in every passage that holds one, and ``rest``, the squared weights of its other terms."""
    def run(batches):
        idf, col = model.value
        for row, slot, n in _passages(batches):
            k = col[slot] >= 0
            at, first = np.unique(row[k], return_index=True)
            if not len(at):
                continue
            rest = np.bincount(row[~k], (n[~k] * idf[slot[~k]]) ** 2, minlength=int(row[-1]) + 1)[at]
            off = np.append(first, k.sum()).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(off, pa.array(slot[k].astype(np.int32))),
                                              pa.ListArray.from_arrays(off, pa.array(n[k].astype(np.int32))), pa.array(rest, pa.float64())], ["slot", "n", "rest"])
    return run


def _statistic_batches(batches):
    """Per task, passages by slot as blocks of ``BLOCK`` slots; block -1 is the number of passages."""
    df, total = np.zeros(1 << BITS), 0
    for row, slot, _ in _passages(batches):
        df += np.bincount(slot, minlength=1 << BITS)
        total += int(row[-1]) + 1
    if total:
        blocks = [(-1, np.array([float(total)]))] + [(i, df[i:i + BLOCK]) for i in range(0, len(df), BLOCK) if df[i:i + BLOCK].any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()), pa.array([x.tobytes() for _, x in blocks], pa.binary())], ["i", "m"])


def _pieces(batches):
    """Batches cut to about ``GRAM_CELLS`` counts each, which bounds the rows of their product."""
    for b in batches:
        end = b.column(0).offsets.to_numpy()
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(end, end[at] + GRAM_CELLS, side="right")) - 1)
            yield b.slice(at, to - at)
            at = to


def _add_sums(out: np.ndarray, key: np.ndarray, at: np.ndarray, v: np.ndarray, rows: np.ndarray) -> None:
    """``out[key] += v * rows[at]`` over all entries, which are sorted by ``key``: the j-th entries of all keys at once."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(np.append(first, len(key)))
    order = np.argsort(-n, kind="stable")
    first, n = first[order], n[order]
    part = np.zeros((len(first), out.shape[1]))
    for j in range(int(n[0])):
        f = first[:np.searchsorted(-n, -j)] + j
        x = rows[at[f]]
        x *= v[f][:, None]
        part[:len(f)] += x
    out[key[first]] += part


def _gram_batches(model):
    """Per partition, ``A^T (A Z)`` as blocks of rows; rows of A are unit TF-IDF passages on the items' terms.

    A passage may come without its other terms: ``rest``, where there is one, is their share of its norm.
    """
    def run(batches):
        idf, col, z = model.value
        acc = np.zeros_like(z)
        used = False
        for b in _pieces(batches):
            slots, n = b.column(0), b.column(1)
            s, v = slots.flatten().to_numpy(), n.flatten().to_numpy().astype(float)
            row = np.repeat(np.arange(len(slots)), np.diff(slots.offsets.to_numpy()))
            v = v * idf[s]
            norm = np.bincount(row, v * v, minlength=len(slots))
            norm = np.sqrt(norm + b.column(2).to_numpy() if b.num_columns > 2 else norm)
            c = col[s]
            k = c >= 0
            if not k.any():
                continue
            used = True
            # a passage holds few of the terms: sums over its counts, not products with a matrix of zeros
            row, c = row[k], c[k]
            v = v[k] / np.maximum(norm[row], 1e-12)
            y = np.zeros((len(slots), z.shape[1]))
            _add_sums(y, row, c, v, z)
            by_term = np.argsort(c, kind="stable")
            _add_sums(acc, c[by_term], row[by_term], v[by_term], y)
        if used:
            for i in range(0, len(acc), 256):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([acc[i:i + 256].tobytes()], pa.binary())], ["i", "m"])
    return run


def _sum_blocks(key, table):
    total = None
    for m in table.column("m"):
        a = np.frombuffer(m.as_py(), float)
        total = a.copy() if total is None else total + a
    return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})


def statistics(docs: DataFrame, items: DataFrame) -> tuple[int, np.ndarray]:
    """Number of passages, and of passages by slot, over all documents and items."""
    texts = docs.select("text").unionByName(items.select("text"))
    rows = texts.mapInArrow(_statistic_batches, "i int, m binary").groupBy("i").applyInArrow(_sum_blocks, "i int, m binary").collect()
    total, df = 0, np.zeros(1 << BITS)
    for x in rows:
        a = np.frombuffer(x.m, float)
        if x.i < 0:
            total = int(a[0])
        else:
            df[x.i: x.i + len(a)] = a
    return total, df


def randomised_svd(passages: DataFrame, idf: np.ndarray, col: np.ndarray, n_terms: int, rank: int = RANK, seed: int = 3) -> np.ndarray:
    """Leading right singular vectors ``(n_terms, <= rank)`` of the passage matrix by subspace iteration."""
    sc = passages.sparkSession.sparkContext
    width = min(rank + EXTRA, n_terms)
    z = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_terms, width)))[0]
    for step in range(POWER):
        model = sc.broadcast((idf, col, z))
        rows = (passages.mapInArrow(_gram_batches(model), "i int, m binary").groupBy("i").applyInArrow(_sum_blocks, "i int, m binary").collect())
        model.destroy()
        r = np.zeros((n_terms, width))
        for x in rows:
            a = np.frombuffer(x.m, float).reshape(-1, width)
            r[x.i: x.i + len(a)] = a
        if step == POWER - 1:
            value, vec = np.linalg.eigh(z.T @ r)
            top = np.argsort(-value)[:rank]
            return z @ vec[:, top[value[top] > 1e-12]]
        z = np.linalg.qr(r)[0]
    return z


@dataclass
class Counted:
    """Items of one length class and the postings of their rarest words."""

    tile: int             # words of a tile, at least twice the longest item
    items: np.ndarray     # index of each item
    need: np.ndarray      # how many of the listed words two adjoining tiles must hold
    at: np.ndarray        # slot -> first of its postings
    deg: np.ndarray       # slot -> number of its postings
    post: np.ndarray      # postings: position in ``items``


def _least(n: int) -> int:
    """Words of an item of ``n`` that a leak holds at least."""
    return max(1, math.ceil(LCS_WITH_ANSWER * n - 1e-9))


def _places(item: np.ndarray) -> dict:
    """Word -> its places in the item, as bits."""
    out: dict = {}
    for i, x in enumerate(item.tolist()):
        out[x] = out.get(x, 0) | (1 << i)
    return out


def counted(item_words: list, df: np.ndarray) -> list[Counted]:
    """Length classes of items; ``df`` only says which words are looked up, not what is found."""
    classes: dict = {}
    for i, w in enumerate(item_words):
        if len(w):
            classes.setdefault(max(MIN_TILE, 2 << (len(w) - 1).bit_length()), []).append(i)
    out = []
    for tile, items in sorted(classes.items()):
        slots, owner, need = [], [], []
        for j, i in enumerate(items):
            s = _slots(item_words[i])
            miss = len(s) - _least(len(s))
            s = s[np.argsort(df[s], kind="stable")][:miss + max(1, len(s) // 4)]
            slots.append(s)
            owner.append(np.full(len(s), j, np.int32))
            need.append(len(s) - miss)
        slot, post = np.concatenate(slots), np.concatenate(owner)
        order = np.argsort(slot, kind="stable")
        deg = np.bincount(slot, minlength=1 << BITS).astype(np.int32)
        out.append(Counted(tile, np.array(items), np.array(need), (np.cumsum(deg) - deg).astype(np.int32), deg, post[order]))
    return out


@dataclass
class Model:
    """What a pass over the documents needs for one block of items."""

    mass: np.ndarray      # squared idf of every slot
    col: np.ndarray       # slot -> row of fold, -1 for other terms
    fold: np.ndarray      # term -> latent vector, idf included
    items: np.ndarray     # latent unit vectors of the items' pieces
    owner: np.ndarray     # piece -> index of its item
    item_ids: list
    item_words: list      # word hashes of each item
    answer_at: list       # index of the first word of its answer
    places: list          # word -> its places, of each item
    counted: list         # length classes of the items


def answer_start(text: str) -> int:
    """Index of the first word of the last sentence; of a single sentence, of its last fifth."""
    ws = text.replace("\n", " \n ").split(" ")
    n, last = 0, 0
    total = len(text.split())
    for w in ws:
        w2 = w.strip()
        if not w2:
            if "\n" in w and n < total:
                last = n
            continue
        n += len(w.split())
        if w2[-1] in ".?!" and n < total:
            last = n
    return last if last else total - max(1, total // 5)


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel over ``b``)."""
    if not len(a) or not len(b):
        return 0
    where: dict = {}
    for i, x in enumerate(b.tolist()):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(b)) - 1
    v = full
    for x in a.tolist():
        m = where.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def fit(docs: DataFrame, items: list, rank: int = RANK, sample_docs: int | None = None, stats: tuple[int, np.ndarray] | None = None) -> Model | None:
    """Model for ``items`` (rows ``item_id, text`` of one block); None if they hold no word.

    The subspace is fitted on all documents (only if ``sample_docs`` is given,
    on about so many of them, by hash of doc_id); ``stats`` (default: of all
    ``docs`` and these items) gives the weights of the terms.
    """
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    w = words(pa.array([t for _, t in items], pa.string()), lower=True)
    if not len(w.hash):
        return None
    picked = docs
    if sample_docs is not None:
        span = 1 << 30
        picked = docs.where(F.expr(f"pmod(xxhash64(doc_id, 'lsa'), {span})") < math.ceil(span * min(1.0, sample_docs / max(1, docs.count()))))
    own = spark.createDataFrame([(t,) for _, t in items], "text string")
    total, df = stats or statistics(docs, own)
    idf = np.log((1 + total) / (1 + df))
    slot = _slots(w.hash)
    # a term of most passages says nothing; the floor keeps all terms of a tiny collection
    stop = df > max(STOP_SHARE * total, 8)
    terms = np.unique(slot[~stop[slot]])
    if not len(terms):
        terms = np.unique(slot)
    col = np.full(1 << BITS, -1, np.int32)
    col[terms] = np.arange(len(terms))
    known = sc.broadcast((idf, col))
    passages = materialize(own.unionByName(picked.select("text")).mapInArrow(_passage_batches(known), "slot array<int>, n array<int>, rest double"), "lsa-passages")
    # every task of a step gives an array of terms x rank: as many tasks as run at once, whatever the input
    v = randomised_svd(passages.coalesce(max(PARTS, sc.defaultParallelism)), idf, col, len(terms), rank)
    release(passages)
    known.destroy()
    fold = (v * idf[terms][:, None]).astype(np.float32)
    pos = np.arange(len(w.hash)) - w.first[w.doc]
    piece = np.cumsum(pos % PIECE == 0) - 1
    owner = w.doc[pos % PIECE == 0]
    latent = np.zeros((len(owner), fold.shape[1]), np.float32)
    c = col[slot]
    np.add.at(latent, piece[c >= 0], fold[c[c >= 0]])
    norm = np.linalg.norm(latent, axis=1)
    latent /= np.maximum(norm, 1e-9)[:, None]
    bounds = [w.hash[w.first[i]:w.first[i + 1]] for i in range(w.n_docs)]
    starts = [answer_start(t or "") for _, t in items]
    return Model((idf ** 2).astype(np.float32), col, fold, latent, owner, [i for i, _ in items], bounds, starts, [_places(x) for x in bounds], counted(bounds, df))


def _verify(m: Model, item: int, text: np.ndarray, lo: int, hi: int):
    """``(covered, answer)`` shares of an item in the words ``lo - slack .. hi + slack`` of a text."""
    want = m.item_words[item]
    near = text[max(0, lo - len(want)): hi + len(want)]
    n = len(want)
    places = m.places[item]
    if sum(places[x].bit_count() for x in places.keys() & set(near.tolist())) < LCS_WITH_ANSWER * n:
        return 0.0, 0.0
    got = lcs(want, near) / n
    if got < LCS_WITH_ANSWER:
        return got, 0.0
    answer = want[m.answer_at[item]:]
    return got, lcs(answer, near) / max(1, len(answer))


def _leaks(covered: float, answer: float) -> bool:
    return covered >= LCS_ALONE or (covered >= LCS_WITH_ANSWER and answer >= ANSWER)


def _covered(hits: list, n: int) -> int:
    """``lcs`` from the places (bits) of each text word in an item of ``n`` words."""
    v = full = (1 << n) - 1
    for k in hits:
        u = v & k
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _stretch(m: Model, item: int, text: np.ndarray, lo: int, tile: int):
    """``(word, covered, answer)`` of the first leaking stretch of twice the item's length that begins in a tile."""
    places, n = m.places[item], len(m.item_words[item])
    near = text[lo: lo + 2 * tile].tolist()
    held = places.keys() & set(near)
    least = _least(n)
    # the places of different words are apart
    if sum(places[x].bit_count() for x in held) < least:
        return None
    at = [i for i, x in enumerate(near) if x in held]
    hits = [places[near[i]] for i in at]
    if _covered(hits, n) < least:
        return None
    begin, end = m.answer_at[item], 0
    for i, first in enumerate(at):
        if first >= tile:
            break
        while end < len(at) and at[end] < first + 2 * n:
            end += 1
        if end - i < least:
            continue
        got = _covered(hits[i:end], n)
        if got >= least:
            answer = _covered([k >> begin for k in hits[i:end]], max(0, n - begin)) / max(1, n - begin)
            if _leaks(got / n, answer):
                return lo + first, got / n, answer
    return None


def _counted_places(w, slot: np.ndarray, pos: np.ndarray, m: Model):
    """``(text, item, first word, tile)`` of the pairs of tiles that hold enough of an item's rarest words."""
    for c in m.counted:
        use = np.flatnonzero(c.deg[slot])
        if not len(use):
            continue
        # an empty tile after each text: no pair of tiles crosses texts
        base = np.concatenate(([0], np.cumsum(-(-w.counts // c.tile) + 1)))
        key = np.unique((base[w.doc[use]] + pos[use] // c.tile) << BITS | slot[use])
        tile, s = key >> BITS, key & ((1 << BITS) - 1)
        ni, n = len(c.items), c.deg[s].astype(np.int64)
        total = np.cumsum(n)
        step = max(1, min(CELLS // ni, int(base[-1])))
        for t in range(0, int(base[-1]), step):
            a, b = np.searchsorted(tile, (t, t + step + 1))
            if a == b:
                continue
            got = np.zeros((step + 1) * ni, np.int32)
            while a < b:
                e = min(b, max(a + 1, int(np.searchsorted(total, total[a] - n[a] + CELLS, side="right"))))
                k = n[a:e]
                where = np.repeat(c.at[s[a:e]] - (np.cumsum(k) - k), k) + np.arange(k.sum())
                got += np.bincount(np.repeat((tile[a:e] - t) * ni, k) + c.post[where], minlength=len(got)).astype(np.int32)
                a = e
            got = got.reshape(-1, ni)
            for x, j in zip(*np.divmod(np.flatnonzero(got[:-1] + got[1:] >= c.need), ni)):
                d = int(np.searchsorted(base, t + x, side="right")) - 1
                yield d, int(c.items[j]), int(t + x - base[d]) * c.tile, c.tile


def _cosine(m: Model, slot: np.ndarray, item: int) -> float:
    c = m.col[slot]
    v = m.fold[c[c >= 0]].sum(axis=0)
    return float((m.items[m.owner == item] @ (v / max(float(np.linalg.norm(v)), 1e-9))).max())


def _block_sums(fold: np.ndarray, c: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``np.add.reduceat(fold[c], first)`` for blocks of at most ``STRIDE`` words, the j-th words of all blocks at once.

    Floats are added in the order of ``reduceat`` (the first word last, eight of many in pairs), so cosines are the same.
    """
    n = np.diff(np.append(first, len(c)))
    rest = np.zeros((len(first), fold.shape[1]), fold.dtype)
    many = n > 8
    if many.any():
        a = [fold[c[first[many] + j]] for j in range(1, 9)]
        rest[many] = ((a[0] + a[1]) + (a[2] + a[3])) + ((a[4] + a[5]) + (a[6] + a[7]))
    for j in range(1, int(n.max())):
        more = np.flatnonzero((n > j) & ~many if j <= 8 else n > j)
        rest[more] += fold[c[first[more] + j]]
    return fold[c[first]] + rest


def _latent_places(w, slot: np.ndarray, pos: np.ndarray, m: Model) -> dict:
    """``(text, item) -> [(cosine, first word, end)]`` of the passages near an item in the subspace."""
    begin = np.flatnonzero(pos % STRIDE == 0)
    doc = w.doc[begin]
    nb = len(begin)
    end_of_doc = np.searchsorted(doc, doc, side="right")
    c = m.col[slot]
    e = m.mass[slot].astype(np.float64)
    total = np.concatenate(([0], np.cumsum(np.add.reduceat(e, begin))))
    known = np.concatenate(([0], np.cumsum(np.add.reduceat(np.where(c >= 0, e, 0), begin))))
    picked = []
    need = np.zeros(nb + max(SPANS), np.int32)
    for span in SPANS:
        stop = np.minimum(np.arange(nb) + span, end_of_doc)
        mass = known[stop] - known[:-1]
        at = np.flatnonzero((mass > 0) & (mass >= MASS * (total[stop] - total[:-1])))
        picked.append((at, stop[at]))
        for j in range(span):
            need[np.minimum(at + j, stop[at] - 1)] = 1
    best: dict = {}
    if not need.any():
        return best
    block = np.repeat(np.arange(nb), np.diff(np.append(begin, len(slot))))
    use = np.flatnonzero((c >= 0) & (need[block] > 0))
    if not len(use):
        return best
    vec = np.zeros((nb + 1, m.fold.shape[1]), np.float32)
    bu = block[use]
    first = np.flatnonzero(np.concatenate(([True], bu[1:] != bu[:-1])))
    vec[bu[first]] = _block_sums(m.fold, c[use], first)
    edges = np.append(begin, len(slot))
    for at, stop in picked:
        for i in range(0, len(at), 4096):
            a, s = at[i:i + 4096], stop[i:i + 4096]
            p = vec[a]
            for j in range(1, int((s - a).max(initial=1))):
                more = a + j < s
                p[more] += vec[a[more] + j]
            p /= np.maximum(np.linalg.norm(p, axis=1), 1e-9)[:, None]
            cos = p @ m.items.T
            for x, q in zip(*np.divmod(np.flatnonzero(cos >= COSINE), cos.shape[1])):
                best.setdefault((int(doc[a[x]]), int(m.owner[q])), []).append((float(cos[x, q]), int(edges[a[x]]), int(edges[s[x]])))
    return best


def find_leaks(texts, m: Model) -> list[list[tuple]]:
    """``(item_id, cosine, covered, answer, word)`` of the items that each text leaks."""
    w = words(texts, lower=True)
    out: list[list[tuple]] = [[] for _ in range(w.n_docs)]
    if not len(w.hash):
        return out
    slot = _slots(w.hash)
    pos = np.arange(len(w.hash)) - w.first[w.doc]
    settled = set()
    for (d, item), places in _latent_places(w, slot, pos, m).items():
        lo_doc, hi_doc = int(w.first[d]), int(w.first[d + 1])
        text = w.hash[lo_doc:hi_doc]
        done = []
        for cos, lo, hi in sorted(places, reverse=True):
            if any(l2 <= lo and hi <= h2 for l2, h2 in done):
                continue  # inside the surroundings that were compared already
            slack = len(m.item_words[item])
            done.append((lo - slack // 2, hi + slack // 2))
            covered, answer = _verify(m, item, text, lo - lo_doc, hi - lo_doc)
            if _leaks(covered, answer):
                out[d].append((m.item_ids[item], cos, covered, answer, lo - lo_doc))
                settled.add((d, item))
                break
    for d, item, lo, tile in _counted_places(w, slot, pos, m):
        if (d, item) in settled:
            continue
        lo_doc, hi_doc = int(w.first[d]), int(w.first[d + 1])
        got = _stretch(m, item, w.hash[lo_doc:hi_doc], lo, tile)
        if got:
            # the passage in the middle of the stretch
            at = got[0] + max(0, len(m.item_words[item]) - PIECE // 2)
            cos = _cosine(m, slot[lo_doc + at: min(hi_doc, lo_doc + at + PIECE)], item)
            out[d].append((m.item_ids[item], cos, got[1], got[2], at))
            settled.add((d, item))
    return out


LEAK = "array<struct<item_id:bigint,cosine:double,covered:double,answer:double,word:bigint>>"
_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("covered", pa.float64()), ("answer", pa.float64()), ("word", pa.int64())]))


def _leak_batches(model, names, text_at, into):
    def run(batches):
        for b in batches:
            for c in chunks(b, names[text_at]):
                got = find_leaks(c.column(text_at), model.value)
                rows = [[dict(zip(("item_id", "cosine", "covered", "answer", "word"), x)) for x in sorted(g)] for g in got]
                yield pa.RecordBatch.from_arrays([*[c.column(i) for i in range(len(names))], pa.array(rows, _LEAK)], [*names, into])
    return run


def flag(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, item_block: int = ITEM_BLOCK, into: str = "__leaks") -> DataFrame:
    """Columns ``keep`` of ``docs`` (default all) and ``into``, the items that each text leaks (a name that ``docs`` does not have).

    Items are taken in blocks of about ``item_block`` (what is broadcast is
    bounded by a block and the term table); each block is one more pass over
    the texts.  A null or blank text or item leaks nothing; rows are judged
    each on its own; repeated item ids are items of their own.
    """
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has a column {into!r}: name another for the leaks")
    keep = keep or docs.columns
    so_far, here = fresh([*docs.columns, into], "leaks_before", "leaks_here")
    sc = docs.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    n_blocks = max(1, math.ceil(items.count() / item_block))
    cols = list(dict.fromkeys([*keep, "text"]))
    out = docs.select(*[F.col(f"`{c}`") for c in cols])
    kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    out = out.withColumn(so_far, F.lit(None).cast(LEAK))
    stats = statistics(docs, items)
    for i in range(n_blocks):
        rows = items.where(F.expr(f"pmod(xxhash64(item_id, text), {n_blocks}) = {i}")).orderBy("item_id", "text").collect()
        model = fit(docs, [(r.item_id, r.text) for r in rows], stats=stats)
        if model is None:
            continue
        names = [*cols, so_far]
        schema = ", ".join(f"`{c}` {kinds[c]}" for c in cols) + f", `{so_far}` {LEAK}, `{here}` {LEAK}"
        out = (out.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(_leak_batches(sc.broadcast(model), names, cols.index("text"), here), schema)
               .withColumn(so_far, F.concat(F.coalesce(so_far, F.array().cast(LEAK)), here)).drop(here))
    none = F.coalesce(F.col(so_far), F.array().cast(LEAK)).alias(into)
    return out.select(*[F.col(f"`{c}`") for c in keep], none)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it leaks: ``doc_id, item_id, cosine, covered, answer, word``."""
    return (flag(docs.select("doc_id", "text"), benchmark, ["doc_id"]).select("doc_id", F.explode("__leaks").alias("l"))
            .select("doc_id", "l.item_id", "l.cosine", "l.covered", "l.answer", "l.word"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with their own columns."""
    found, = fresh(docs.columns, "leaks")
    return flag(docs, benchmark, into=found).where(F.size(found) == 0).drop(found)
