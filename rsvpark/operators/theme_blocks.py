"""Spherical k-means over blocks of terms (L2): neither points nor centroids move between rounds.

A block holds the postings of some terms: for every (list, term) the numbers
of the answers that have it and how often.  All answers of a term lie in one
row, so a round makes the term's centroid weights and its share of every dot
product there, from the theme numbers of the answers (a byte each, sent to all
tasks).  Only sums per answer and theme leave a task.

Answers are numbered by (list, row id).  Weights are those of ``themes.tfidf``:
``(1 + log tf) * log((1 + answers) / df)``, at length 1 per answer.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.session import bound_batches, has_jvm, materialize, release

G = ["event_id", "key"]
ANSWERS_MAX = 8_000_000     # of all lists; a task holds a few numbers per answer and theme, past that joins take over
CHUNK_TOKENS = 3_000_000    # tokens of answers whose terms are numbered together
BLOCK_BYTES = 24 << 20      # answer text whose postings make a block
ROW_POSTINGS = 1 << 18      # postings of a row of terms, unless one term has more

#: Of a row of terms: list and number of answers per term, its text (offsets, bytes), and per posting the answer's number and the count.
_POSTINGS = "gid binary, df binary, ends binary, terms binary, docs binary, tf binary"
_FIELDS = ("gid", "df", "ends", "terms", "docs", "tf")


def _packed(gid, df, terms: pa.StringArray, docs, tf) -> list[bytes]:
    """The cells of one row of terms; counts in as many bytes as they need."""
    most = int(tf.max()) if len(tf) else 0
    small = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32
    ends = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1]
    text = terms.buffers()[2][int(ends[0]):int(ends[-1])].to_pybytes()
    return [gid.astype(np.int32).tobytes(), df.astype(np.int32).tobytes(), (ends[1:] - ends[0]).tobytes(), text, docs.astype(np.int32).tobytes(), tf.astype(small).tobytes()]


def _postings(batch: pa.RecordBatch | pa.Table, i: int):
    """``(gid, df, docs, tf)`` of row ``i``."""
    cell = lambda name, kind: np.frombuffer(batch.column(name)[i].as_py(), kind)
    docs, tf = cell("docs", np.int32).astype(np.int64), batch.column("tf")[i].as_py()
    size = len(tf) // max(1, len(docs))
    return cell("gid", np.int32), cell("df", np.int32), docs, np.frombuffer(tf, {1: np.uint8, 2: np.uint16, 4: np.uint32}.get(size, np.uint8))


def _texts(batch: pa.RecordBatch | pa.Table, i: int) -> pa.StringArray:
    ends = np.frombuffer(batch.column("ends")[i].as_py(), np.int32)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets.tobytes()), pa.py_buffer(batch.column("terms")[i].as_py()))


@dataclass
class Numbers:
    """Lists and answers by number: list ``g`` has the answers ``start[g] .. start[g + 1]``, row ids ascending."""

    lists: dict[tuple[str, str], int]
    nd: np.ndarray
    start: np.ndarray
    rows: np.ndarray

    def of(self, gid: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.int64)
        for g in np.unique(gid):
            here = gid == g
            out[here] = self.start[g] + np.searchsorted(self.rows[self.start[g]:self.start[g + 1]], rows[here])
        return out

    def list_of(self, docs: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, docs, "right") - 1


def _chunks(numbers, blocks: int):
    """Answers with their tokens to rows of terms, one per block and chunk of answers."""

    def packed(docs: list[np.ndarray], tokens: list[pa.Array]):
        n: Numbers = numbers.value
        coded = pa.concat_arrays(tokens).dictionary_encode()
        words = coded.dictionary
        block = np.array([zlib.crc32(w.encode()) % blocks for w in words.to_pylist()], np.int64)
        order = np.argsort(block, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        keys = place[np.asarray(coded.indices)] << 32 | np.concatenate(docs)
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        tf = np.diff(np.concatenate([first, [len(keys)]]))
        word, doc = keys[first] >> 32, keys[first] & 0xFFFFFFFF
        del keys
        gid = n.list_of(doc)
        head = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (gid[1:] != gid[:-1])]))
        df = np.diff(np.concatenate([head, [len(word)]]))
        words = words.take(pa.array(order)).take(pa.array(word[head]))
        at = block[order][word[head]]
        cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
        rows = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            p, q = head[a], head[b] if b < len(head) else len(word)
            rows.append([int(at[a]), *_packed(gid[head[a:b]], df[a:b], words.slice(a, b - a), doc[p:q], tf[p:q])])
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int32()), *[pa.array([x], pa.binary()) for x in row[1:]]], names=["block", *_FIELDS])

    def run(batches):
        docs, tokens, n = [], [], 0
        for batch in batches:
            t = batch.column("tokens")
            size = np.diff(np.asarray(t.offsets))
            lists = pa.StructArray.from_arrays([batch.column(c) for c in G], names=G)
            gid = np.array([numbers.value.lists[x["event_id"], x["key"]] for x in lists.to_pylist()], np.int64)
            doc = numbers.value.of(gid, np.asarray(batch.column("row_id")))
            at = 0
            while at < len(doc):     # a batch may hold more than a chunk
                upto = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), CHUNK_TOKENS - n, "right")) + at)
                docs.append(np.repeat(doc[at:upto], size[at:upto]))
                tokens.append(t.slice(at, upto - at).flatten())
                n += len(docs[-1])
                at = upto
                if n >= CHUNK_TOKENS:
                    yield from packed(docs, tokens)
                    docs, tokens, n = [], [], 0
        if n:
            yield from packed(docs, tokens)

    return run


def _block():
    """Rows of a block from all chunks to rows of whole terms; an answer that comes in several parts is one."""

    def run(table):
        texts, gids, dfs, docs, tfs = [], [], [], [], []
        for i in range(table.num_rows):
            g, df, d, tf = _postings(table, i)
            texts.append(_texts(table, i))
            gids.append(g)
            dfs.append(df)
            docs.append(d)
            tfs.append(tf)
        coded = pa.concat_arrays(texts).dictionary_encode()
        words = coded.dictionary
        # a row's terms are of few lists, and so its answers lie close together
        pairs, pair = np.unique(np.concatenate(gids).astype(np.int64) * len(words) + np.asarray(coded.indices), return_inverse=True)
        keys = np.repeat(pair, np.concatenate(dfs)) << 32 | np.concatenate(docs)
        order = np.argsort(keys, kind="stable")
        keys, tf = keys[order], np.concatenate(tfs).astype(np.int64)[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        tf = np.add.reduceat(tf, first)
        at, doc = keys[first] >> 32, keys[first] & 0xFFFFFFFF
        head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        df = np.diff(np.concatenate([head, [len(at)]]))
        gid, word = pairs // len(words), pairs % len(words)
        rows, a = [], 0
        while a < len(head):
            b = max(a + 1, int(np.searchsorted(head, head[a] + ROW_POSTINGS)))
            p, q = head[a], head[b] if b < len(head) else len(at)
            rows.append(_packed(gid[a:b], df[a:b], words.take(pa.array(word[a:b])), doc[p:q], tf[p:q]))
            a = b
        return pa.Table.from_arrays([pa.array(x, pa.binary()) for x in zip(*rows, strict=True)], names=_FIELDS)

    return run


def _weights(nd: np.ndarray, gid, df, tf):
    """``(idf per term, 1 + log tf per posting, term's place per posting)``."""
    most = int(tf.max()) if len(tf) else 0
    x = (1 + np.log(np.arange(1, most + 1))).take(tf.astype(np.int64) - 1) if most < 1 << 16 else 1 + np.log(tf.astype(float))
    return np.log((1 + nd[gid]) / df), x, np.repeat(np.arange(len(df)), df)


def _add(into: np.ndarray, docs: np.ndarray, x: np.ndarray) -> None:
    if 2 * len(docs) > len(into):
        into += np.bincount(docs, x, len(into))
    else:
        np.add.at(into, docs, x)


def _centroids(nd, inv, theme, k: int, gid, df, docs, tf):
    """``(weights of the terms in each theme, idf, place, weight of each posting but for the idf)``; ``docs`` as int64."""
    idf, x, term = _weights(nd, gid, df, tf)
    x *= inv.take(docs)
    c = np.bincount(term * (k + 1) + theme.take(docs), x, len(df) * (k + 1)).reshape(-1, k + 1)[:, :k] * idf[:, None]
    return c, idf, term, x


def _ranges(numbers: Numbers, parts: int) -> list[tuple[int, int]]:
    size = max(1, -(-len(numbers.rows) // parts))
    return [(a, min(a + size, len(numbers.rows))) for a in range(0, len(numbers.rows), size)]


def _shares(numbers, inv, themes, k: int, parts: int):
    """Rows of terms to ``(range, task, sums, norms)``: of each range of answers the dot products with the themes'
    centroids as far as this task's terms go, and of its lists the centroids' squares.  ``themes`` are the answers'
    themes and which answers may leave theirs; the others have no sums.  Without themes (``k`` 0): the squares of the
    answers' lengths."""

    def run(batches):
        n = numbers.value
        sums = np.zeros((max(1, k), len(n.rows)))
        norms = np.zeros((len(n.nd), max(1, k)))
        for batch in batches:
            for i in range(batch.num_rows):
                gid, df, docs, tf = _postings(batch, i)
                lo, hi = (int(docs.min()), int(docs.max()) + 1) if len(docs) else (0, 0)
                if not k:
                    idf, x, term = _weights(n.nd, gid, df, tf)
                    x *= idf.take(term)
                    _add(sums[0, lo:hi], docs - lo, x * x)
                    continue
                theme, open_ = themes.value
                c, idf, term, x = _centroids(n.nd, inv.value, theme, k, gid, df, docs, tf)
                for j in range(k):
                    norms[:, j] += np.bincount(gid, c[:, j] ** 2, len(n.nd))
                c *= idf[:, None]
                if open_ is not None:
                    keep = np.flatnonzero(open_.take(docs))
                    docs, term, x = docs.take(keep), term.take(keep), x.take(keep)
                docs -= lo
                for j in range(k):
                    _add(sums[j, lo:hi], docs, x * c[:, j].take(term))
        task = TaskContext.get().partitionId()
        for r, (a, b) in enumerate(_ranges(n, parts)):
            g = n.list_of(np.array([a, b - 1]))
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([task], pa.int32()),
                                              pa.array([sums[:, a:b].tobytes()], pa.binary()), pa.array([norms[g[0]:g[1] + 1].tobytes()], pa.binary())],
                                             names=["range", "task", "sums", "norms"])

    return run


def _summed(table: pa.Table, name: str) -> np.ndarray:
    out = 0
    for i in np.argsort(np.asarray(table.column("task")), kind="stable"):     # in the same order in every run
        out = out + np.frombuffer(table.column(name)[int(i)].as_py())
    return out


def _lengths(table):
    return pa.table({"range": pa.array([table.column("range")[0].as_py()], pa.int32()), "squares": pa.array([_summed(table, "sums").tobytes()], pa.binary())})


def _best(numbers, themes, first: bool, k: int, parts: int, gain: float):
    """Best theme per answer by cosine similarity; an answer leaves its theme only for one that scores ``gain`` more.

    ``gaps`` is by how much the best score is above the next.
    """

    def run(table):
        n = numbers.value
        r = table.column("range")[0].as_py()
        a, b = _ranges(n, parts)[r]
        gid = n.list_of(np.arange(a, b))
        sums = _summed(table, "sums").reshape(k, -1)
        norm = np.sqrt(_summed(table, "norms").reshape(-1, k))[gid - gid[0]].T
        score = np.where(sums > 0, sums / np.where(norm > 0, norm, 1), -np.inf)     # without a common term: none
        was, open_ = (x if x is None else x[a:b] for x in themes.value)
        rank = score.copy()
        if not first:
            in_one = np.flatnonzero(was < k)
            rank[was[in_one], in_one] += gain
        best = rank.argmax(0)
        top = score[best, np.arange(b - a)]
        now = np.where(np.isfinite(top), best, k).astype(np.uint8)
        if open_ is not None:
            now = np.where(open_, now, was)
        rank[best, np.arange(b - a)] = -np.inf
        gaps = np.where(now < k, top - np.maximum(rank.max(0), 0) - gain, 0)
        cells = [now, np.where(np.isfinite(top), top, 0.0), gaps.astype(np.float32), norm[:, np.flatnonzero(np.diff(gid, prepend=-1))].T]
        return pa.table({"range": pa.array([r], pa.int32()), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(("themes", "scores", "gaps", "norms"), cells, strict=True)},
                         "moved": pa.array([int((now != was).sum())], pa.int64())})

    return run


def _drift(gid, lists: int, k: int, was, now, norms) -> np.ndarray:
    """Of each list, how far a centroid at most turned, as a vector of length 1: of two vectors at length 1 the
    difference is at most twice that of the vectors by the sum of their lengths, and every answer that moved
    changes a centroid by a vector of length 1."""
    moved = np.flatnonzero(was != now)
    turned = np.zeros((lists, k + 1))
    for x in (was, now):
        turned += np.bincount(gid[moved] * (k + 1) + x[moved], minlength=lists * (k + 1)).reshape(lists, k + 1)
    m = turned[:, :k]
    return np.where(m > 0, np.minimum(1.5, 2 * m / np.maximum(2 * norms - m, 1e-9)), 0).max(1)


def _answers_of(numbers, k: int, parts: int):
    """``(gid, row_id, cid, score)`` of the answers in a theme."""

    def run(batches):
        n = numbers.value
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = _ranges(n, parts)[batch.column("range")[i].as_py()]
                theme, score = np.frombuffer(batch.column("themes")[i].as_py(), np.uint8), np.frombuffer(batch.column("scores")[i].as_py())
                in_one = np.flatnonzero(theme < k)
                for at in range(0, len(in_one), 1 << 16):
                    x = in_one[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(n.list_of(a + x), pa.int32()), pa.array(n.rows[a + x]), pa.array(theme[x], pa.int64()), pa.array(score[x])],
                                                     names=["gid", "row_id", "cid", "score"])

    return run


def _heaviest(gid, cid, w, most: int) -> np.ndarray:
    """Places of the ``most`` largest weights of each list's theme, and of all that equal the last of them."""
    order = np.lexsort((-w, cid, gid))
    g, c, v = gid[order], cid[order], w[order]
    head = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])]) if len(g) else np.zeros(0, bool)
    start = np.flatnonzero(head)
    mine = np.cumsum(head) - 1
    last = np.minimum(start + most - 1, np.concatenate([start[1:], [len(g)]]) - 1)
    return order[v >= v[last[mine]]] if len(g) else order


def _title_terms(numbers, inv, themes, k: int, most: int):
    """Rows of terms to ``(gid, cid, term, tw)``, the candidates for each theme's title."""

    def cut(parts):
        gid, cid, w = (np.concatenate([p[i] for p in parts]) for i in range(3))
        terms = pa.concat_arrays([p[3] for p in parts])
        keep = _heaviest(gid, cid, w, most)
        return gid[keep], cid[keep], w[keep], terms.take(pa.array(keep))

    def run(batches):
        held = []
        for batch in batches:
            for i in range(batch.num_rows):
                gid, df, docs, tf = _postings(batch, i)
                c = _centroids(numbers.value.nd, inv.value, themes.value[0], k, gid, df, docs, tf)[0]
                at, cid = np.nonzero(c > 0)
                w = c[at, cid] * c[at, cid] / c.sum(1)[at]
                keep = _heaviest(gid[at], cid, w, most)
                held.append((gid[at][keep], cid[keep], w[keep], _texts(batch, i).take(pa.array(at[keep]))))
                if len(held) >= 32:
                    held = [cut(held)]
        if held:
            gid, cid, w, terms = cut(held)
            yield pa.RecordBatch.from_arrays([pa.array(gid, pa.int32()), pa.array(cid, pa.int64()), terms, pa.array(w)], names=["gid", "cid", "term", "tw"])

    return run


def usable(ids: DataFrame) -> bool:
    """Whether the answers can be numbered in the driver."""
    return has_jvm(ids.sparkSession) and dict(ids.dtypes)["row_id"] in ("bigint", "int") and ids.count() <= ANSWERS_MAX


def kmeans(answers: DataFrame, ids: DataFrame, tokens: str, k: int, iterations: int | None, gain: float, most: int) -> tuple[DataFrame, DataFrame]:
    """``(assignments(g, row_id, cid, score), candidates(g, cid, term, tw))`` of all lists at once.

    ``ids(g, row_id, worded, size)`` are the written ids of ``answers``.  Rounds and ``iterations`` as in
    ``themes.kmeans``; the candidates have the ``most`` heaviest terms of each theme, and more.
    """
    spark = answers.sparkSession
    sc = spark.sparkContext
    bound_batches(spark)
    named = ids.where("event_id is not null and key is not null")
    lists = sorted(named.groupBy(*G).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).collect())
    gids = F.broadcast(spark.createDataFrame([(r.event_id, r.key, i) for i, r in enumerate(lists)], "event_id string, key string, gid int"))
    mine = named.where("row_id is not null").join(gids, G)
    got = mine.select("gid", F.col("row_id").cast("bigint")).distinct().toArrow()
    gid, rows = (np.asarray(got.column(i).combine_chunks()) for i in range(2))
    order = np.lexsort((rows, gid))
    gid, rows = gid[order], rows[order]
    numbers = Numbers({(r.event_id, r.key): i for i, r in enumerate(lists)}, np.array([r.n for r in lists], float), np.searchsorted(gid, np.arange(len(lists) + 1)), rows)
    seeds = (mine.where("worded").groupBy("gid", F.pmod(F.xxhash64("row_id"), F.lit(k)).alias("cid"))
             .agg(F.min_by("row_id", F.xxhash64(F.lit("seed"), "row_id")).alias("row_id")).collect())
    theme = np.full(len(rows), k, np.uint8)
    theme[numbers.of(np.array([s.gid for s in seeds], np.int64), np.array([s.row_id for s in seeds], np.int64))] = [s.cid for s in seeds]

    known = sc.broadcast(numbers)
    cores = sc.defaultParallelism
    size = sum(r["size"] or 0 for r in lists)
    blocks = int(max(cores, -(-size // BLOCK_BYTES)))
    tok = (answers.where("event_id is not null and key is not null and row_id is not null")
           .select(*G, F.col("row_id").cast("bigint").alias("row_id"), F.regexp_extract_all(F.lower("answer"), F.lit(tokens), 0).alias("tokens")))
    post = materialize(tok.mapInArrow(_chunks(known, blocks), f"block int, {_POSTINGS}").groupBy("block").applyInArrow(_block(), _POSTINGS), "postings")
    nums = post.select("gid", "df", "docs", "tf")
    # as many tasks as their sums stay below the postings they read
    tasks = int(max(1, min(cores, size // 100 // max(1, len(rows)))))
    parts = max(cores, -(-len(rows) // (1 << 18)))
    share_row = "range int, task int, sums binary, norms binary"

    def summed(inv, theme, k_or_none: int, by, schema: str, tag: str) -> DataFrame:
        shares = nums.coalesce(tasks).mapInArrow(_shares(known, inv, theme, k_or_none, parts), share_row)
        return materialize(shares.groupBy("range").applyInArrow(by, schema), tag)

    squares = summed(None, None, 0, _lengths, "range int, squares binary", "lengths")
    inv = np.zeros(len(rows))
    ranges = _ranges(numbers, parts)
    for r in squares.collect():
        inv[slice(*ranges[r.range])] = np.frombuffer(r.squares)
    inv = sc.broadcast(np.divide(1, np.sqrt(inv), out=np.zeros(len(rows)), where=inv > 0))
    release(squares)
    n, before = 0, None
    open_, slack, drift = None, np.zeros(len(rows)), np.zeros(len(lists))
    while True:
        sent = sc.broadcast((theme, open_))
        out = summed(inv, sent, k, _best(known, sent, n == 0, k, parts, gain), "range int, themes binary, scores binary, gaps binary, norms binary, moved bigint", "assign")
        new, gaps, norms = np.full(len(rows), k, np.uint8), np.zeros(len(rows)), np.zeros((len(lists), k))
        for r in out.drop("scores").collect():
            a, b = ranges[r.range]
            new[a:b], gaps[a:b] = np.frombuffer(r.themes, np.uint8), np.frombuffer(r.gaps, np.float32)
            norms[np.unique(gid[a:b])] = np.frombuffer(r.norms).reshape(-1, k)
        release(before)
        n += 1
        whole, same = open_ is None, np.array_equal(new, theme)
        if n > 1 and same and whole or iterations is not None and n > iterations:
            break
        if n > 1 and same or iterations is not None:
            open_ = None     # the last round is for all answers, and so has all scores
        else:
            # an answer may leave its theme only when its gap is no more than what the centroids have turned since
            seen = slice(None) if whole else open_
            slack[seen] = gaps[seen] + 2 * drift[gid[seen]]
            drift += _drift(gid, len(lists), k, theme, new, norms)
            open_ = (new == k) | (slack <= 2 * drift[gid] + 1e-5)
        sent.destroy()
        theme, before = new, out
    assign = out.mapInArrow(_answers_of(known, k, parts), "gid int, row_id bigint, cid bigint, score double").join(gids, "gid").select(*G, "row_id", "cid", "score")
    heavy = materialize(post.mapInArrow(_title_terms(known, inv, sent, k, most), "gid int, cid bigint, term string, tw double").join(gids, "gid").select(*G, "cid", "term", "tw"), "title-terms")
    return assign, heavy
