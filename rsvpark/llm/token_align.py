"""Cross-tokenizer alignment by lockstep vectorised merging.

A text is encoded by a byte-level BPE (A) and by a piece model (B); both cut the
same bytes.  The merge walks two pointers per lane, one over A tokens and one
over B tokens, for all lanes of a batch at once: each step links the two current
tokens, notes a cut where both end on one byte, and moves the pointer (or both)
whose token ends first.  Lanes that are done are compacted away.  A lane is a
document; a long one has a further lane every ``LANE`` A tokens, so that one long
text does not hold up the batch.

How often an id pair is linked is counted over the corpus without moving links.
Documents are packed into chunks of about ``CHUNK_BYTES`` of text; a chunk's row
keeps its distinct pairs with counts and, compressed, each document's pairs as
positions in that list.  Only the distinct pairs of chunks are shuffled, summed
and sent back to their chunk, so what a task holds is bounded by a chunk.

Defined cases.  A null or empty text, and one whose A or B tokens don't spell
space + text (such as U+2581, which B turns into a space), has no tokens: zeros
and an empty string.  A null ``doc_id`` is kept; repeated rows count each time.
An empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.llm.words import chunks, text_buffers
from rsvpark.session import materialize

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
LANE = 256
BATCH_BYTES = 1 << 19
CHUNK_BYTES = 16 << 20

# How a byte-level BPE file splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
CHUNK_DDL = (f"chunk long, docs array<struct<{DOC.replace(' long', ':long').replace(' string', ':string')}>>, pairs array<long>, counts array<long>, "
             "n_held long, held binary, per_doc array<long>")


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of every id: those of ``i`` are ``data[start[i]:start[i + 1]]``."""

    data: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, entries: list[bytes]) -> Vocabulary:
        return cls(np.frombuffer(b"".join(entries), np.uint8), np.concatenate(([0], np.cumsum([len(e) for e in entries]))).astype(np.int64))

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.start[ids + 1] - self.start[ids]

    def spell(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths(ids)
        end = np.cumsum(n)
        return self.data[np.repeat(self.start[ids] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself where printable, else the next from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _byte_encoder(file: str):
    """The encoder and the entries' bytes of a byte-level BPE file.

    Where ids are the merges' order, the same merges run in tiktoken, several times faster with the same
    ids (tested); any other file goes through the tokenizers library.
    """
    with open(file, encoding="utf-8") as f:
        told = json.load(f)
    letters = byte_letters()
    vocab = {**told["model"]["vocab"], **{t["content"]: t["id"] for t in told["added_tokens"]}}
    entries = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        entries[i] = bytes(letters[c] for c in token)
    special = {t["id"] for t in told["added_tokens"]}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in told["model"]["merges"]]
    plain = (told["normalizer"] is None and told["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
             and not told["model"].get("ignore_merges") and special == {len(entries) - 1}
             and all(vocab[m] == 256 + i for i, m in enumerate(merges)) and len(merges) == len(entries) - 257)
    if plain:
        import tiktoken

        bpe = tiktoken.Encoding(file, pat_str=SPLIT, mergeable_ranks={e: i for i, e in enumerate(entries) if i not in special}, special_tokens={})
        return (lambda texts: [bpe.encode_ordinary(" " + x) for x in texts]), entries
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(file)
    a.encode_special_tokens = True
    return (lambda texts: [e.ids for e in a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]), entries


@functools.lru_cache(maxsize=4)
def encoders(folder: str):
    """``(encode A, vocabulary A, encode B, vocabulary B)``; loaded once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece

    encode_a, entries = _byte_encoder(f"{folder}/{BYTE_BPE}")
    b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECE_BPE}")
    pieces = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
              for i in range(b.get_piece_size())]

    return encode_a, Vocabulary.of(entries), lambda texts: b.encode(texts, num_threads=1), Vocabulary.of(pieces)


def merge(a_end: np.ndarray, b_end: np.ndarray, first_a: np.ndarray, lane: int = LANE):
    """Links and cuts of documents laid out one after another.

    ``a_end`` and ``b_end`` are the tokens' end bytes, ``first_a`` the documents' first A tokens.
    Gives the links as A and B token numbers (by A, then B) and, for both sides, which tokens end on a cut.
    """
    n = len(a_end)
    cut_a, cut_b = np.zeros(n, bool), np.zeros(len(b_end), bool)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, cut_a, cut_b
    more = np.arange(n) - np.repeat(first_a, np.diff(np.append(first_a, n)))
    a = np.flatnonzero(more % lane == 0)
    stop = np.append(a[1:], n)
    b = np.searchsorted(b_end, np.where(a > 0, a_end[a - 1], 0), side="right")
    links_a, links_b = [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        ends_a, ends_b = a_end[a], b_end[b]
        cut = ends_a == ends_b
        cut_a[a[cut]] = True
        cut_b[b[cut]] = True
        a, b = a + (ends_a <= ends_b), b + (ends_b <= ends_a)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    links_a, links_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.lexsort((links_b, links_a))
    return links_a[order], links_b[order], cut_a, cut_b


@dataclass
class Aligned:
    """``n`` texts: token ids of both sides with each text's first token (length ``n + 1``),
    links as token numbers, and which tokens end on a cut."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray

    @property
    def doc_of_link(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first_a) - 1), np.diff(self.first_a))[self.link_a]


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    flat = np.empty(first[-1], np.int64)
    for x, i in zip(lists, first):
        flat[i:i + len(x)] = x
    return flat, first


def _spelt(ids, first, vocabulary: Vocabulary, want: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts' tokens spell ``want[at[i]:at[i + 1]]``."""
    size = np.concatenate(([0], np.cumsum(vocabulary.lengths(ids))))[first]
    ok = np.diff(size) == np.diff(at)
    doc = np.repeat(np.arange(len(ok)), np.diff(at))
    here = want[ok[doc]]
    token_doc = np.repeat(np.arange(len(ok)), np.diff(first))
    wrong = vocabulary.spell(ids[ok[token_doc]]) != here
    ok[doc[ok[doc]][wrong]] = False
    return ok


def align_texts(texts, folder: str = TOKENIZERS) -> Aligned:
    """Tokens, links and cuts of an Arrow column of texts."""
    encode_a, vocab_a, encode_b, vocab_b = encoders(folder)
    data, off = text_buffers(texts)
    n = len(off) - 1
    said = [x or "" for x in texts.to_pylist()]
    lists_a, lists_b = encode_a(said), encode_b(said)
    for i, x in enumerate(said):
        if not x:
            lists_a[i] = lists_b[i] = []
    filled = np.diff(off) > 0
    at = np.concatenate(([0], np.cumsum(np.where(filled, np.diff(off) + 1, 0))))
    want = np.empty(at[-1], np.uint8)
    space = np.zeros(at[-1], bool)
    space[at[:-1][filled]] = True
    want[space], want[~space] = 0x20, data
    a, first_a = _flat(lists_a)
    b, first_b = _flat(lists_b)
    ok = _spelt(a, first_a, vocab_a, want, at) & _spelt(b, first_b, vocab_b, want, at)
    if not ok.all():
        a, b = a[np.repeat(ok, np.diff(first_a))], b[np.repeat(ok, np.diff(first_b))]
        first_a = np.concatenate(([0], np.cumsum(np.diff(first_a) * ok)))
        first_b = np.concatenate(([0], np.cumsum(np.diff(first_b) * ok)))
    starts = np.unique(first_a[:-1][np.diff(first_a) > 0])
    link_a, link_b, cut_a, cut_b = merge(np.cumsum(vocab_a.lengths(a)), np.cumsum(vocab_b.lengths(b)), starts)
    return Aligned(a, b, first_a, first_b, link_a, link_b, cut_a, cut_b)


@functools.lru_cache(maxsize=4)
def _digits(n: int) -> np.ndarray:
    """Decimal digits of 0 .. n-1, right-aligned, zero bytes before."""
    return np.frombuffer(b"".join(str(i).encode().rjust(len(str(n)), b"\0") for i in range(n)), np.uint8).reshape(n, -1)


def group_strings(x: Aligned, n_ids: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every text."""
    na, nb = len(x.a), len(x.b)
    digits = _digits(n_ids)
    group_a = np.cumsum(x.cut_a) - x.cut_a
    group_b = np.cumsum(x.cut_b) - x.cut_b
    ends_a, ends_b = np.flatnonzero(x.cut_a) + 1, np.flatnonzero(x.cut_b) + 1
    starts_b = np.concatenate(([0], ends_b))
    place_a = np.arange(na) + starts_b[group_a]
    place_b = np.arange(nb) + (ends_a[group_b] if nb else 0)
    out = np.zeros((na + nb, digits.shape[1] + 1), np.uint8)
    out[place_a, :-1], out[place_b, :-1] = digits[x.a], digits[x.b]
    out[place_a, -1] = np.where(x.cut_a, ord("|"), ord(","))
    out[place_b, -1] = np.where(x.cut_b, ord(";"), ord(","))
    keep = out != 0
    size = np.concatenate(([0], np.cumsum(keep.sum(1))))
    flat = memoryview(out[keep])
    bounds = size[x.first_a + x.first_b]
    return [bytes(flat[s:max(s, e - 1)]) for s, e in zip(bounds[:-1], bounds[1:])]


def alignments(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_cuts, b_cuts, link_a, link_b``: token ids, the numbers of tokens up to
    each cut, and all links as token numbers of the document."""
    names = ["a_ids", "b_ids", "a_cuts", "b_cuts", "link_a", "link_b"]

    def run(batches):
        for batch in batches:
            for part in chunks(batch, limit=BATCH_BYTES):
                x = align_texts(part.column(1), folder)
                n = part.num_rows
                link = np.searchsorted(x.link_a, x.first_a)
                ca, cb = np.flatnonzero(x.cut_a) + 1, np.flatnonzero(x.cut_b) + 1
                at_a, at_b = np.searchsorted(ca, x.first_a, side="right"), np.searchsorted(cb, x.first_b, side="right")
                at_a[0] = at_b[0] = 0
                da, db = np.repeat(x.first_a[:-1], np.diff(at_a)), np.repeat(x.first_b[:-1], np.diff(at_b))
                la, lb = np.repeat(x.first_a[:-1], np.diff(link)), np.repeat(x.first_b[:-1], np.diff(link))
                lists = [(x.a, x.first_a), (x.b, x.first_b), (ca - da, at_a), (cb - db, at_b), (x.link_a - la, link), (x.link_b - lb, link)]
                arrays = [pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, pa.int32())) for v, o in lists]
                assert all(len(y) == n for y in arrays)
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} array<int>" for c in names))


def _chunk_rows(docs: DataFrame, folder: str, chunk_bytes: int) -> DataFrame:
    """Documents in chunks: their measures, the chunk's distinct id pairs with counts, and each document's pairs."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch, limit=BATCH_BYTES):
                held.append(_measure(part, folder))
                size += int(part.column(1).nbytes)
                if size >= chunk_bytes:
                    yield _chunk((task << 32) | number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _chunk((task << 32) | number, held)

    return docs.select("doc_id", "text").mapInArrow(run, CHUNK_DDL)


def _measure(part: pa.RecordBatch, folder: str):
    x = align_texts(part.column(1), folder)
    _, vocab_a, _, vocab_b = encoders(folder)
    n, n_b = part.num_rows, len(vocab_b.start) - 1
    doc = x.doc_of_link
    code = x.a[x.link_a] * n_b + x.b[x.link_b]
    # distinct pairs of each document with counts, sorted by document and pair
    key, count = np.unique(doc * (n_b * (len(vocab_a.start) - 1)) + code, return_counts=True)
    of, code = np.divmod(key, n_b * (len(vocab_a.start) - 1))
    cuts = np.concatenate(([0], np.cumsum(x.cut_a)))[x.first_a]
    strings = group_strings(x, max(len(vocab_a.start), len(vocab_b.start)) - 1)
    shas = [hashlib.sha256(s).hexdigest() if s else "" for s in strings]
    stats = [np.diff(x.first_a), np.diff(x.first_b), np.diff(cuts), np.bincount(doc, minlength=n)]
    return part.column(0), stats, shas, np.bincount(of, minlength=n), code, count


def _pack(v: np.ndarray) -> bytes:
    return pa.compress(v.astype(np.int32).tobytes(), codec="zstd", asbytes=True)


def _chunk(chunk: int, held) -> pa.RecordBatch:
    code, count = np.concatenate([h[4] for h in held]), np.concatenate([h[5] for h in held])
    pairs, place = np.unique(code, return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, place, count)
    docs = pa.StructArray.from_arrays(
        [pa.concat_arrays([h[0] for h in held]), *[pa.array(np.concatenate([h[1][k] for h in held]), pa.int64()) for k in range(4)],
         pa.array([s for h in held for s in h[2]], pa.string())], names=[f.split()[0] for f in DOC.split(", ")])
    # a document's places ascend, so their differences are small numbers
    blob = _pack(np.concatenate([np.diff(place, prepend=0), count]))
    one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), one(docs), one(pa.array(pairs, pa.int64())), one(pa.array(counts, pa.int64())),
         pa.array([len(code)], pa.int64()), pa.array([blob], pa.binary()), one(pa.array(np.concatenate([h[3] for h in held]), pa.int64()))],
        names=["chunk", "docs", "pairs", "counts", "n_held", "held", "per_doc"])


def pair_counts(chunk_rows: DataFrame, n_b: int) -> DataFrame:
    """``pair, total, best``: links of every id pair in the corpus; ``best`` where no pair of the same B id has more."""
    total = (chunk_rows.select(F.inline(F.arrays_zip("pairs", "counts"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("total")))
    b = F.col("pair") % n_b
    # one row per B id: never more rows than B has ids
    best = total.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    return total.withColumn("b", b).join(F.broadcast(best), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _score(batches):
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            docs, n, found = (batch.column(k) for k in ("docs", "n_held", "found"))
            n = n[i].as_py()
            raw = np.frombuffer(pa.decompress(batch.column("held")[i].as_buffer(), 8 * n, codec="zstd"), np.int32)
            place, count = np.cumsum(raw[:n], dtype=np.int64), raw[n:].astype(np.int64)
            got = found[i].values
            pair = got.field("pair").to_numpy(zero_copy_only=False) if got is not None else np.zeros(0, np.int64)
            order = np.argsort(pair)
            total = got.field("total").to_numpy(zero_copy_only=False)[order] if got is not None else pair
            best = got.field("best").to_numpy(zero_copy_only=False)[order] if got is not None else pair
            per = batch.column("per_doc")[i].values.to_numpy()
            at = np.concatenate(([0], np.cumsum(per)))
            sums = [np.concatenate(([0], np.cumsum(count * v[place]))) for v in (best.astype(np.int64), total)]
            d = docs[i].values
            cols = {k: d.field(j) for j, k in enumerate(f.split()[0] for f in DOC.split(", "))}
            cols |= {k: pa.array(s[at[1:]] - s[at[:-1]], pa.int64()) for k, s in zip(("n_best", "count_sum"), sums)}
            out.append(pa.RecordBatch.from_pydict(cols))
        yield from out


def align(docs: DataFrame, folder: str = TOKENIZERS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` of every document."""
    rows = materialize(_chunk_rows(docs, folder, chunk_bytes), "align-chunks")
    n_b = _vocabulary_b(folder)
    wanted = rows.select("chunk", F.explode("pairs").alias("pair"))
    # a chunk's pairs meet again: as many as the chunk's own list holds
    found = wanted.join(pair_counts(rows, n_b), "pair").groupBy("chunk").agg(F.collect_list(F.struct("pair", "total", "best")).alias("found"))
    return rows.join(found, "chunk", "left").select("docs", "n_held", "held", "per_doc", "found").mapInArrow(_score, f"{DOC}, n_best long, count_sum long")


def _vocabulary_b(folder: str) -> int:
    return len(encoders(folder)[3].start) - 1
