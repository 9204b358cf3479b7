"""Word kernel shared by the operators: spans and 64-bit hashes of whole Arrow columns.

Words are maximal runs of bytes other than space and 0x09-0x0D, i.e.
``[^\\x20\\x09-\\x0D]+`` (UTF-8 never uses those bytes inside a character).
All words of a chunk of texts are found and hashed with a few array passes:
``S[i] = sum b[j] * B^j`` (mod 2^64) gives every word's polynomial hash as
``(S[end] - S[start]) * B^-start``, then mixed.  Chunks hold a few megabytes of
text, so memory does not grow with the batch; a longer text is a chunk alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SMALL_CHUNK = 1 << 18      # for kernels that keep many arrays of a chunk's length at once

_B = 0x9E3779B97F4A7C15 | 1
_INV = pow(_B, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.default_rng(20240607)
_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODE_LOWER = _CODE.copy()
_CODE_LOWER[65:91] = _CODE[97:123]

_POW = np.ones(1, np.uint64)
_IPOW = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _IPOW
    if len(_POW) < n:
        for name, base in (("_POW", _B), ("_IPOW", _INV)):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            globals()[name] = np.cumprod(a)
    return _POW, _IPOW


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


@dataclass
class Words:
    """Words of ``n_docs`` texts.  ``data`` holds the texts back to back, ``offsets``
    their byte bounds; ``start``/``end`` bound each word, ``doc`` is its text and
    ``first`` the index of each text's first word (length ``n_docs + 1``)."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_buffers(texts) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column (null reads as empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    a = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(a)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset: a.offset + n + 1]
    buf = a.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def words(texts, lower: bool = False) -> Words:
    """Spans and hashes of the words of every text; ``lower`` folds A-Z."""
    data, off = text_buffers(texts)
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(data, off, z, z, np.zeros(0, np.uint64), z, np.zeros(len(off), np.int64))
    inside = ~SPACE[data]
    edge = off[(off > 0) & (off < n)]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edge] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    pw, ipw = _powers(n + 1)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum((_CODE_LOWER if lower else _CODE)[data] * pw[:n], out=s[1:])
    h = (s[end] - s[start]) * ipw[start] + (end - start).astype(np.uint64)
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(data, off, start, end, mix(h), doc, first)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES):
    """Slices of ``batch`` whose ``column`` holds about ``limit`` bytes (at least one row each)."""
    col = batch.column(batch.schema.get_field_index(column))
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    i, n = 0, len(size)
    while i < n:
        base = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(i, j - i)
        i = j


def ngram_hashes(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word index of every run of ``n`` words inside one text."""
    m = len(w.hash) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(w.doc[:m] == w.doc[n - 1:])
    k = np.uint64(0xD6E8FEB86659FD93)
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h *= k
        h += w.hash[i:i + m]
    return mix(h[at] + np.uint64(n)), at
