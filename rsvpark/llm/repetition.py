"""Quality rules from repetition coverage: characters inside duplicated n-grams and lines.

For several n, rolling hashes of all n-word windows of a text are sorted once;
a window equal to an earlier one of the text covers its words, and the covered
share of the text's word characters is compared with the customary limit for n.
For 2 to 4 words the most frequent n-gram alone is measured (ordinary prose
repeats short n-grams), for 5 to 10 words all duplicated ones; repeated lines
are measured likewise.  First occurrences are not counted: a text that says
something once has repeated nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rsvpark.llm.words import _CODE, _powers, chunks, mix, words

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: Largest share of word characters in the later occurrences of the most frequent n-gram.
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
#: Largest share of word characters covered by n-grams that occurred before.
DUP_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of lines, and of word characters in lines, that equal an earlier line.
LINE_LIMIT = 0.30
LINE_CHAR_LIMIT = 0.20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

SHARES = [f"top_{n}" for n in TOP_LIMITS] + [f"dup_{n}" for n in DUP_LIMITS] + ["dup_lines", "dup_line_chars"]
LIMITS = [*TOP_LIMITS.values(), *DUP_LIMITS.values(), LINE_LIMIT, LINE_CHAR_LIMIT]
_FIELDS = ([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
            ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
           + [(f"share_{s}", pa.float64()) for s in SHARES])
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, " + ", ".join(f"share_{s} double" for s in SHARES))


def _runs(key: np.ndarray):
    """Order that sorts ``key``, and start and length of its runs of equal values."""
    order = np.argsort(key)
    k = key[order]
    at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    return order, at, np.diff(np.append(at, len(k)))


def _covered(n_words: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a window of ``n`` words starting at one of ``starts``."""
    d = np.zeros(n_words + 1, np.int32)
    np.add.at(d, starts, 1) if len(starts) < 64 else np.add(d, np.bincount(starts, minlength=n_words + 1), out=d, casting="unsafe")
    e = np.bincount(starts + n, minlength=n_words + 1)[: n_words + 1]
    return np.cumsum(d - e)[:n_words] > 0


def measure(texts) -> dict[str, np.ndarray]:
    """The columns of ``SCHEMA`` for a column of texts."""
    w = words(texts)
    n_docs, nw = w.n_docs, len(w.start)
    off = w.offsets
    per_doc = lambda c: c[off[1:]] - c[off[:-1]]
    total = lambda mask: np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    cp = total((w.data & 0xC0) != 0x80)
    chars = cp[w.end] - cp[w.start]
    by_word = np.concatenate(([0], np.cumsum(chars)))
    word_chars = by_word[w.first[1:]] - by_word[w.first[:-1]]
    out = {"n_words": w.counts.astype(np.int64), "word_chars": word_chars, "n_symbols": per_doc(total(_SYMBOL[w.data]))}
    safe = np.maximum(word_chars, 1)

    # windows: hashes grow by one word per length
    h = np.zeros(nw, np.uint64)
    k = np.uint64(0xD6E8FEB86659FD93)
    salt = mix(np.arange(n_docs, dtype=np.uint64) + np.uint64(0x51ED270B))
    shares = {}
    repeat = np.zeros(n_docs, np.int64)
    for n in range(1, max([*TOP_LIMITS, *DUP_LIMITS, 3]) + 1):
        m = nw - n + 1
        if m <= 0:
            break
        h = h[:m] * k + w.hash[n - 1:]
        if n not in TOP_LIMITS and n not in DUP_LIMITS and n != 3:
            continue
        at = np.flatnonzero(w.doc[:m] == w.doc[n - 1:])
        doc = w.doc[at]
        order, run, size = _runs(mix(h[at] ^ salt[doc]))
        if n in TOP_LIMITS:
            first = order[run] if len(run) else order
            length = by_word[at[first] + n] - by_word[at[first]]
            # the most frequent n-gram of each text; of equally frequent ones the longest
            rank = np.where(size > 1, size * (1 << 32) + length, 1 << 32)
            best = np.full(n_docs, 1 << 32, np.int64)
            np.maximum.at(best, doc[first], rank)
            shares[f"top_{n}"] = np.minimum(((best >> 32) - 1) * (best & 0xFFFFFFFF) / safe, 1.0)
        if n in DUP_LIMITS or n == 3:
            if n == 3:
                c = total(_covered(nw, at[order[np.repeat(size > 1, size)]], n))
                repeat = c[w.first[1:]] - c[w.first[:-1]]
            if n in DUP_LIMITS:
                again = np.ones(len(at), bool)
                if len(run):
                    again[np.minimum.reduceat(order, run)] = False  # the earliest of each run
                c = np.concatenate(([0], np.cumsum(chars * _covered(nw, at[again], n))))
                shares[f"dup_{n}"] = (c[w.first[1:]] - c[w.first[:-1]]) / safe
    for s in SHARES:
        shares.setdefault(s, np.zeros(n_docs))

    # lines with a word, by exact bytes
    nl = np.flatnonzero(w.data == 10)
    ls = np.sort(np.concatenate((off[:-1], nl + 1)))
    doc_l = np.searchsorted(off, ls, side="right") - 1
    doc_l = np.minimum(doc_l, n_docs - 1) if n_docs else doc_l
    le = np.empty(len(ls), np.int64)
    if len(ls):
        le[:-1] = ls[1:]
        le[-1] = len(w.data)
        # a line ends before its line feed
        le -= ((le > ls) & (w.data[np.maximum(le - 1, 0)] == 10)) if len(w.data) else 0
    wf, wl = np.searchsorted(w.start, ls), np.searchsorted(w.start, le)
    has = wl > wf
    ls, le, doc_l, wf, wl = ls[has], le[has], doc_l[has], wf[has], wl[has]
    pw, ipw = _powers(len(w.data) + 1)
    s = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODE[w.data] * pw[: len(w.data)]))) if len(w.data) else np.zeros(1, np.uint64)
    lh = (s[le] - s[ls]) * ipw[ls] + mix((le - ls).astype(np.uint64))
    order, run, size = _runs(mix(lh ^ (salt[doc_l] if n_docs else lh)))
    dup = np.ones(len(ls), bool)
    if len(run):
        dup[np.minimum.reduceat(order, run)] = False  # the earliest of each run
    out["n_dup_lines"] = np.bincount(doc_l[dup], minlength=n_docs).astype(np.int64)
    lines = np.maximum(np.bincount(doc_l, minlength=n_docs), 1)
    shares["dup_lines"] = out["n_dup_lines"] / lines
    in_line = by_word[wl] - by_word[wf]
    shares["dup_line_chars"] = np.bincount(doc_l[dup], weights=in_line[dup], minlength=n_docs) / safe
    out["n_repeat_words"] = repeat
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * out["n_words"])
    ok = ~out["base_failed"]
    for name, limit in zip(SHARES, LIMITS):
        ok &= shares[name] <= limit
        out[f"share_{name}"] = shares[name]
    out["kept"] = ok
    return out


def _apply(batches):
    for b in batches:
        for c in chunks(b):
            m = measure(c.column(1))
            yield pa.RecordBatch.from_arrays([c.column(0), *[pa.array(m[n], t) for n, t in _FIELDS]],
                                             ["doc_id", *[n for n, _ in _FIELDS]])


def repetition(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, the share per rule and the verdict ``kept``.

    Rows are independent (no shuffle).  Null, empty and blank texts have no
    words and fail the base rule; repeated rows are judged each; other columns
    are ignored.
    """
    return docs.select("doc_id", "text").mapInArrow(_apply, f"doc_id long, {SCHEMA}")
