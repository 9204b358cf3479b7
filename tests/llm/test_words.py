"""The word kernel against a regular expression."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rsvpark.llm import words as W
from tests.llm.brute import fold, word_list

TEXT = st.one_of(st.none(), st.text(alphabet="aB é\t\n\x0b\x0c\r   z漢", max_size=40))


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_spans_match_the_regex(texts):
    w = W.words(pa.array(texts, pa.string()))
    got = [[] for _ in texts]
    for a, b, d in zip(w.start, w.end, w.doc):
        got[d].append(bytes(w.data[a:b]).decode())
    assert got == [word_list(t) for t in texts]
    assert w.counts.tolist() == [len(g) for g in got]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=12))
def test_equal_words_have_equal_hashes_and_others_differ(texts):
    for lower in (False, True):
        w = W.words(pa.array(texts, pa.string()), lower=lower)
        by = {}
        for t in texts:
            for x in word_list(fold(t) if lower else t):
                by.setdefault(x, set())
        flat = [x for t in texts for x in word_list(fold(t) if lower else t)]
        for x, h in zip(flat, w.hash.tolist()):
            by[x].add(h)
        assert all(len(v) == 1 for v in by.values())
        assert len({h for v in by.values() for h in v}) == len(by)


def test_slices_and_chunks_cover_every_row():
    texts = ["a b"] * 5 + ["x" * 100_000] + [None, ""] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["i", "text"])
    parts = list(W.chunks(batch, limit=1000))
    assert sum(p.num_rows for p in parts) == len(texts) and len(parts) > 2
    assert np.concatenate([W.words(p.column(1)).counts for p in parts]).tolist() == [len(word_list(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8), st.integers(1, 6))
def test_ngrams_stay_inside_texts(texts, n):
    w = W.words(pa.array(texts, pa.string()))
    h, at = W.ngram_hashes(w, n)
    grams = [tuple(x[i:i + n]) for x in map(word_list, texts) for i in range(len(x) - n + 1)]
    assert len(h) == len(grams)
    assert len(set(h.tolist())) == len(set(grams))
