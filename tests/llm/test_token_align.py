"""Cross-tokenizer alignment against plain loops."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rsvpark.llm import token_align as T
from rsvpark.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import DOC_SCHEMA

ODD = ["", " ", "  two  spaces ", "▁ underline", "<|endoftext|> <s></s><unk>", "\x00nul", "é𝄞 ﷽ ü", "\n\t x\r\n", "don't I'll", "naïve　日本語", "<0x41>", "a" * 3000,
       " \n" * 500, "ａｂｃ", "​ "]


@pytest.fixture(scope="module")
def plain():
    """The libraries called text by text."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{T.TOKENIZERS}/{T.BYTE_BPE}")
    a.encode_special_tokens = True
    letters = T.byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=f"{T.TOKENIZERS}/{T.PIECE_BPE}")

    def encode_a(text):
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(text, add_special_tokens=False).ids]

    def encode_b(text):
        return [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]

    return encode_a, encode_b


def rows(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    return sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))


def test_odd_texts_repeats_nulls_and_clashing_columns(spark, plain, small_docs):
    docs = [(i, x, "", "", 0) for i, x in enumerate([*ODD, None, *list(small_docs.values())[:12]])]
    docs += [docs[2], docs[8], (None, "no id", None, None, None)]
    df = spark.createDataFrame(docs, DOC_SCHEMA).selectExpr("*", "1 as chunk", "'x' as pairs", "2 as held")
    want = sorted(map(repr, brute.token_alignment([(d[0], d[1]) for d in docs], *plain)))
    assert rows(T.align(df.repartition(3))) == want
    # many chunks give the same counts
    assert rows(T.align(df.repartition(7), chunk_bytes=1)) == want


def test_given_table_counts(spark):
    """Sums that hold for any alignment, on the whole table."""
    got = QUERIES["op12_token_align"](spark, SF_SMALL).collect()
    assert len(got) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for r in got:
        assert r.n_links == r.n_a + r.n_b - r.n_groups and 0 <= r.n_best <= r.n_links <= r.count_sum
        assert bool(r.groups_sha256) == (r.n_a > 0)
    out = {r.doc_id: r for r in T.alignments(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()}
    for r in got:
        x = out[r.doc_id]
        assert (len(x.a_ids), len(x.b_ids), len(x.a_cuts), len(x.link_a)) == (r.n_a, r.n_b, r.n_groups, r.n_links)
        if r.n_a:
            assert (x.a_cuts[-1], x.b_cuts[-1]) == (r.n_a, r.n_b)


@pytest.mark.parametrize("lane", [1, 2, 3, 7, 256])
def test_merge_of_random_cuts(lane):
    rng = random.Random(lane)
    for _ in range(200):
        a_len, b_len, first = [], [], []
        sizes = [rng.randrange(1, 30) for _ in range(rng.randrange(4))]
        want, cuts = [], []
        for size in sizes:
            pick = lambda: sorted({size, *rng.sample(range(1, size + 1), rng.randrange(size))})
            ea, eb = pick(), pick()
            a, b = ([(0, b"x" * n) for n in np.diff([0, *e])] for e in (ea, eb))
            want += [(len(a_len) + i, len(b_len) + j) for i, j in brute.align(a, b)[1]]
            cuts += [sum(sizes[:len(first)]) + c for c in sorted(set(ea) & set(eb))]
            first.append(len(a_len))
            a_len += [len(t[1]) for t in a]
            b_len += [len(t[1]) for t in b]
        ends_a, ends_b = np.cumsum(a_len, dtype=np.int64), np.cumsum(b_len, dtype=np.int64)
        la, lb, ca, cb = T.merge(ends_a, ends_b, np.array(first, np.int64), lane)
        assert list(zip(la.tolist(), lb.tolist())) == want
        assert ends_a[ca].tolist() == cuts == ends_b[cb].tolist()


def test_groups_text(plain):
    texts = ["Hello wörld", "", "a▁b", "don't  stop"]
    x = T.align_texts(pa.array(texts))
    for s, t in zip(T.group_strings(x, 50257), texts):
        a, b = plain[0](" " + t), plain[1](t)
        assert s.decode() == ("" if t in ("", "a▁b") else brute.align(a, b)[0])


def test_both_byte_encoders_agree_on_every_letter():
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{T.TOKENIZERS}/{T.BYTE_BPE}")
    a.encode_special_tokens = True
    texts = ["".join(f"a{chr(c)}b {chr(c)} {chr(c)}1  {chr(c)}'s{chr(c)}  " for c in range(lo, lo + 64) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x20000, 64)] + ODD
    want = [e.ids for e in a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]
    assert T.encoders(T.TOKENIZERS)[0](texts) == want


def test_empty_table(spark):
    assert T.align(spark.createDataFrame([], DOC_SCHEMA)).collect() == []
