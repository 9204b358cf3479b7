"""The conversation trie against prefixes written out."""

import random
import zlib

import pytest

from rsvpark.llm import prefix_trie as T
from tests.conftest import SF_SMALL
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def got(df):
    rows = T.trie(df).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def test_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert got(df) == brute.prefix_trie([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations_over_several_blocks(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 700), 60):
        # few texts: long shared paths, branches at any depth, whole copies
        n = rng.choice([1, 2, 5, 8, 9, 16, 17, 30])
        stem = rng.choice([["a"] * 30, ["b"] * 30, ["a", "b"] * 15])
        for t in range(n):
            text = stem[t] if rng.random() < 0.97 else rng.choice(["", "é" * 3, "𝄞 x", None])
            rows.append((c, t * 3 if rng.random() < 0.99 else None, rng.choice(["user"] * 9 + [None]), text))
    rng.shuffle(rows)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute.prefix_trie(rows)


def test_turnless_conversation_is_a_member_of_the_root(spark):
    c = next(i for i in range(101, 200) if zlib.crc32(str(i).encode()) % 6 >= 2)
    rows = [(c, 0, "user", "only turn"), (None, 0, "user", "no conversation")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == {(c, 0): (None, 1, 0, 1, 0, __import__("hashlib").sha256(str(c).encode()).hexdigest())}


def test_ties_repeats_and_clashing_columns(spark):
    rows = [(0, 1, "user", "x"), (0, 1, "user", "x"), (0, 1, "bot", "y"), (1, 1, "user", "x"), (2, None, None, None), (2, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = got(df)
    wide = df.selectExpr("*", "1 as block", "'x' as tid", "0 as own", "x'00' as t1", "5 as depth", "'k' as key", "3 as gid")
    assert got(wide.repartition(3)) == want == brute.prefix_trie(rows)


def test_many_ends_in_pieces(spark):
    rows = [(c, 0, "user", "same") for c in range(0, 9000, 3)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute.prefix_trie(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}
