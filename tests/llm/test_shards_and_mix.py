"""Lookup-table placement and the source mix."""

import collections
import hashlib
import random

import pytest

from rsvpark.llm import lookup_shards as S
from rsvpark.llm import mix_schedule as X
from rsvpark.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_table_is_even_and_follows_the_turns():
    names = S.shard_names(7)
    t = S.fill_table(names, 211)
    c = collections.Counter(t)
    assert set(c) == set(range(7)) and max(c.values()) - min(c.values()) <= 1
    # replay: the owner of a slot took it as its first free preference
    num = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
    free = set(range(211))
    for turn in range(211):
        n = names[turn % 7]
        order = ((num(n + "/offset") + j * (num(n + "/skip") % 210 + 1)) % 211 for j in range(211))
        slot = next(s for s in order if s in free)
        free.remove(slot)
        assert t[slot] == turn % 7


def test_removing_a_shard_moves_few_slots():
    names = S.shard_names(16)
    a, b = S.fill_table(names), S.fill_table(names[:-1])
    moved = sum(x != y for x, y in zip(a, b) if x != 15)
    assert moved < 0.2 * len(a)


@pytest.mark.parametrize("names,size", [([], 11), (["a", "a"], 11), (["a", "b"], 10), (["a", "b", "c"], 2)])
def test_bad_tables_are_refused(names, size):
    with pytest.raises(ValueError):
        S.fill_table(names, size)


def test_placement(spark):
    rows = [(1, "a", 5), (1, "b", 5), (None, None, None), (2, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    out = S.place(df)
    assert out.columns == ["doc_id", "text", "slot", "shard"]
    got = out.collect()
    assert len(got) == 4
    table = S.fill_table(S.shard_names())
    for r in got:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:8], 16) % S.TABLE_SIZE
        assert (r.slot, r.shard) == (slot, table[slot])
    assert S.place(df.limit(0)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def targets_by_hand(sizes):
    """Water filling, round by round: sources over twice their size stop, the excess is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s] + 1e-9}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def check_mix(rows, docs):
    size = collections.Counter()
    for _, t, s in docs:
        size[s] += len(brute.word_list(t))
    want = targets_by_hand(size)
    taken = collections.Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 1


def test_mix_of_documents(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = X.mix(df).collect()
    check_mix(rows, docs)
    again = X.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert sum(r.taken for r in QUERIES["op9_mix_schedule"](spark, SF_SMALL).collect()) == sum(r.taken for r in rows)


def test_mix_edge_rows(spark):
    rng = random.Random(1)
    docs = [(i, "w " * rng.choice([0, 1, 3, 64, 200]), rng.choice(["a", "é", "zz"])) for i in range(60)]
    docs += [(100, None, "a"), (101, "x", None), (None, "y " * 9, "a"), (5, "w w", "a"), (5, "w w", "a"), (200, "v " * 20_000, "big"), (201, "", "void"), (201, "", "void")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, size int, target int")
    check_mix(X.mix(df).collect(), docs)
    assert X.mix(df.limit(0)).count() == 0
    out = X.mixed(df)
    assert out.columns == df.columns and X.mixed(df.limit(0)).count() == 0
    n = collections.Counter((r.doc_id, r.text, r.source) for r in out.collect())
    per = collections.Counter(docs)
    took = collections.defaultdict(int)
    for r in X.mix(df).collect():
        if r.size:
            took[(r.doc_id, r.size, r.source)] += -(-r.taken // r.size)
        assert (r.first_slot is None) == (r.taken == 0)
    assert all(v <= 2 * per[k] for k, v in n.items())
    assert sum(n.values()) == sum(took.values())


def test_output_keeps_close_to_the_weights_in_every_stretch(spark):
    """Words of each source in any prefix of the mix as written, and first slots in that order."""
    rng = random.Random(3)
    size = {"a": 300, "b": 300, "c": 300}
    docs = [(1000 * k + i, " ".join("w" for _ in range(rng.randrange(20, 90))), s) for k, s in enumerate(size) for i in range(size[s])]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = X.mixed(df).collect()           # partitions in order: the sequence as written
    words = collections.Counter()
    for r in X.mix(df).collect():
        words[r.source] += r.taken
    total, seen, done = sum(words.values()), collections.Counter(), 0
    for r in rows:
        k = len(r.text.split())
        seen[r.source] += k
        done += k
        assert all(abs(seen[s] - done * words[s] / total) < 8 * X.BLOCK + 180 for s in size)
    slot = {r.doc_id: r.first_slot for r in X.mix(df).collect()}
    first = []
    for r in rows:
        if r.doc_id not in first:
            first.append(r.doc_id)
    assert [slot[i] for i in first] == sorted(slot[i] for i in first)


HELPERS = ["kept_doc", "kept_tag", "row_tag", "row_tag2", "row_slot", "row_all", "key_slot", "table_slot", "table_shard",
           "leaks", "__leaks", "leaks_before", "leaks_here", "slot", "tag", "tag2", "of", "sid", "size", "start", "block", "words", "takes", "copy",
           "__slot", "__shard", "__tag", "__times", "__copy", "__pass", "__key_slot", "component_id", "n_shingles", "x", "predicted", "score"]


def test_no_helper_name_clashes_with_a_users_column(spark):
    """All pipeline operators on a table that has every helper name as a column, values kept."""
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40)
    own = {c: f"mine-{c}" for c in HELPERS}
    from pyspark.sql import functions as F
    wide = docs.select("*", *[F.lit(v).alias(c) for c, v in own.items()])
    for name, stage in P.STAGES:
        out = stage(spark, wide, SF_SMALL)
        rows = out.collect()
        assert rows, name
        for r in rows:
            assert all(r[c] == v for c, v in own.items() if c not in ("slot", "shard")), name
        base = [r.doc_id for r in stage(spark, docs, SF_SMALL).select("doc_id").collect()]
        assert collections.Counter(base) == collections.Counter(r.doc_id for r in rows), name


def test_schedule_keeps_close_to_the_shares_everywhere(spark):
    from pyspark.sql import functions as F
    t = spark.createDataFrame([(0, "a", 64_000, 3, 60_000.0, 60_000), (1, "b", 64_000, 1, 20_000.0, 20_000), (2, "c", 30_000, 2, 40_000.0, 40_000)],
                              "sid int, source string, source_size long, weight int, target double, taken long")
    rows = X.schedule(t).orderBy("slot").collect()
    assert sum(r.words for r in rows) == 120_000
    share = {0: 0.5, 1: 1 / 6, 2: 1 / 3}
    seen = collections.Counter()
    for i, r in enumerate(rows, 1):
        seen[r.sid] += 1
        assert all(abs(seen[s] - i * share[s]) < 8 for s in share)
    per = collections.Counter((r.sid, r.block) for r in rows)
    assert max(per.values()) == 2 and {r.epoch for r in rows if r.sid == 2} == {0, 1}
    assert t.select(F.sum("taken")).first()[0] == 120_000


def test_texts_move_once_to_their_slots_and_once_to_the_sequence(spark):
    """Copies are cut where rows meet their slots, not by a second branch that reads and moves all texts again."""
    rows = [(i, f"w{i} " * 90, "ab"[i % 2]) for i in range(40)] + [(7, "w7 " * 90, "b")] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = X.mixed(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("w0 w0") == 0 and plan.count("LogicalRDD") == 1
    n = collections.Counter(r.doc_id for r in out.collect())
    took = collections.Counter()
    for r in X.mix(df).collect():
        took[r.doc_id] += -(-r.taken // r.size)
    assert n == took and n[7] > 60
