"""Conversation prefix trie by SQL ROLLUP over positional turn-id columns.

Every conversation becomes rows of ``BLOCK`` turn ids (``t1 .. t8``), one row
per block of its turns, keyed by the trie node at which the block begins.  One
``GROUP BY block, base, ROLLUP(t1, .., t8)`` then aggregates all prefixes of
all blocks together; ``grouping_id`` gives a node's depth inside its block.

A turn id is 128 bits of a SHA-256 of (role, text) and the text's code points;
a node's key is 128 bits of a SHA-256 of its block's base key and the turn ids
after it, so the node that ends a block is the base of the next one.

Subtree sums need no walk over depths.  A node's representative is its smallest
member ``m``; the nodes that ``m`` represents are a chain from some depth to
the end of ``m``.  The chains split the trie, and a subtree holds, of each of
its members' chains, all (or for its own representative: the part from its
depth on).  So a second ROLLUP sums whole chains over the members, and a
running sum along the representative's own chain takes off what lies above.

Defined cases.  Turns are ordered by ``turn`` (null first), then role, then
turn id.  A null role or text is empty.  A row without ``conv_id`` belongs to no
conversation and is left out.  Repeated rows are repeated turns.  A conversation
that is left without turns is a member of the root.  An empty table has no
nodes.  ``%`` is SQL's (it cuts towards zero).  Columns other than ``conv_id,
turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rsvpark.session import materialize, release

BLOCK = 8
SHARED = 5
GROUP = 100
#: Ids that agree but for so many low bits are joined to one piece.
PIECE_BITS = 10
_KEY = 16

_BLOCKS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("base", pa.binary())]
                    + [(f"t{j}", pa.binary()) for j in range(1, BLOCK + 1)] + [("end_key", pa.binary())])
_COLS = [f"t{j}" for j in range(1, BLOCK + 1)]


def _key(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:_KEY]


def _digest(*parts):
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, _KEY)


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, tid``; no text leaves the scan."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.unhex(F.lpad(F.hex(F.length(text)), 8, "0"))
    tid = F.concat(_digest(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8")), size)
    return conversations.where("conv_id is not null").select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), tid.alias("tid"))


def shared_turns(conv_id):
    """How many first turns a conversation takes from the head of its group of ids."""
    return F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % (SHARED + 1)


def rebuilt(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, own, turn, role, tid`` in whose order a conversation has the head's first turns (``own`` 0),
    then its own (1); ``blocks`` leaves out the first of its own."""
    first = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "tid")
    head = (turns.where(F.col("conv_id") % GROUP == 0).withColumn("n", F.row_number().over(first))
            .where(F.col("n") <= SHARED).select(F.col("conv_id").alias("head"), F.col("n").cast("long").alias("turn"), "tid"))
    ids = (turns.select("conv_id").distinct()
           .select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("head"), shared_turns(F.col("conv_id")).alias("h")))
    taken = ids.join(head, "head").where(F.col("turn") <= F.col("h"))
    return (taken.select("conv_id", F.lit(0).alias("own"), "turn", F.lit("").alias("role"), "tid")
            .unionByName(turns.withColumn("own", F.lit(1))))


def _stream(batches):
    """Sorted turns to block rows; one block of one conversation is held."""
    out: list[list] = []
    conv, skip, block, base, held = None, 0, 0, b"", []

    def emit(last: bool) -> bytes:
        end = _key(base + b"".join(held))
        out.append([conv, block, base, *held, *[None] * (BLOCK - len(held)), end if last else None])
        return end

    for b in batches:
        for c, own, tid in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if c != conv:
                if conv is not None:
                    emit(True)
                conv, skip, block, base, held = c, zlib.crc32(str(c).encode()) % (SHARED + 1), 0, b"", []
            if own and skip:
                skip -= 1
                continue
            if len(held) == BLOCK:
                base, block, held = emit(False), block + 1, []
            held.append(tid)
        if out:
            yield _batch(out)
            out = []
    if conv is not None:
        emit(True)
    if out:
        yield _batch(out)


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCKS)], schema=_BLOCKS)


def blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, base, t1 .. t8, end_key``: a row per block; ``end_key`` is the node where the conversation ends."""
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (rebuilt(turns).repartition(n, "conv_id")
            .sortWithinPartitions("conv_id", "own", F.col("turn").asc_nulls_first(), "role", "tid"))
    kinds = "conv_id long, block long, base binary, " + ", ".join(f"{c} binary" for c in _COLS) + ", end_key binary"
    return rows.select("conv_id", "own", "tid").mapInArrow(_stream, kinds)


def _rollup(rows: DataFrame, aggregates: str) -> DataFrame:
    cols = ", ".join(_COLS)
    filled = " + ".join(f"int({c} is not null)" for c in _COLS)
    # grouping_id has a bit for each column left out; a shorter block's missing turns make no nodes
    df = rows.sparkSession.sql(f"""select block, base, {cols}, grouping_id() as gid, min(conv_id) as conv_id, {aggregates}
        from {{rows}} group by block, base, rollup({cols})
        having {filled} = {BLOCK} - bit_count(grouping_id()) and (block = 0 or bit_count(grouping_id()) < {BLOCK})""", rows=rows)
    return df.withColumn("inside", F.lit(BLOCK) - F.expr("bit_count(gid)")).withColumn("depth", (F.col("block") * BLOCK + F.col("inside")).cast("long"))


def _last(upto):
    """The turn id at position ``upto`` of the block."""
    e = F.lit(None).cast("binary")
    for j, c in enumerate(_COLS, 1):
        e = F.when(upto == j, F.col(c)).otherwise(e)
    return e


def nodes(blocks_table: DataFrame) -> DataFrame:
    """``conv_id, depth, n_convs, saved, key, parent_key`` of every node of the trie."""
    df = _rollup(blocks_table, "count(*) as n_convs")
    empty = F.lit(b"")
    upto = lambda k: _digest("base", *[F.coalesce(F.when(F.lit(j) <= k, F.col(c)), empty) for j, c in enumerate(_COLS, 1)])
    size = F.coalesce(F.conv(F.hex(F.substring(_last(F.col("inside")), _KEY + 1, 4)), 16, 10).cast("long"), F.lit(0))
    parent = (F.when(F.col("depth") == 0, F.lit(None).cast("binary"))
              .when((F.col("inside") == 1) & (F.col("block") > 0), F.col("base")).otherwise(upto(F.col("inside") - 1)))
    return df.select("conv_id", "depth", "n_convs", ((F.col("n_convs") - 1) * size).alias("saved"), upto(F.col("inside")).alias("key"), parent.alias("parent_key"))


def _hash_pieces(batches):
    """Pieces sorted by (key, piece) to one digest per key; a hash state is held, never a list."""
    now, state = None, None
    for b in batches:
        out = []
        for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if out:
            yield _digests(out)
    if now is not None:
        yield _digests([(now, state.hexdigest())])


def _digests(rows):
    return pa.RecordBatch.from_pydict({"key": pa.array([r[0] for r in rows], pa.binary()), "ends_sha256": pa.array([r[1] for r in rows])})


def end_digests(blocks_table: DataFrame) -> DataFrame:
    """``key, ends_sha256``.  Ids of a node are joined in pieces of neighbouring ids wherever they lie;
    only a node's pieces meet, in order, in one running hash (a SHA-256 can't be split further)."""
    n = int(blocks_table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.shiftright("conv_id", PIECE_BITS)
    joined = (blocks_table.where("end_key is not null").groupBy(F.col("end_key").alias("key"), piece.alias("piece"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    return (joined.repartition(n, "key").sortWithinPartitions("key", "piece").select("key", "ids")
            .mapInArrow(_hash_pieces, "key binary, ends_sha256 string"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    rows = materialize(blocks(turn_ids(conversations)), "trie-blocks")
    found = materialize(nodes(rows), "trie-nodes")
    children = found.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    chain = Window.partitionBy("conv_id").orderBy("depth")
    counted = (found.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
               .withColumn("above", F.sum("saved").over(chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("saved"))
               .withColumn("top", F.row_number().over(chain) == 1))
    held = materialize(counted, "trie-chains")
    release(found)
    whole = held.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    with_chain = rows.join(whole, "conv_id", "left").withColumns({"saved": F.coalesce("saved", F.lit(0)), "leaf": F.coalesce("leaf", F.lit(0))})
    below = (_rollup(with_chain, "sum(saved) as saved_below, sum(leaf) as n_leaves")
             .select("conv_id", "depth", "saved_below", "n_leaves"))
    parents = held.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above_conv_id"))
    tops = held.where("top and depth > 0").select("conv_id", "depth", "parent_key").join(parents, "parent_key").select("conv_id", "depth", "above_conv_id")
    parent = F.when(F.col("depth") == 0, F.lit(None)).otherwise(F.coalesce("above_conv_id", "conv_id"))
    return (held.join(below, ["conv_id", "depth"]).join(tops, ["conv_id", "depth"], "left").join(end_digests(rows), "key", "left")
            .select("conv_id", "depth", parent.cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    (F.col("saved_below") - F.col("above")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


#: CRC-32 in DuckDB SQL: the table of byte remainders, then the bytes of an ASCII string folded in one by one.
_CRC_TABLE = ("list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], "
              "lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))")
_CRC = ("xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split({s}, ''), lambda ch: ascii(ch)::bigint)), "
        "lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])))")


def oracle_sql() -> str:
    """The same rows by prefixes written out: every conversation joined with every depth."""
    return f"""
with t as (select {_CRC_TABLE} as crc),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as n
  from conversations where conv_id is not null),
convs as (
  select c.conv_id, c.conv_id - c.conv_id % {GROUP} as head, {_CRC.format(s="c.conv_id::varchar")} % {SHARED + 1} as h
  from (select distinct conv_id from turns) c, t),
again as (
  select c.conv_id, 0 as own, x.n, x.role, x.text from convs c join turns x on x.conv_id = c.head and x.n <= c.h
  union all
  select c.conv_id, 1, x.n, x.role, x.text from convs c join turns x on x.conv_id = c.conv_id and x.n > c.h),
lists as (
  select c.conv_id, coalesce(a.l, []) as l
  from convs c left join (
    select conv_id, list(sha256(length(role)::varchar || ':' || role || text) || ':' || length(text)::varchar order by own, n) as l
    from again group by conv_id) a using (conv_id)),
paths as (
  select conv_id, len(l) as size, d.d as depth, array_to_string(l[1:d.d], ' ') as key,
         case when d.d > 0 then array_to_string(l[1:d.d - 1], ' ') end as parent_key,
         case when d.d > 0 then split_part(l[d.d], ':', 2)::bigint else 0 end as chars
  from lists, (select unnest(range((select max(len(l)) + 1 from lists))) as d) d where d.d <= len(l)),
node as (
  select depth, key, min(conv_id) as conv_id, min(parent_key) as parent_key, count(*) as n_convs, (count(*) - 1) * min(chars) as saved,
         string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = depth) as ends
  from paths group by depth, key),
child as (select depth - 1 as depth, parent_key as key, count(*) as n from node where depth > 0 group by 1, 2),
below as (
  select u.depth, u.key, sum(v.saved) as saved, count(*) filter (where c.n is null) as leaves
  from node v left join child c on c.depth = v.depth and c.key = v.key
  join paths u on u.conv_id = v.conv_id and u.depth <= v.depth group by u.depth, u.key)
select n.conv_id::bigint as conv_id, n.depth::bigint as depth, p.conv_id::bigint as parent_conv_id, n.n_convs::bigint as n_convs,
       coalesce(c.n, 0)::bigint as n_children, b.leaves::bigint as n_leaves, b.saved::bigint as saved_tokens,
       sha256(coalesce(n.ends, '')) as ends_sha256
from node n join below b on b.depth = n.depth and b.key = n.key
left join child c on c.depth = n.depth and c.key = n.key
left join node p on p.depth = n.depth - 1 and p.key = n.parent_key"""
