"""Shard placement through a permutation-filled lookup table (DataFrame operations only).

Each shard prefers the slots of a prime-sized table in its own order,
``(offset + j * skip) mod size`` with ``offset`` and ``skip`` drawn from its
name; shards take turns, each claiming its first slot that is still free, until
the table is full.  A row's key is hashed to a slot, and one broadcast equi-join
with the table (``size`` rows, a parameter) places it.  Every shard owns
``size / shards`` slots give or take one, and removing a shard moves few keys.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpark.llm.names import fresh

SHARDS = 16
TABLE_SIZE = 4099


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:04d}" for i in range(n)]


def fill_table(names: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of its shard.  ``size`` must be prime and at least the number of shards."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be distinct and not empty")
    if not _is_prime(size) or size < len(names):
        raise ValueError(f"table size {size} must be a prime of at least {len(names)}")
    offset = [_number(f"{s}/offset") % size for s in names]
    skip = [_number(f"{s}/skip") % (size - 1) + 1 for s in names]
    nxt = [0] * len(names)
    table = [-1] * size
    for turn in range(size):
        i = turn % len(names)
        while table[slot := (offset[i] + nxt[i] * skip[i]) % size] >= 0:
            nxt[i] += 1
        table[slot] = i
    return table


def lookup_table(spark: SparkSession, names: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The filled table as ``(slot, shard)``, one row per slot."""
    owners = ",".join(map(str, fill_table(names, size)))
    return (spark.range(1)
            .select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard"))
            .select("slot", F.col("shard").cast("int").alias("shard")))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 32 bits of the MD5 of its text (null reads as empty), mod ``size``."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(size)).cast("int")


def place(df: DataFrame, key: str = "doc_id", n_shards: int = SHARDS, size: int = TABLE_SIZE,
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and shard of each row's ``key``.

    Rows are neither dropped nor repeated: equal keys share a shard, a null key
    is placed like an empty text, an empty table stays empty.  Columns of ``df``
    named like the two new ones are replaced.
    """
    mine, slot, shard = fresh(df.columns, "key_slot", "table_slot", "table_shard")
    table = lookup_table(df.sparkSession, shard_names(n_shards), size)
    table = table.select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    kept = [c for c in df.columns if c.lower() not in (slot_col.lower(), shard_col.lower())]
    keyed = df.withColumn(mine, slot_of(F.col(f"`{key}`"), size))
    return (keyed.join(F.broadcast(table), F.col(mine) == F.col(slot), "inner")
            .select(*[F.col(f"`{c}`") for c in kept], F.col(mine).alias(slot_col), F.col(shard).alias(shard_col)))


def oracle_sql(n_shards: int = SHARDS, size: int = TABLE_SIZE) -> str:
    """The same placement in DuckDB: the turns are a recursive table over the list of owners."""
    return f"""
WITH RECURSIVE pref AS (
  SELECT list(('0x' || substr(md5(name || '/offset'), 1, 8))::BIGINT % {size} ORDER BY i) AS off,
         list(('0x' || substr(md5(name || '/skip'), 1, 8))::BIGINT % {size - 1} + 1 ORDER BY i) AS skip
  FROM (SELECT i, 'shard-' || lpad(i::VARCHAR, 4, '0') AS name FROM range({n_shards}) t(i))),
turns AS (
  SELECT 0::BIGINT AS turn, -1::BIGINT AS slot, 0::BIGINT AS shard,
         list_transform(range({size}), lambda x: false) AS taken
  UNION ALL
  SELECT turn + 1, claimed, turn % {n_shards},
         list_concat(list_concat(taken[1:claimed], [true]), taken[claimed + 2:])
  FROM (SELECT t.turn, t.taken,
          list_filter([(p.off[(t.turn % {n_shards} + 1)::INT] + j * p.skip[(t.turn % {n_shards} + 1)::INT]) % {size}
                       for j in range({size})], lambda s: NOT t.taken[(s + 1)::INT])[1] AS claimed
        FROM turns t, pref p WHERE t.turn < {size})),
owners AS (SELECT slot, shard FROM turns WHERE turn > 0)
SELECT d.doc_id, o.slot::INTEGER AS slot, o.shard::INTEGER AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {size} AS slot
      FROM documents) d JOIN owners o USING (slot)
"""
