"""Mix sources to target weights with a low-discrepancy schedule of equal-token blocks.

Every source's documents, in a shuffled order, lie end to end on a line of
words that is cut into blocks of ``block`` words.  The mix is a sequence of
slots; slot ``t`` takes the golden-ratio point ``(t * a mod 2^31) / 2^31``,
which the cumulative shares of the sources map to a source, so any stretch of
the sequence is close to the weights.  Slots are ranked per source; rank ``k``
takes block ``k mod blocks`` in epoch ``k div blocks``.  A source's last slot
takes only the words that are left of its target, so it takes exactly
``floor(target)`` words, and no word is taken more often than ``ceil(target / size)``.

No step puts a source into one task: line positions and slot ranks come from
prefix sums over small ranges of the shuffled order or of the sequence.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rsvpark.llm.names import fresh
from rsvpark.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK = 64
RANGE_DOCS = 4096
RANGE_SLOTS = 1 << 16

_POINTS = 1 << 31
_STEP = 1327217885  # odd, nearest to 2^31 / golden ratio


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(sid, source, source_size, weight, target, taken)`` per source.

    Sources in code-point order (null last) take ``weights`` in turn and divide
    ``share`` of all words by weight; a target above ``cap`` times its source is
    cut there and the excess divided again.  That fixed point is one level
    ``L`` with ``target = min(cap * size, weight * L)``: with sources sorted by
    ``cap * size / weight``, the first whose ratio is above the level left for it
    and the later ones gives ``L``.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", (F.row_number().over(order) - 1).cast("int"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    per = per.withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "sid")
    per = (per.withColumn("cut", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("left_w", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
           .withColumn("level_here", (F.col("budget") - F.col("cut")) / F.col("left_w")))
    level = F.min(F.when(F.col("ratio") > F.col("level_here"), F.struct("ratio", "sid", "level_here"))).over(Window.partitionBy())
    per = per.withColumn("level", level["level_here"])
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("weight") * F.col("level")))
    return per.select("sid", "source", "source_size", "weight", target.alias("target"),
                      F.floor(target).cast("long").alias("taken"))


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots ``(slot, sid, rank, epoch, block, words)`` of the mix, in sequence order.

    ``words`` is what the slot takes of its block.  Sources whose points fall
    short of their number of slots (by the discrepancy, a few) get the missing
    ones at the end; surplus points of others are left unused.
    """
    spark = targets.sparkSession
    t = (targets.where("taken > 0")
         .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
         .withColumn("full", F.expr("taken div source_size"))
         .withColumn("rest", F.expr("taken % source_size"))
         .withColumn("quota", (F.col("full") * F.col("blocks") + F.ceil(F.col("rest") / block)).cast("long")))
    upto = Window.orderBy("sid")
    t = materialize(t.withColumn("cum", F.sum("quota").over(upto)).withColumn("all", F.sum("quota").over(Window.partitionBy())), "mix-targets")
    n, n_src = (t.agg(F.max("all"), F.count("*")).first())
    n = int(n or 0)
    bits = min(20, max(8, math.ceil(math.log2(n_src + 1)) + 3))
    shift = 31 - bits
    edge = lambda c: F.expr(f"cast(floor({_POINTS} * ({c} / `all`)) as bigint)")
    spans = (t.withColumn("lo", edge("(cum - quota)"))
             .withColumn("hi", F.when(F.col("cum") == F.col("all"), F.lit(_POINTS)).otherwise(edge("cum"))))
    cells = spans.where("hi > lo").select("sid", "lo", "hi", "quota",
                                          F.explode(F.expr(f"sequence(shiftright(lo, {shift}), shiftright(hi - 1, {shift}))")).alias("cell"))
    points = (spark.range(n).withColumnRenamed("id", "slot")
              .withColumn("x", (F.col("slot") % _POINTS * _STEP) % _POINTS)
              .withColumn("cell", F.shiftright("x", shift)))
    hit = (points.join(cells, "cell").where("x >= lo and x < hi")
           .select("slot", "sid", "quota", F.expr(f"slot div {RANGE_SLOTS}").alias("stretch")))
    counts = hit.groupBy("sid", "stretch").agg(F.count("*").alias("c"))
    before = counts.select("sid", "stretch", (F.sum("c").over(Window.partitionBy("sid").orderBy("stretch")) - F.col("c")).alias("base"))
    within = F.row_number().over(Window.partitionBy("sid", "stretch").orderBy("slot")) - 1
    ranked = (hit.withColumn("r", within).join(before, ["sid", "stretch"])
              .select("slot", "sid", (F.col("base") + F.col("r")).cast("long").alias("rank"), "quota")
              .where("rank < quota").select("slot", "sid", "rank"))
    got = counts.groupBy("sid").agg(F.sum("c").alias("got"))
    late = (t.select("sid", "quota").join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
            .where("got < quota")
            .select("sid", F.explode(F.expr("sequence(got, quota - 1)")).alias("rank"))
            .select((F.lit(n) + F.col("rank")).alias("slot"), "sid", "rank"))
    facts = t.select("sid", "source_size", "blocks", "quota", "rest")
    all_slots = ranked.unionByName(late).join(facts, "sid")
    last = (F.col("rank") == F.col("quota") - 1) & (F.col("rest") > 0)
    all_slots = (all_slots.withColumn("epoch", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
                 .withColumn("size", F.least(F.lit(block), F.col("source_size") - F.col("block") * block)))
    words = F.when(last, F.col("rest") - F.col("block") * block).otherwise(F.col("size"))
    return all_slots.select("slot", "sid", "rank", "epoch", "block", words.cast("long").alias("words"))


def _lines(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Sizes with ``sid``, target columns and each document's start on its source's line.

    The shuffled order is that of the MD5 of ``doc_id`` (ties by doc_id and size);
    starts are prefix sums inside ranges of the MD5 plus prefix sums over ranges.
    """
    n = sizes.count()
    ranges = 1 << max(0, math.ceil(math.log2(max(1, n / RANGE_DOCS))))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    s = (sizes.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
         .withColumn("h", key)
         .withColumn("range", F.expr(f"cast(conv(substr(h, 1, 8), 16, 10) as bigint) * {ranges} div 4294967296")))
    ties = [c for c in ("tag", "tag2") if c in sizes.columns]
    within = F.sum("size").over(Window.partitionBy("sid", "range").orderBy("h", "doc_id", "size", *ties).rowsBetween(Window.unboundedPreceding, -1))
    sums = s.groupBy("sid", "range").agg(F.sum("size").alias("c"))
    base = sums.select("sid", "range", (F.sum("c").over(Window.partitionBy("sid").orderBy("range")) - F.col("c")).alias("base"))
    return (s.withColumn("w", F.coalesce(within, F.lit(0))).join(base, ["sid", "range"])
            .withColumn("start", (F.col("base") + F.col("w")).cast("long")).drop("h", "range", "w", "base"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """``(doc_id, size, source, source_size, target, taken, first_slot)`` per document of ``docs``.

    ``size`` counts words (0 for a null or blank text, which takes nothing);
    ``taken`` is the number of its words in the mix, repeats counted;
    ``first_slot`` is the slot of the sequence in which the mix first takes one of
    them (null if it takes none).  A null source is a source of its own; repeated
    rows are documents of their own; an empty table gives an empty result.  The
    order is drawn from ``doc_id`` alone, so reruns agree.
    """
    sizes = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets, slots, lines = _planned(sizes, weights, share, cap, block)
    plan = slots.groupBy("sid", "block").agg(F.collect_list(F.struct("slot", "words")).alias("takes"))
    own = ["doc_id", "sid", "start", "size"]
    blocks = F.expr(f"if(size > 0, sequence(start div {block}, (start + size - 1) div {block}), null)")
    pieces = (lines.withColumn("block", F.explode_outer(blocks))
              .withColumn("lo", F.greatest(F.col("start") - F.col("block") * block, F.lit(0)))
              .withColumn("hi", F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))))
    # a block is taken once a pass: its list is as long as ``cap`` allows
    got = pieces.select(*own, "block", "lo", "hi").join(plan, ["sid", "block"], "left")
    words = F.expr("aggregate(takes, 0L, (a, t) -> a + greatest(least(hi, t.words) - lo, 0L))")
    begins = F.expr("array_min(transform(filter(takes, t -> t.words > lo), t -> t.slot))")
    taken = got.groupBy(*own).agg(F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("taken"), F.min(begins).alias("first_slot"),
                                  F.count("*").alias("parts"))
    # documents without words share a start: keep one row for each of them
    rows = F.when(F.col("size") == 0, F.col("parts")).otherwise(F.lit(1))
    taken = taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), rows.cast("long")))).drop("copy", "parts")
    facts = targets.withColumnRenamed("taken", "source_taken")
    return taken.join(facts, "sid").select("doc_id", "size", "source", "source_size", "target", "taken", "first_slot")


def _planned(sizes: DataFrame, weights, share, cap, block) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Targets of the sources, slots of the mix, and the documents' places on their sources' lines."""
    targets = materialize(source_targets(sizes, weights, share, cap), "mix-sources")
    return targets, schedule(targets, block), materialize(_lines(sizes, targets), "mix-lines")


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """The mix as rows of ``docs``, in the order of its slots: each document as often as the mix begins it.

    A document whose words the mix takes twice is there twice, one it does not
    reach is not there; the one that a source's target ends in stays whole.
    Partitions follow the sequence, so any run of written files is close to the
    weights.
    """
    tag, tag2, slot, row = fresh(docs.columns, "row_tag", "row_tag2", "row_slot", "row_copy")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # two hashes of the whole row: rows that share both are copies, and any one of them stands for all
    whole = [F.to_json(F.struct(c)) if not isinstance(f.dataType, T.AtomicType) else c for c, f in zip(cols, docs.schema)]
    keyed = docs.select(*cols, F.xxhash64(*whole).alias(tag), F.hash(*reversed(whole)).alias(tag2))
    sizes = materialize(keyed.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.col(tag).alias("tag"), F.col(tag2).alias("tag2")), "mix-sizes")
    _, slots, lines = _planned(sizes, weights, share, cap, block)
    first = lines.where("size > 0").select("sid", F.expr(f"start div {block}").alias("block"), F.expr(f"start % {block}").alias("lo"),
                                           F.col("tag").alias(tag), F.col("tag2").alias(tag2))
    begins = materialize(first.join(slots, ["sid", "block"]).where("words > lo").select(tag, tag2, F.col("slot").alias(slot)), "mix-begins")
    # one of each group of copies, so that texts move once to meet their slots and once to the sequence
    copy = F.row_number().over(Window.partitionBy(tag, tag2).orderBy(tag))
    out = keyed.withColumn(row, copy).where(F.col(row) == 1).drop(row).join(begins, [tag, tag2])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = int(begins.agg(F.max(slot)).first()[0] or 0) + 1
    return (out.repartitionById(n, F.expr(f"cast({slot} * {n} div {last} as int)")).sortWithinPartitions(slot, tag, tag2).select(*cols))


def oracle_sql(weights=WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK) -> str:
    """Words in closed form (whole passes over each source plus a prefix of its shuffled line), first slots from the sequence."""
    ws = ", ".join(str(x) for x in weights)
    return f"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')), 0)::BIGINT AS size
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid FROM sizes GROUP BY source),
caps AS (
  SELECT *, [{ws}][(sid % {len(weights)} + 1)::INT] AS weight, source_size * {float(cap)}::DOUBLE AS most,
         (sum(source_size) OVER ())::DOUBLE * {float(share)}::DOUBLE AS budget FROM per),
levels AS (
  SELECT *, most / weight AS ratio,
         (budget - coalesce(sum(most) OVER (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level_here
  FROM caps),
lvl AS (SELECT arg_min(level_here, ratio) AS level FROM levels WHERE ratio > level_here),
targets AS (
  SELECT sid, source, source_size, CASE WHEN level IS NULL THEN most ELSE least(most, weight * level) END AS target
  FROM levels, lvl),
placed AS (
  SELECT s.doc_id, s.size, t.sid, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
-- the sequence: golden-ratio points through the sources' cumulative quotas, ranks per source
quotas AS (
  SELECT sid, source, source_size, floor(target)::BIGINT % source_size AS rest, ceil(source_size / {block}.0)::BIGINT AS blocks,
         (floor(target)::BIGINT // source_size) * ceil(source_size / {block}.0)::BIGINT
           + ceil((floor(target)::BIGINT % source_size) / {block}.0)::BIGINT AS quota
  FROM targets WHERE floor(target) > 0),
spans AS (
  SELECT *, (sum(quota) OVER ())::BIGINT AS n,
         floor({_POINTS} * ((sum(quota) OVER (ORDER BY sid) - quota)::DOUBLE / (sum(quota) OVER ())::DOUBLE))::BIGINT AS lo,
         CASE WHEN sum(quota) OVER (ORDER BY sid) = sum(quota) OVER () THEN {_POINTS}
              ELSE floor({_POINTS} * ((sum(quota) OVER (ORDER BY sid))::DOUBLE / (sum(quota) OVER ())::DOUBLE))::BIGINT END AS hi
  FROM quotas),
points AS (SELECT t AS slot, ((t % {_POINTS}) * {_STEP}) % {_POINTS} AS x FROM range((SELECT coalesce(max(n), 0) FROM spans)) r(t)),
hits AS (SELECT p.slot, s.sid, s.quota, row_number() OVER (PARTITION BY s.sid ORDER BY p.slot) - 1 AS rank
         FROM points p JOIN spans s ON p.x >= s.lo AND p.x < s.hi),
late AS (SELECT s.sid, s.n, unnest(range(coalesce(h.c, 0)::BIGINT, s.quota)) AS rank
         FROM spans s LEFT JOIN (SELECT sid, count(*) AS c FROM hits GROUP BY sid) h USING (sid)),
slots AS (
  SELECT a.slot, s.sid, a.rank % s.blocks AS block,
         CASE WHEN a.rank = s.quota - 1 AND s.rest > 0 THEN s.rest - (a.rank % s.blocks) * {block}
              ELSE least({block}, s.source_size - (a.rank % s.blocks) * {block}) END AS words
  FROM (SELECT slot, sid, rank FROM hits WHERE rank < quota UNION ALL SELECT n + rank, sid, rank FROM late) a JOIN spans s USING (sid)),
lines AS (SELECT row_number() OVER () AS r, * FROM placed),
begins AS (
  SELECT l.r, min(s.slot) AS first_slot
  FROM (SELECT r, sid, start, size, unnest(range((start // {block})::BIGINT, ((start + size - 1) // {block} + 1)::BIGINT)) AS block FROM lines WHERE size > 0) l
  JOIN slots s ON s.sid = l.sid AND s.block = l.block AND s.words > greatest(l.start - l.block * {block}, 0)
  GROUP BY l.r)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE
         (floor(target)::BIGINT // source_size) * size
         + greatest(least(floor(target)::BIGINT % source_size - start, size), 0) END::BIGINT AS taken, first_slot::BIGINT AS first_slot
FROM lines LEFT JOIN begins USING (r)
"""
