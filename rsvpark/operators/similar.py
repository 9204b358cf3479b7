"""Similar-answer groups (L3): exact Jaccard similarity of word sets + connected components.

Two answers are linked when the Jaccard similarity of their word sets is at
least ``NUM / DEN``; groups are the connected components of that relation.
Answers with the same word set are one set from the start.  Candidates come
from a prefix filter that misses no link: with words ordered from rare to
frequent (in the event's list), two sets of sizes ``n <= m`` that link share one
of their first ``n - ceil(t n) + 1`` words, and ``n >= t m``.  So only rare words
are join keys, and the word every answer has never is.  Sets meet the centres of
their rare words first, and only components that stay apart are compared set by
set.  Sets that meet are counted by their ids before any word list moves: all
common words up to the end of the prefix that ends first lie in both prefixes,
so the count and what that set has left bound the common words, and a pair that
cannot link ends there.  The rest is verified by counting common words.

Labels (in the end the smallest row id of the component) are merged by hooking
every label seen in a bucket (here: a link) to the bucket's smallest label and
pointer jumping over the label forest, until no bucket holds two labels.
Every round's tables are written to the shared checkpoint folder, and the
work tables are removed when the result is written.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpark.operators.themes import TOKEN_RE
from rsvpark.session import bound_batches, bucketed, has_jvm, materialize, no_shuffles_left, release, shared_path, work_scope

G = ["event_id", "key"]
NUM, DEN = 7, 10        # least Jaccard similarity of linked answers
#: How many of a set's first words there are of which a linked set shares one.
PREFIX = f"cast(n - ceil({NUM} * n / {DEN}) + 1 as int)"
TURNS = 3               # rounds of comparisons with centres, at most; what they leave apart is compared after them
CROWD = 256             # sets of a word from which on they meet its centres first
CELLS = 1 << 22         # cells that words are counted in, to order them
MIN_FOUND = 20          # a round that finds fewer links is the last


def _rare_first(counts):
    """Words, and their hashes, of each row from rare to frequent by the counts of the hashes' cells."""

    def run(batches):
        cells = counts.value if hasattr(counts, "value") else counts
        for batch in batches:
            w, h = batch.column("words"), batch.column("h")
            ends = np.asarray(w.offsets)
            hashes = np.asarray(h.flatten())
            c = cells[hashes & (CELLS - 1)]
            order = np.lexsort((hashes, c, np.repeat(np.arange(len(w)), np.diff(ends))))     # stable: equal hashes stay by word
            n = np.diff(ends)
            last = order[ends[:-1] + np.array([x - -(-NUM * x // DEN) for x in n.tolist()], np.int64)]
            out = {"words": pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), w.flatten().take(pa.array(order))),
                   "last": pa.StructArray.from_arrays([pa.array(c[last], pa.int64()), pa.array(hashes[last])], names=["df", "h"])}
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in [*G, "row_id"]] + [pa.array(n, pa.int32()), *out.values()], names=[*G, "row_id", "n", *out])

    return run


def _sets(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(event_id, key, row_id, rep)`` of every answer with a word, and the word sets of the reps.

    ``answers`` are bucketed by row id, so an answer's words never move before its set is known; then each set is
    one row.  Words are ordered by how often their hash's cell comes (a bound on the word's answers), so no word
    meets a table of words.
    """
    spark = answers.sparkSession
    bound_batches(spark)
    words = F.array_distinct(F.regexp_extract_all(F.lower("answer"), F.lit(TOKEN_RE), 0))
    rows = (answers.select(*G, "row_id", words.alias("w")).groupBy(*G, "row_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("w")))).alias("words"))
            .where("size(words) > 0"))
    rows = materialize(rows.withColumn("set_id", F.unhex(F.sha2(F.array_join("words", "\u0001"), 256))), "words")
    ids = rows.select(*G, "row_id", "set_id")
    reps = ids.groupBy(*G, "set_id").agg(F.min("row_id").alias("rep"))
    named = materialize(ids.join(reps, [*G, "set_id"]).select(*G, "row_id", "rep"), "word-sets-named")
    first = (rows.select(*G, "row_id", "words").join(named.where("rep = row_id").select(*G, "row_id").hint("shuffle_hash"), [*G, "row_id"], "left_semi")
             .select(*G, "row_id", "words", F.expr("transform(words, x -> xxhash64(event_id, key, x))").alias("h")))
    got = first.select(F.explode("h").alias("h")).groupBy((F.col("h").bitwiseAND(CELLS - 1)).cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[np.asarray(got.column("cell").combine_chunks())] = np.asarray(got.column("n").combine_chunks())
    types = dict(rows.dtypes)
    schema = f"event_id string, key string, row_id {types['row_id']}, n int, words array<string>, last struct<df: bigint, h: bigint>"
    sent = spark.sparkContext.broadcast(counts) if has_jvm(spark) else counts
    ordered = materialize(first.mapInArrow(_rare_first(sent), schema), "word-sets")
    release(rows)
    return named, ordered


def word_sets(answers: DataFrame) -> DataFrame:
    """``(event_id, key, row_id, n, words, last, rep)``: every answer with a word, and the word set of the reps.

    ``words`` goes from rare to frequent (ties by the word's hash, then the
    word), ``last`` is the place of the prefix's last word in that order, ``rep``
    the smallest row id of the answers with the same set.
    """
    named, first = _sets(answers)
    return first.join(named, [*G, "row_id"], "right").select(*G, "row_id", "n", "words", "last", "rep")


def _enough(met: DataFrame) -> DataFrame:
    """``(a, b)`` of sets that may link, of ``met``: a row per prefix word that sets ``x`` and ``y`` share.

    ``x`` and ``y`` are ``(sid, n, rest, last)`` with the number of words after the prefix and where it ends, ``px``
    and ``py`` the word's places.  Common words are those counted and at most what the prefix that ends first leaves
    of its set, or what either set has after the last shared word.
    """
    rest = (F.when(F.col("x.last") < F.col("y.last"), F.col("x.rest")).when(F.col("y.last") < F.col("x.last"), F.col("y.rest"))
            .otherwise(F.greatest("x.rest", "y.rest")))
    return (met.where(f"{DEN} * least(x.n, y.n) >= {NUM} * greatest(x.n, y.n)")
            .select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"), (F.col("x.n") + F.col("y.n")).alias("both"), rest.alias("rest"),
                    F.expr("least(x.n - px, y.n - py)").alias("after"))
            .groupBy("a", "b", "both", "rest").agg(F.count(F.lit(1)).alias("common"), F.min("after").alias("after"))
            .where(f"{NUM + DEN} * (common + least(rest, after)) >= {NUM} * both")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _verified(pairs: DataFrame, one: DataFrame) -> DataFrame:
    """``(event_id, key, a, b)``, reps of those of ``pairs(a, b)``, set ids of ``one``, whose word sets link."""
    a = one.select(F.col("sid").alias("a"), *G, F.col("rep").alias("ra"), F.col("n").alias("na"), F.col("words").alias("wa"))
    b = one.select(F.col("sid").alias("b"), *G, F.col("rep").alias("rb"), F.col("n").alias("nb"), F.col("words").alias("wb"))
    common = F.size(F.array_intersect("wa", "wb"))
    return (pairs.join(a, "a").join(b, [*G, "b"])
            .where(DEN * common >= NUM * (F.col("na") + F.col("nb") - common)).select(*G, F.col("ra").alias("a"), F.col("rb").alias("b")))


def components_of(links: DataFrame) -> DataFrame:
    """``(event_id, key, row_id, group_id)`` of the ends of ``links``."""
    return connected_components(links.select(*G, F.explode(F.array("a", "b")).alias("row_id"), F.lit(0).alias("band"), F.array("a", "b").alias("bucket")))


def similar_links(sets: DataFrame) -> DataFrame:
    """``(event_id, key, a, b)``: links of word sets, by their reps, that connect the same sets as all links.

    In each round every set is compared with the centres of its crowded rare words only: of each word's sets
    the smallest and the one that a hash of the round puts first.  What links becomes one component, and sets
    of one component are never compared again; so a family of near copies costs its size.  When a round finds
    little, the pairs that are still apart are compared: of different components, under the length filter.
    """
    one = materialize(sets.where("rep = row_id").select(*G, "rep", "n", "words", "last", F.monotonically_increasing_id().alias("sid")), "word-set-reps")
    # the event and list are part of the word's hash; what meets by chance only adds to a bound and fails the check
    sides = materialize(one.select("sid", F.posexplode(F.expr(f"transform(slice(words, 1, {PREFIX}), x -> xxhash64(event_id, key, x))")).alias("px", "term"),
                                   F.struct("sid", "n", F.expr(f"n - {PREFIX}").alias("rest"), "last").alias("x"))
                        .withColumn("px", F.col("px") + 1), "prefix-words")
    found, label = None, one.select("sid", F.col("sid").alias("label"))
    # a word of few sets has few pairs; a large family's words are all crowded
    crowds = sides.groupBy("term").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") >= CROWD).select("term")
    crowded = materialize(sides.join(crowds, "term"), "crowded-words")
    for turn in range(0 if crowded.isEmpty() else TURNS):
        keys = crowded.join(label, "sid")
        shared = keys.groupBy("term").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by(F.struct("x", "px", "label"), "sid").alias("c1"),
                                          F.min_by(F.struct("x", "px", "label"), F.xxhash64("sid", F.lit(turn))).alias("c2")).where("lo <> hi")
        centre = shared.select("term", F.explode(F.array_distinct(F.array("c1", "c2"))).alias("c"))
        near = keys.join(centre, "term").where("label <> c.label").select("x", "px", F.col("c.x").alias("y"), F.col("c.px").alias("py"))
        new = materialize(_verified(_enough(near), one), "similar-links")
        n = new.count()
        found = new if found is None else found.unionByName(new)
        cc = components_of(found).select(*G, F.col("row_id").alias("rep"), "group_id")
        of = one.select(*G, "rep", "sid").join(cc, [*G, "rep"], "left").withColumn("group_id", F.coalesce("group_id", "rep"))
        least = of.groupBy(*G, "group_id").agg(F.min("sid").alias("label"))
        label = materialize(of.join(least, [*G, "group_id"]).select("sid", "label"), "set-labels")
        if n < MIN_FOUND:
            break
    # only words whose sets are still in several components
    keys = sides.withColumn("label", F.col("sid")) if found is None else sides.join(label, "sid")
    apart = keys.groupBy("term").agg((F.min("label") != F.max("label")).alias("apart")).where("apart").select("term")
    keys = materialize(keys.join(apart, "term"), "prefix-words")
    release(sides, crowded)
    left = keys.select("term", "x", "px", F.col("label").alias("la"))
    right = keys.select("term", F.col("x").alias("y"), F.col("px").alias("py"), F.col("label").alias("lb"))
    met = (left.join(right, "term")
           .where(f"la <> lb and (x.n < y.n or (x.n = y.n and x.sid < y.sid)) and {DEN} * x.n >= {NUM} * y.n").select("x", "px", "y", "py"))
    rest = _verified(materialize(_enough(met), "similar-pairs"), one)
    return rest if found is None else found.unionByName(rest)


def _jump(parent: DataFrame) -> DataFrame:
    """Pointer jumping on ``parent(g, label, parent)`` until every label
    points at a root (a label whose parent is itself or absent)."""
    while True:
        gp = parent.select(*G, F.col("label").alias("parent"), F.col("parent").alias("gp"))
        # The step is written with a flag, so the stop test reads one table.
        nxt = materialize(parent.join(gp, G + ["parent"], "left")
                          .select(*G, "label", F.coalesce("gp", "parent").alias("parent"),
                                  F.coalesce(F.col("gp") < F.col("parent"), F.lit(False)).alias("moved")),
                          "parents")
        parent = nxt.select(*G, "label", "parent")
        if nxt.where("moved").limit(1).count() == 0:
            return parent


def connected_components(members: DataFrame) -> DataFrame:
    """Smallest ``row_id`` of each answer's component, ``(event_id, key, row_id, group_id)``.

    Hook and jump: in every round each label seen in a bucket points to the
    smallest label of that bucket (always a smaller or equal label of the
    same component), pointer jumping over that label forest finds its roots,
    and every answer takes its label's root.  At the fixpoint no bucket holds
    two labels, and the smallest row id of a component never changes, so
    each component carries its smallest row id.  The number of rounds grows
    with the logarithm of the component size, not with its diameter.
    """
    bk = G + ["band", "bucket"]
    members = materialize(members, "members")
    labels = materialize(members.select(*G, "row_id").distinct().withColumn("label", F.col("row_id")), "labels")
    while True:
        seen = members.join(labels, G + ["row_id"]).select(*bk, "label")
        bucket_min = seen.groupBy(*bk).agg(F.min("label").alias("bl"))
        parent = materialize(seen.join(bucket_min, bk).groupBy(*G, "label").agg(F.min("bl").alias("parent"))
                             .where(F.col("parent") < F.col("label")), "parents")
        if parent.limit(1).count() == 0:
            break
        root = _jump(parent)
        labels = materialize(labels.join(root, G + ["label"], "left")
                             .select(*G, "row_id", F.coalesce("parent", "label").alias("label")), "labels")
    return labels.withColumnRenamed("label", "group_id")


def similar_groups(answers: DataFrame) -> DataFrame:
    """``(event_id, key, group_id, n_answers, example)``: one row per group.

    Answers without any word form their own group.  ``example`` is the
    answer with the smallest row id (the group id).
    """
    spark = answers.sparkSession
    with work_scope(spark), no_shuffles_left(spark):
        groups = _groups(answers)
        out = shared_path(spark, "rsvpark-work", f"similar-{uuid.uuid4().hex}")
        groups.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def _groups(answers: DataFrame) -> DataFrame:
    # Read twice below.  Bucketed by (group, answer): joining labels back moves
    # the labels, not the answer texts.
    answers = bucketed(answers, [*G, "row_id"], "answers")
    named, first = _sets(answers)
    links = similar_links(first.withColumn("rep", F.col("row_id")))
    cc = components_of(links).withColumnRenamed("row_id", "rep")
    of = named.join(cc, [*G, "rep"], "left").select(*G, "row_id", F.coalesce("group_id", "rep").alias("group_id"))
    ids = (answers.select(*G, "row_id").join(of, G + ["row_id"], "left")
           .select(*G, F.coalesce("group_id", "row_id").alias("group_id")))
    counts = ids.groupBy(*G, "group_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_answers"))
    # The example is the answer whose row id is the group id: joining the
    # counts onto the bucketed answers moves the counts, not the texts.
    return (counts.withColumnRenamed("group_id", "row_id").join(answers, G + ["row_id"])
            .select(*G, F.col("row_id").alias("group_id"), "n_answers", F.col("answer").alias("example")))
