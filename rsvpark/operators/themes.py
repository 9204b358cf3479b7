"""Free-text themes as Spark jobs.

The reference hands both answer lists to an outside model; the data contract
(themes with a title under six words, a count, up to three verbatim quotes;
filler set aside) is rebuilt here:

* ``theme_inputs``: genuine answers per (event, list): speaker questions, and
  future topics of events whose topics are free text; filler is set aside.
* ``themes``: TF-IDF over word tokens, then spherical k-means run for all
  (event, list) groups at once with joins and aggregates.  Points stay
  partitioned by answer; the centroid table is broadcast only while its
  checked row count is under a bound, else it is shuffle-joined.  Each
  iteration's centroids are checkpointed to the shared checkpoint folder.
* Top-3 quotes and title terms come from three rounds of a max aggregate
  (partial aggregation per task), never from a window over a whole theme.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rsvpark import constants as K
from rsvpark.functions.fmt import rank_text
from rsvpark.functions.text import html_escape, is_blank, is_filler, strip_long, strip_ws
from rsvpark.operators import theme_blocks
from rsvpark.session import bucketed, materialize
from rsvpark.sources.schema import THEME_FILE

G = ["event_id", "key"]
# Letters/digits runs, and single Han characters (no spaces in Chinese).
TOKEN_RE = r"(?U)\p{IsHan}|[\p{L}\p{N}]+"
N_THEMES = 5            # plus one "other" theme for answers sharing no term
MOVE_GAIN = 1e-9        # an answer changes its theme only for a score better by this
BROADCAST_MAX_ROWS = 2_000_000        # k x kept terms (centroid rows: group, id, term, weight)
IDF_BROADCAST_MAX_ROWS = 1_000_000    # kept (group, term) rows of the idf table
QUOTE_BROADCAST_MAX_ROWS = 200_000    # distinct quotes of an audited theme table
OTHER_TITLE = "Other answers"
TITLE_TERMS = 3


def version() -> str:
    """Short hash of everything a theme depends on beside its answers."""
    import hashlib
    parts = (TOKEN_RE, N_THEMES, MOVE_GAIN, "log((1+nd)/df)", OTHER_TITLE, K.FILLER_ANSWERS, K.FILLER_TRAILING_PUNCT,
             K.THEME_MAX_TITLE_WORDS, K.THEME_MAX_QUOTES)
    return hashlib.sha1(repr(parts).encode()).hexdigest()[:8]


def theme_inputs(reg: DataFrame, mode: DataFrame) -> DataFrame:
    """``(event_id, key, row_id, answer)``: trimmed, non-blank, non-filler."""
    q = (reg.where(~is_blank("speaker_q") & ~is_filler("speaker_q"))
         .select("event_id", F.lit("speaker_q").alias("key"), "row_id", strip_long("speaker_q").alias("answer")))
    free = mode.where(~F.col("topics_are_choices")).select("event_id")
    t = (reg.join(free, "event_id", "left_semi")
         .where(~is_blank("future_topics") & ~is_filler("future_topics"))
         .select("event_id", F.lit("future_topics").alias("key"), "row_id",
                 strip_long("future_topics").alias("answer")))
    return q.unionByName(t)


def terms(answers: DataFrame) -> DataFrame:
    """``(event_id, key, row_id, term, tf)`` over the whole answer text.

    Grouped on (group, answer, term): when ``answers`` is already hash
    partitioned by (group, answer) this runs without a shuffle.
    """
    tok = answers.select(*G, "row_id", F.explode(F.regexp_extract_all(F.lower("answer"), F.lit(TOKEN_RE), 0))
                         .alias("term"))
    return tok.groupBy(*G, "row_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf(answers: DataFrame, prepartitioned: bool = False) -> tuple[DataFrame, int]:
    """L2-normalised TF-IDF points ``(event_id, key, row_id, term, tid, w)``
    and the number of kept (group, term) pairs (see ``_tfidf``)."""
    points, n_terms, _ = _tfidf(answers, prepartitioned)
    return points, n_terms


def _tfidf(answers: DataFrame, prepartitioned: bool = False) -> tuple[DataFrame, int, DataFrame]:
    """TF-IDF points, the number of kept (group, term) pairs, and the kept
    vocabulary ``(event_id, key, tid, term)``.

    ``tid`` is a number given to each kept term when the idf table is
    written; the k-means rounds join and group on it instead of the text
    (and, reading Parquet, never read the text column).

    Every term is kept, in lists of any size: ``log((1 + answers) / df)`` is
    above 0, and near 0 for a term that most answers have.

    The answers are hash partitioned by (group, answer) once; term counts,
    the idf join (broadcast only while the counted idf table is under
    ``IDF_BROADCAST_MAX_ROWS``), the length window and the bucketed write of
    the points all keep that layout, so only the document-frequency partials
    cross the network.
    """
    n = int(answers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ``prepartitioned``: the answers are a table bucketed on (group, answer)
    # into ``n`` buckets (``session.bucketed``), already in this layout.
    tf = terms(answers if prepartitioned else answers.repartition(n, *G, "row_id"))
    nd = answers.groupBy(*G).agg(F.count(F.lit(1)).alias("nd"))
    df = tf.groupBy(*G, "term").agg(F.count(F.lit(1)).alias("df"))
    keep = materialize(
        df.join(nd, G)
        .select(*G, "term", F.log((1 + F.col("nd")) / F.col("df")).alias("idf"),
                F.monotonically_increasing_id().alias("tid")), "idf")
    n_terms = keep.count()
    small = n_terms <= IDF_BROADCAST_MAX_ROWS
    w = (tf.join(F.broadcast(keep) if small else keep, G + ["term"])
         .select(*G, "row_id", "term", "tid", ((1 + F.log("tf")) * F.col("idf")).alias("w")))
    if not small:
        # The shuffle join moved the points to term order; back to answers.
        w = w.repartition(n, *G, "row_id")
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*G, "row_id")))
    points = w.select(*G, "row_id", "term", "tid", (F.col("w") / length).alias("w"))
    return points, n_terms, keep.select(*G, "tid", "term")


def _wide(rows: DataFrame, k: int) -> DataFrame:
    """``rows(g, cid, tid, w)`` summed to one row per term, ``(g, tid, c0 .. c<k-1>)``; null where a theme lacks the term."""
    return rows.groupBy(*G, "tid").agg(*[F.sum(F.when(F.col("cid") == i, F.col("w"))).alias(f"c{i}") for i in range(k)])


def _unit(cent: DataFrame, k: int) -> DataFrame:
    """Centroids of length 1."""
    norms = cent.groupBy(*G).agg(*[F.sqrt(F.sum(F.col(f"c{i}") * F.col(f"c{i}"))).alias(f"n{i}") for i in range(k)])
    return cent.join(norms, G).select(*G, "tid", *[(F.col(f"c{i}") / F.col(f"n{i}")).alias(f"c{i}") for i in range(k)])


def _seeds(points: DataFrame, k: int) -> DataFrame:
    """Deterministic seeds: per group, the lowest-hash answer of each of k hash buckets."""
    docs = points.select(*G, "row_id").distinct()
    h = F.xxhash64(F.lit("seed"), "row_id")
    return (docs.groupBy(*G, F.pmod(F.xxhash64("row_id"), F.lit(k)).alias("cid"))
            .agg(F.min_by("row_id", h).alias("row_id")))


def _assign(points: DataFrame, cent: DataFrame, k: int, broadcast_ok: bool, before: DataFrame | None = None) -> DataFrame:
    """Best centroid per answer by cosine similarity, ``(g, row_id, cid, score, was)``; an answer leaves its
    theme of ``before`` (``was``) only for one that scores ``MOVE_GAIN`` more.

    With the centroid table broadcast, ``points`` is bucketed by answer and the
    dot products of all themes run inside those buckets without a shuffle;
    else it is bucketed by term and only sums per answer move.
    """
    unit = _unit(cent, k)
    s = (points.join(F.broadcast(unit) if broadcast_ok else unit.hint("shuffle_hash"), G + ["tid"])
         .groupBy(*G, "row_id").agg(*[F.sum(F.col("w") * F.col(f"c{i}")).alias(f"s{i}") for i in range(k)]))
    if before is None:
        s = s.withColumn("was", F.lit(None).cast("bigint"))
    else:
        s = s.join(before.select(*G, "row_id", F.col("cid").alias("was")), G + ["row_id"], "left")

    def one(i: int) -> Column:
        score = F.col(f"s{i}")
        rank = score + F.when(F.col("was") == i, F.lit(MOVE_GAIN)).otherwise(F.lit(0.0))
        return F.when(score.isNotNull(), F.struct(rank.alias("rank"), F.lit(-i).cast("bigint").alias("neg"), score.alias("score")))

    best = s.select(*G, "row_id", "was", F.array_max(F.array(*[one(i) for i in range(k)])).alias("b"))
    return best.select(*G, "row_id", (-F.col("b.neg")).alias("cid"), F.col("b.score").alias("score"), "was")


def kmeans(points: DataFrame, k: int = N_THEMES, iterations: int | None = None,
           vocab: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Spherical k-means for every (event, key) group at once.

    Returns ``(assignments(g, row_id, cid, score), centroids(g, cid, tid, cw))``
    (centroids are sums of member vectors; scores divide by their length).
    Rounds go on until no answer changes its theme; ``iterations`` stops them
    earlier.  They end: an answer once in a theme stays in one, a change
    raises the sum of all scores (at most the number of answers) by
    ``MOVE_GAIN`` or more, far above rounding, and a new centroid never lowers
    that sum.
    The centroid table has at most k rows per (group, kept term); that bound
    is counted once (or passed in as ``vocab``) and decides between a
    broadcast and a shuffle join.
    """
    points = bucketed(points, [*G, "row_id"], "points", prepartitioned=True)
    by_answer = points
    if vocab is None:
        vocab = points.select(*G, "tid").distinct().count()
    broadcast_ok = k * vocab <= BROADCAST_MAX_ROWS
    if not broadcast_ok:
        # a copy that lies by term: rounds move centroids and sums, not points
        points = bucketed(by_answer, [*G, "tid"], "points_by_term")
    seeds = _seeds(by_answer, k)
    cent = materialize(_wide(by_answer.join(seeds, G + ["row_id"]), k), "centroids")
    before, rounds, done = None, 0, False
    while iterations is None or rounds < iterations:
        assign = materialize(_assign(points, cent, k, broadcast_ok, before), "assign")
        done = before is not None and assign.where("not (cid <=> was)").isEmpty()
        if done:
            break
        # Both sides are keyed by answer: a hash join inside each bucket
        # (built on the one-row-per-answer side) avoids sorting every point.
        moved = by_answer.join(assign.select(*G, "row_id", "cid").hint("shuffle_hash"), G + ["row_id"])
        cent = materialize(_wide(moved, k), "centroids")
        before, rounds = assign, rounds + 1
    if not done:
        assign = materialize(_assign(points, cent, k, broadcast_ok, before), "assign")
    long = cent.select(*G, "tid", F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("cid"), F.col(f"c{i}").alias("cw")) for i in range(k)])).alias("c"))
    return assign.drop("was"), long.select(*G, "c.cid", "tid", "c.cw").where("cw is not null")


def top_n(df: DataFrame, keys: list[str], order: list[Column], payload: list[str], n: int) -> DataFrame:
    """Up to ``n`` rows per key group, largest ``order`` first.

    Done as ``n`` rounds of a max aggregate plus an anti join, so a huge
    group is reduced by partial aggregation in every task instead of being
    sorted in one.
    """
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(p).alias(p) for p in payload]
    cand = df.select(*keys, F.struct(*fields).alias("s"))
    picked = None
    for r in range(1, n + 1):
        rest = cand if picked is None else cand.join(picked.select(*keys, "s"), keys + ["s"], "left_anti")
        best = rest.groupBy(*keys).agg(F.max("s").alias("s")).withColumn("rnk", F.lit(r))
        picked = best if picked is None else picked.unionByName(best)
    return picked.select(*keys, "rnk", *[F.col(f"s.{p}").alias(p) for p in payload])


def themes(answers: DataFrame, k: int = N_THEMES, iterations: int | None = None,
           prepartitioned: bool = False) -> DataFrame:
    """``themes(event_id, key, theme_id, title, count, quotes)`` for every list.

    Answers that share no term with any centroid form the "other" theme,
    so counts add up to the genuine answers of the list.  The rounds run over
    blocks of terms (``theme_blocks``); lists with more answers than that
    takes, in all, go through the joins of ``kmeans``.
    """
    # Only ids move from here on: a text is its hash until the quotes are known.
    ids = materialize(answers.select(*G, "row_id", F.unhex(F.sha2("answer", 256)).alias("text_id"), F.octet_length("answer").alias("size"),
                                     F.lower("answer").rlike(TOKEN_RE).alias("worded")), "answer-ids")
    if theme_blocks.usable(ids):
        assign, heavy = theme_blocks.kmeans(answers, ids, TOKEN_RE, k, iterations, MOVE_GAIN, TITLE_TERMS)
    else:
        if not prepartitioned:
            answers, prepartitioned = bucketed(answers, [*G, "row_id"], "answers"), True
        points, n_terms, vocab = _tfidf(answers, prepartitioned)
        assign, cent = kmeans(points, k, iterations, n_terms)
        # Title terms: heavy in this theme AND concentrated in it (weight times
        # its share of the term's weight over all themes of the list), so words
        # common to every theme do not name one.
        spread = cent.groupBy(*G, "tid").agg(F.sum("cw").alias("cw_all"))
        heavy = (cent.join(spread, G + ["tid"]).join(vocab, G + ["tid"])
                 .select(*G, "cid", "term", (F.col("cw") * F.col("cw") / F.col("cw_all")).alias("tw")))
    full = materialize(ids.join(bucketed(assign, [*G, "row_id"], "themes"), G + ["row_id"], "left")
                       .select(*G, "row_id", "text_id", F.coalesce("cid", F.lit(k)).alias("cid"),
                               F.coalesce("score", F.lit(0.0)).alias("score")), "themed")
    counts = full.groupBy(*G, "cid").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    # Quotes are distinct answers: copies of one answer compete once, through
    # their best copy.  Only ids and scores go through the top-3 rounds; the
    # texts are joined back for the (at most three) winners.
    distinct = materialize(
        full.groupBy(*G, "cid", "text_id")
        .agg(F.max(F.struct("score", (-F.col("row_id")).alias("neg"))).alias("b"))
        .select(*G, "cid", F.col("b.score").alias("score"), F.col("b.neg").alias("neg")), "quote-candidates")
    q = top_n(distinct, G + ["cid"], [F.col("score"), F.col("neg")], ["neg"], K.THEME_MAX_QUOTES)
    # The answers stream past the winners' row ids.
    q = materialize(q.withColumn("row_id", -F.col("neg")), "quote-rows")
    q = (F.broadcast(q) if q.count() <= QUOTE_BROADCAST_MAX_ROWS else q).join(answers.select(*G, "row_id", "answer"), G + ["row_id"])
    quotes = q.groupBy(*G, "cid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rnk", "answer"))), lambda x: x["answer"]).alias("quotes"))
    t = top_n(heavy, G + ["cid"], [F.col("tw"), F.lit(0) - F.xxhash64("term")], ["term"], TITLE_TERMS)
    titles = t.groupBy(*G, "cid").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rnk", "term"))), lambda x: x["term"]), " ")
        .alias("title"))
    out = (counts.join(quotes, G + ["cid"], "left").join(titles, G + ["cid"], "left")
           .select(*G, F.col("cid").cast("bigint").alias("theme_id"),
                   F.when(F.col("cid") == k, F.lit(OTHER_TITLE))
                   .otherwise(F.coalesce(F.initcap("title"), F.lit(OTHER_TITLE))).alias("title"),
                   "count", F.coalesce("quotes", F.array().cast("array<string>")).alias("quotes")))
    return out


def theme_cards(th: DataFrame) -> DataFrame:
    """L9 + E2 + C16 + C18: ranked, escaped card rows."""
    from rsvpark.operators.ranking import competition_rank
    r = competition_rank(th, "count", by=G)
    return r.select(*G, "theme_id", "rank", rank_text("rank").alias("rank_text"),
                    html_escape("title").alias("title_html"), "count",
                    F.concat(F.col("count").cast("string"), F.lit(" attendees")).alias("count_text"),
                    F.transform("quotes", lambda x: html_escape(x)).alias("quotes_html"))


def theme_audit(th: DataFrame, answers: DataFrame, genuine: DataFrame) -> DataFrame:
    """Check a theme table against the contract.

    ``genuine(event_id, key, n_genuine)`` is answers minus filler.  Quotes
    must be verbatim answers; at most three quotes, titles under six words,
    at most six themes, each count within the genuine answers.  A sum of
    counts above the genuine answers is only a warning.
    """
    q = th.select(*G, "theme_id", F.explode("quotes").alias("answer"))
    # The answers stream past the quote set (at most three per theme, counted
    # before it is broadcast); only quotes found come back, so answer texts
    # are never shuffled for the check.
    wanted = q.select(*G, "answer").distinct()
    small = wanted.count() <= QUOTE_BROADCAST_MAX_ROWS
    found = (answers.select(*G, "answer").join(F.broadcast(wanted) if small else wanted, G + ["answer"], "left_semi")
             .distinct())
    bad_q = (q.join(found, G + ["answer"], "left_anti")
             .groupBy(*G).agg(F.count(F.lit(1)).alias("bad_quotes")))
    words = F.size(F.split(strip_ws("title"), r"(?U)\s+"))
    per = th.groupBy(*G).agg(
        F.count(F.lit(1)).alias("n_themes"),
        F.sum("count").cast("bigint").alias("sum_counts"),
        F.max("count").cast("bigint").alias("max_count"),
        F.count_if(F.size("quotes") > K.THEME_MAX_QUOTES).alias("too_many_quotes"),
        F.count_if(words >= K.THEME_MAX_TITLE_WORDS).alias("long_titles"))
    j = (per.join(genuine, G, "left").join(bad_q, G, "left")
         .fillna({"bad_quotes": 0, "n_genuine": 0}))
    ok = ((F.col("n_themes") <= K.THEME_MAX_COUNT) & (F.col("bad_quotes") == 0)
          & (F.col("too_many_quotes") == 0) & (F.col("long_titles") == 0)
          & (F.col("max_count") <= F.col("n_genuine")))
    return j.select(*G, "n_themes", "sum_counts", "n_genuine",
                    F.col("bad_quotes").cast("bigint").alias("bad_quotes"),
                    F.col("too_many_quotes").cast("bigint").alias("too_many_quotes"),
                    F.col("long_titles").cast("bigint").alias("long_titles"),
                    ok.alias("ok"), (F.col("sum_counts") > F.col("n_genuine")).alias("warn_overlap"))


# ---------------------------------------------------------------------------
# Theme JSON
# ---------------------------------------------------------------------------

def strip_fence(text: Column | str) -> Column:
    """Remove a leading ```json fence and a trailing ``` fence."""
    t = strip_ws(F.col(text) if isinstance(text, str) else text)
    return F.regexp_replace(t, r"^```json\s*|\s*```$", "")


def parse_theme_json(text: Column | str, strict: bool = False) -> Column:
    """Theme-file struct; a bad document gives empty lists (or fails in strict mode)."""
    schema = T.StructType(THEME_FILE.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(strip_fence(text), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    bad = parsed.isNull() | parsed["_corrupt"].isNotNull()
    empty = F.array().cast("array<struct<title:string,count:int,quotes:array<string>>>")

    def field(name: str) -> Column:
        return F.when(~bad, parsed[name])

    out = F.struct(
        F.coalesce(field("speaker_question_clusters"), empty).alias("speaker_question_clusters"),
        F.coalesce(field("future_topic_clusters"), empty).alias("future_topic_clusters"),
        field("non_specific_speaker_count").alias("non_specific_speaker_count"),
        field("non_specific_topics_count").alias("non_specific_topics_count"),
        F.coalesce(field("timeline_insight"), F.lit("")).alias("timeline_insight"),
        F.coalesce(field("role_insight"), F.lit("")).alias("role_insight"),
    )
    if strict:
        return F.when(bad, F.raise_error(F.lit("theme file is not valid JSON"))).otherwise(out)
    return out


def read_theme_files(spark, path: str, strict: bool = False) -> DataFrame:
    """One theme file per event: ``(source_file, themes struct)``."""
    raw = spark.read.text(path, wholetext=True)   # the keyword: text() would reset the option
    return raw.select(F.col("_metadata.file_path").alias("source_file"),
                      parse_theme_json("value", strict).alias("themes"))


def theme_rows_from_file(parsed: DataFrame, event_col: str = "event_id") -> DataFrame:
    """Flatten a parsed theme struct to ``themes(event_id, key, theme_id, title, count, quotes)``."""
    lists = F.array(
        F.struct(F.lit("speaker_q").alias("key"), F.col("themes.speaker_question_clusters").alias("cl")),
        F.struct(F.lit("future_topics").alias("key"), F.col("themes.future_topic_clusters").alias("cl")))
    x = parsed.select(event_col, F.inline(lists))
    y = x.select(event_col, "key", F.posexplode("cl").alias("theme_id", "c"))
    return y.select(F.col(event_col).alias("event_id"), "key", F.col("theme_id").cast("bigint").alias("theme_id"),
                    F.coalesce("c.title", F.lit("")).alias("title"),
                    F.coalesce("c.count", F.lit(0)).cast("bigint").alias("count"),
                    F.coalesce("c.quotes", F.array().cast("array<string>")).alias("quotes"))
