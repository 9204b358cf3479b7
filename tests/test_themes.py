"""Themes, similar groups and theme JSON against brute force on small inputs."""

import pytest
from pyspark.sql import functions as F

from rsvpark.operators import similar, themes

ANSWERS = [
    ("e1", "speaker_q", 1, "How do agents plan long tasks?"),
    ("e1", "speaker_q", 2, "How do agents plan tasks with tools?"),
    ("e1", "speaker_q", 3, "What does evaluation cost?"),
    ("e1", "speaker_q", 4, "What does evaluation of agents cost?"),
    ("e1", "speaker_q", 5, "How do agents plan long tasks?"),
    ("e1", "speaker_q", 6, "Pricing of GPUs"),
    ("e1", "speaker_q", 7, "GPU pricing for startups"),
    ("e1", "speaker_q", 8, "???"),
    ("e2", "speaker_q", 9, "How do agents plan long tasks?"),
    ("e2", "speaker_q", 10, "Open models versus closed models"),
]


@pytest.fixture(scope="module")
def answers(spark):
    return spark.createDataFrame(ANSWERS, "event_id string, key string, row_id long, answer string")


def test_theme_contract(spark, answers):
    th = themes.themes(answers, k=3, iterations=3).collect()
    per = {}
    for r in th:
        per.setdefault(r.event_id, []).append(r)
    n_in = {"e1": 8, "e2": 2}
    texts = {a[3] for a in ANSWERS}
    for ev, rows in per.items():
        assert sum(r["count"] for r in rows) == n_in[ev]       # disjoint, complete
        assert len(rows) <= 6
        for r in rows:
            assert len(r.quotes) <= 3 and set(r.quotes) <= texts   # verbatim
            assert len(r.quotes) == len(set(r.quotes))
            assert len(r.title.split()) < 6


def test_join_strategies_agree(spark, answers, monkeypatch):
    """The shuffle-join paths (idf table and centroids over their broadcast
    bounds) give the same points and themes as the broadcast paths."""
    def run():
        pts, n_terms = themes.tfidf(answers)
        got = sorted((r.event_id, r.row_id, r.term, round(r.w, 9)) for r in pts.collect())
        th = sorted((r.event_id, r.theme_id, r["count"], r.title, tuple(r.quotes))
                    for r in themes.themes(answers, k=3, iterations=3).collect())
        return n_terms, got, th
    small = run()
    monkeypatch.setattr(themes, "IDF_BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(themes, "BROADCAST_MAX_ROWS", 0)
    assert run() == small
    assert small[0] == len({(e, t) for e, _, t, _ in small[1]})


def test_theme_audit_flags(spark, answers):
    genuine = answers.groupBy("event_id", "key").agg(F.count("*").alias("n_genuine"))
    good = themes.themes(answers, k=3, iterations=2)
    assert all(r.ok for r in themes.theme_audit(good, answers, genuine).collect())
    bad = spark.createDataFrame(
        [("e1", "speaker_q", 0, "a b c d e f g", 99, ["not an answer"])],
        "event_id string, key string, theme_id long, title string, count long, quotes array<string>")
    r = themes.theme_audit(bad, answers, genuine).collect()[0]
    assert not r.ok and r.bad_quotes == 1 and r.long_titles == 1


def _words(text):
    import re
    return frozenset(re.findall(r"[^\W_]+", text.lower()))


def _brute_groups(rows):
    """row -> smallest row of its component under Jaccard >= NUM / DEN, per (event, list)."""
    parent = {r[:3]: r[:3] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in rows:
        for y in rows:
            a, b = _words(x[3]), _words(y[3])
            if x[:2] == y[:2] and a and b and similar.DEN * len(a & b) >= similar.NUM * len(a | b):
                p, q = find(x[:3]), find(y[:3])
                parent[max(p, q)] = min(p, q)
    return {r: find(r)[2] for r in parent}


def test_similar_groups_match_pairwise_comparison(spark):
    import collections
    import random
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        if rows and rng.random() < 0.6:
            w = list(_words(rng.choice(rows)[3])) or ["x"]
            w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = rng.sample(vocab, rng.randrange(1, 15))
        rows.append((rng.choice(["e1", "e2"]), "speaker_q", i, ("?? " if i % 40 == 0 else "") + " ".join(w) if i % 53 else "!?"))
    df = spark.createDataFrame(rows, "event_id string, key string, row_id long, answer string")
    want = collections.Counter((r[0], g) for r, g in _brute_groups(rows).items())
    out = similar.similar_groups(df).collect()
    assert {(r.event_id, r.group_id): r.n_answers for r in out} == want
    assert all(r.example == rows[r.group_id][3] for r in out)


def test_a_family_of_near_copies_gives_links_in_proportion(spark):
    """400 answers that all link: far fewer links than their 79,800 pairs, and one group."""
    import random
    rng = random.Random(2)
    base = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(400):
        w = list(base)
        w[rng.randrange(30)] = f"x{i}"
        rows.append(("e", "speaker_q", i, " ".join(w)))
    rows += [("e", "speaker_q", 1000 + i, " ".join(f"y{i}z{j}" for j in range(6)) + " w1 w2") for i in range(50)]
    df = spark.createDataFrame(rows, "event_id string, key string, row_id long, answer string")
    sets = similar.materialize(similar.word_sets(df), "t")
    assert similar.similar_links(sets).count() < 4000
    groups = {r.group_id: r.n_answers for r in similar.similar_groups(df).collect()}
    assert groups == {0: 400} | {1000 + i: 1 for i in range(50)}


def test_word_lists_move_only_for_pairs_that_their_first_words_allow(spark, monkeypatch):
    """60 answers that share words but link with none: hardly any pair gets as far as its word lists."""
    import random
    rng = random.Random(9)
    rows = [("e", "speaker_q", i, " ".join([f"g{i % 6}", *rng.sample([f"w{j}" for j in range(80)], 19)])) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id string, key string, row_id long, answer string")
    seen, real = [], similar._verified
    monkeypatch.setattr(similar, "_verified", lambda pairs, one: seen.append(pairs.count()) or real(pairs, one))
    assert similar.similar_groups(df).count() == 60
    assert sum(seen) <= 30, seen


def test_similar_groups_leave_one_table(spark, answers):
    import os
    from rsvpark.session import shared_path
    work = shared_path(spark, "rsvpark-work").removeprefix("file:")
    before = set(os.listdir(work)) if os.path.isdir(work) else set()
    similar.similar_groups(answers)
    new = set(os.listdir(work)) - before
    assert len(new) == 1 and new.pop().startswith("similar-")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("rsvpark_answers")]


def test_similar_groups_cover_all_answers(spark, answers):
    g = similar.similar_groups(answers).collect()
    assert sum(r.n_answers for r in g) == len(ANSWERS)


def test_theme_json_parse(spark):
    good = ('```json\n{"speaker_question_clusters": [{"title": "Agents", "count": 2, '
            '"quotes": ["How?"]}], "future_topic_clusters": [], "timeline_insight": "x"}\n```')
    df = spark.createDataFrame([("e1", good), ("e2", "not json")], "event_id string, text string")
    parsed = df.select("event_id", themes.parse_theme_json("text").alias("themes"))
    rows = {r.event_id: r for r in themes.theme_rows_from_file(parsed).collect()}
    assert rows["e1"].title == "Agents" and rows["e1"]["count"] == 2
    assert "e2" not in rows           # bad JSON -> empty lists
    strict = df.select(themes.parse_theme_json("text", strict=True).alias("t"))
    with pytest.raises(Exception):
        strict.collect()


def test_theme_files_from_folder(spark, workdir):
    import os
    with open(os.path.join(workdir, "clusters.json"), "w") as f:
        f.write('{"speaker_question_clusters": [], "future_topic_clusters": '
                '[{"title": "RAG", "count": 3, "quotes": ["rag", "retrieval"]}]}')
    t = themes.read_theme_files(spark, workdir).collect()[0].themes
    assert t.future_topic_clusters[0].title == "RAG"


def test_free_text_topics_use_theme_rows(spark, workdir):
    from rsvpark.operators import kpis
    from rsvpark.plans.theme_store import topic_bar_rows
    from rsvpark.sources.csv_export import read_exports
    from tests.trap import write_csv
    rows = [f"2025-09-0{1 + i % 5} 10:00:00,{t}" for i, t in enumerate(
        ["more on agent planning", "agent planning in practice", "evaluation of agents", "GPU pricing",
         "pricing of GPUs", "n/a", "  ", "how to evaluate models", "agent planning tools"])]
    write_csv(workdir, "free.csv", "Order Date,Which future topic?", rows)
    regs, _, _ = read_exports(spark, workdir)
    k = kpis.event_kpis(regs)
    mode = kpis.topic_mode(regs, k)
    assert not mode.collect()[0].topics_are_choices
    ans = themes.theme_inputs(regs, mode)
    assert ans.count() == 7              # "n/a" is a missing-value token, "  " is blank
    th = themes.themes(ans, k=2, iterations=2)
    out = topic_bar_rows(regs, k, mode, th).orderBy("pos").collect()
    assert out[-1].label == "No specific ask / blank" and out[-1].n == 2
    assert sum(r.n for r in out[:-1]) == 7
    assert [r.n for r in out[:-1]] == sorted((r.n for r in out[:-1]), reverse=True)


def test_components_on_a_long_chain_take_few_rounds(spark, monkeypatch):
    """A chain of 300 answers (each shares one bucket with the next) and a
    separate pair: one round per halving, not one per link."""
    import random
    ids = random.Random(3).sample(range(10_000), 302)
    chain, pair = ids[:300], ids[300:]
    rows = []
    for i in range(299):
        rows += [("e", "q", chain[i], 0, [i, 0]), ("e", "q", chain[i + 1], 0, [i, 0])]
    rows += [("e", "q", pair[0], 1, [7, 7]), ("e", "q", pair[1], 1, [7, 7])]
    members = spark.createDataFrame(rows, "event_id string, key string, row_id long, band int, bucket array<long>")
    writes = []
    real = similar.materialize
    monkeypatch.setattr(similar, "materialize", lambda df, tag="work": writes.append(tag) or real(df, tag))
    got = {r.row_id: r.group_id for r in similar.connected_components(members).collect()}
    assert got == {**{x: min(chain) for x in chain}, **{x: min(pair) for x in pair}}
    assert writes.count("labels") <= 12


def test_audit_join_paths_agree(spark, answers, monkeypatch):
    genuine = answers.groupBy("event_id", "key").agg(F.count("*").alias("n_genuine"))
    th = spark.createDataFrame(
        [("e1", "speaker_q", 0, "Agents", 3, ["How do agents plan long tasks?", "made up"]),
         ("e2", "speaker_q", 0, "Models", 1, ["Open models versus closed models"])],
        "event_id string, key string, theme_id long, title string, count long, quotes array<string>")
    def run():
        return sorted((r.event_id, r.bad_quotes, r.ok, r.n_genuine)
                      for r in themes.theme_audit(th, answers, genuine).collect())
    small = run()
    monkeypatch.setattr(themes, "QUOTE_BROADCAST_MAX_ROWS", 0)
    assert run() == small
    assert small == [("e1", 1, False, 8), ("e2", 0, True, 2)]


def test_theme_file_spanning_lines_is_one_document(spark, workdir):
    """A fenced, pretty-printed theme file (as a model or a person writes it)
    is parsed whole, not line by line."""
    import os
    text = ('```json\n{\n  "speaker_question_clusters": [\n    {"title": "Agents", "count": 2,\n'
            '     "quotes": ["How?", "Why?"]}\n  ],\n  "future_topic_clusters": [],\n'
            '  "timeline_insight": "Peak on Mon"\n}\n```\n')
    with open(os.path.join(workdir, "event-a.json"), "w") as f:
        f.write(text)
    rows = themes.read_theme_files(spark, workdir).collect()
    assert len(rows) == 1
    t = rows[0].themes
    assert t.speaker_question_clusters[0].quotes == ["How?", "Why?"]
    assert t.timeline_insight == "Peak on Mon"


def test_bucketed_answers_give_the_same_themes(spark, answers):
    """Answers written bucketed on (event, list, answer) skip the repartition
    and give the same points and themes."""
    from rsvpark.session import bucketed
    b = bucketed(answers, ["event_id", "key", "row_id"], "answers")
    pts_plain, n_plain = themes.tfidf(answers)
    pts_b, n_b = themes.tfidf(b, prepartitioned=True)
    key = lambda r: (r.event_id, r.row_id, r.term, round(r.w, 9))       # noqa: E731
    assert n_plain == n_b
    assert sorted(map(key, pts_plain.collect())) == sorted(map(key, pts_b.collect()))
    th = lambda df: sorted((r.event_id, r["count"], r.title, tuple(r.quotes)) for r in df.collect())
    assert th(themes.themes(answers, k=3, iterations=3)) == th(themes.themes(b, k=3, iterations=3,
                                                                              prepartitioned=True))
    plan = pts_b._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan


def test_work_scope_removes_work_tables(spark, answers):
    """Tables written inside a work scope are gone after it; results read
    inside the scope are whole."""
    from rsvpark import session as S
    with S.work_scope(spark):
        rows = themes.themes(answers, k=3, iterations=2).collect()
        created = list(S._scopes()[-1])
    assert sum(r["count"] for r in rows) == len(ANSWERS)
    assert any(t for _, t in created) and len(created) > 5
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path, _ in created:
        p = jvm.org.apache.hadoop.fs.Path(path)
        assert not p.getFileSystem(conf).exists(p), path
    names = {t.name for t in spark.catalog.listTables()}
    assert not names & {t for _, t in created if t}


def _answers(spark, texts, event="e"):
    return spark.createDataFrame([(event, "speaker_q", i, t) for i, t in enumerate(texts)],
                                 "event_id string, key string, row_id long, answer string")


def test_every_term_counts_in_lists_of_any_size(spark):
    for n in (1, 9, 10, 30):
        points = themes.tfidf(_answers(spark, [f"common solo{i}" for i in range(n)]))[0].collect()
        assert len(points) == 2 * n and all(p.w > 0 for p in points)


def test_rounds_end_where_no_answer_moves(spark):
    import random
    rng = random.Random(8)
    texts = [" ".join(f"w{min(39, int(rng.expovariate(0.08)))}" for _ in range(6)) for _ in range(150)]
    points, n = themes.tfidf(_answers(spark, texts))
    assign, cent = themes.kmeans(points, 5, None, n)
    got = {r.row_id: r for r in assign.collect()}
    c = {}
    for r in cent.collect():
        c.setdefault(r.cid, {})[r.tid] = r.cw
    vec = {}
    for p in points.collect():
        vec.setdefault(p.row_id, {})[p.tid] = p.w
    want = {}
    for row, r in got.items():
        for t, w in vec[row].items():
            want.setdefault(r.cid, {}).setdefault(t, 0.0)
            want[r.cid][t] += w
    assert {k: set(v) for k, v in c.items()} == {k: set(v) for k, v in want.items()}
    assert all(abs(c[k][t] - want[k][t]) < 1e-9 for k in c for t in c[k])
    for row, r in got.items():
        for x in c.values():
            score = sum(w * x.get(t, 0.0) for t, w in vec[row].items()) / sum(v * v for v in x.values()) ** 0.5
            assert score <= r.score + 2 * themes.MOVE_GAIN


def test_a_long_role_label_leaves_the_numbers(spark):
    from rsvpark.operators import report
    peak = spark.createDataFrame([("e", None, None, None, None, 7), ("f", None, None, None, None, 7)],
                                 "event_id string, peak_day date, peak_label string, peak_n long, peak_pct long, total long")
    roles = spark.createDataFrame([("e", "x" * 300, 3, 1), ("f", "Teacher", 3, 1)], "event_id string, label string, n long, pos int")
    got = {r.event_id: r.role_insight for r in report.insights(peak, roles).collect()}
    end = " is the most picked role (3 picks across 7 registrations)."
    assert got["e"].endswith("x\u2026" + end) and len(got["e"]) == 159 and got["f"] == "Teacher" + end


def test_rounds_move_centroids_not_points(spark, answers, monkeypatch):
    """When centroids are too many to broadcast, no round shuffles the points by term."""
    import re
    monkeypatch.setattr(themes, "BROADCAST_MAX_ROWS", 0)
    real, plans = themes.materialize, []

    def seen(df, tag="work"):
        if tag == "assign":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, tag)

    monkeypatch.setattr(themes, "materialize", seen)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points, n = themes.tfidf(answers)
        themes.kmeans(points, 5, 1, n)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plans
    for p in plans:
        assert len(re.findall(r"Exchange hashpartitioning\(event_id#\w+, key#\w+, tid#", p)) <= 1, p


def test_blocks_of_terms_give_what_joins_give(spark, monkeypatch):
    """Rounds to their end over blocks of terms, with settled answers left out, against the joins; row ids that
    come twice are one answer there, and answers without a list, a row id or a word stay in the last theme."""
    import random
    from rsvpark.operators import theme_blocks
    rng = random.Random(5)
    rows = []
    for event in ("e1", "e2"):
        for i in range(90):
            words = [f"{'ab'[i % 2]}{min(30, int(rng.expovariate(0.1)))}" for _ in range(rng.randrange(1, 12))]
            rows.append((event, "speaker_q" if i % 3 else "future_topics", i, " ".join(words) + (" Ä 好的" if i % 7 == 0 else "")))
    rows += [rows[3], ("e1", rows[4][1], rows[4][2], "a1 b2 a1"), ("e2", "speaker_q", 500, "!?"), (None, "speaker_q", 501, "a1"), ("e3", "speaker_q", 502, "?")]
    df = spark.createDataFrame(rows, "event_id string, key string, row_id long, answer string")
    monkeypatch.setattr(theme_blocks, "CHUNK_TOKENS", 50)
    monkeypatch.setattr(theme_blocks, "ROW_POSTINGS", 40)

    def run():
        got = themes.themes(df).collect()
        assert sum(r["count"] for r in got) == len(rows)
        return sorted((str(r.event_id), r.key, r.theme_id, r.title, r["count"], tuple(sorted(r.quotes))) for r in got)     # of two answers both lie as near

    blocks = run()
    monkeypatch.setattr(theme_blocks, "ANSWERS_MAX", -1)
    assert run() == blocks


def test_rounds_write_neither_points_nor_texts(spark, answers, monkeypatch):
    """The theme job keeps postings of whole terms; it wrote every answer and every point again before."""
    real, tags = themes.bucketed, []
    monkeypatch.setattr(themes, "bucketed", lambda df, keys, tag="work", *a, **b: tags.append((tag, df.columns)) or real(df, keys, tag, *a, **b))
    assert sum(r["count"] for r in themes.themes(answers).collect()) == len(ANSWERS)
    assert tags and not [t for t, c in tags if "answer" in c or "term" in c or t == "points"], tags


def test_long_texts_are_trimmed_as_short_ones(spark):
    from rsvpark.functions.text import strip_long, strip_ws
    texts = ["", " ", "a", " a", "a\u3000", "\x1ca b\x1f", "a b", "\u00a0x\n", None, "\U00020000 ", "\u2003\U00020000"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(strip_long("t").alias("a"), strip_ws("t").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_only_crowded_words_have_rounds_of_centres(spark, monkeypatch):
    """Lists without a crowded word are compared at once; with any bound the groups are those of all pairs, and
    answers in parts (one row id in two rows) are one set."""
    import collections
    import random
    rng = random.Random(12)
    rows = []
    for i in range(90):
        w = rng.sample([f"w{j}" for j in range(50)], 6) if not rows or rng.random() < 0.4 else rng.choice(rows)[3].split()
        w[rng.randrange(len(w))] = f"w{rng.randrange(50)}"
        rows.append((rng.choice(["e1", "e2"]), "speaker_q", i, " ".join(w)))
    df = spark.createDataFrame(rows + [rows[5]], "event_id string, key string, row_id long, answer string")
    calls, real = [], similar._verified
    monkeypatch.setattr(similar, "_verified", lambda *a: calls.append(1) or real(*a))
    want = collections.Counter((r[0], g) for r, g in _brute_groups(rows).items())
    want[rows[5][0], _brute_groups(rows)[rows[5][:3]]] += 1
    for bound, rounds in ((256, 0), (2, 1)):
        monkeypatch.setattr(similar, "CROWD", bound)
        calls.clear()
        got = similar.similar_groups(df).dropDuplicates(["event_id", "group_id"]).collect()
        assert {(r.event_id, r.group_id): r.n_answers for r in got} == want
        assert (len(calls) > 1) == bool(rounds)


def test_similar_groups_leave_no_shuffle_files_between_rounds(spark, answers, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, was, real = [], spark.conf.get(key, "false"), similar.materialize
    monkeypatch.setattr(similar, "materialize", lambda df, tag="work": seen.append(spark.conf.get(key)) or real(df, tag))
    similar.similar_groups(answers)
    assert seen and set(seen) == {"true"} and spark.conf.get(key, "false") == was
