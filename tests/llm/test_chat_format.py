"""Chat formatting: spans by incremental rendering, round trips, templates that rewrite history."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rsvpark.llm import chat_format as C
from rsvpark.llm.queries import MARKS, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["", MARKS, "### user: </turn>\n", "####", "</turn></turn>", "\\", "\\\\h", "a\n### b", "<", "#", "\ue000", "é𝄞", ": "]


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_query_equals_the_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)]
    assert digests(QUERIES["op13_chat_format"](spark, SF_SMALL)) == brute.chat_digests(rows)


def test_nulls_ties_repeats_marks_and_clashing_columns(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(6), rng.choice([None, 0, 1, 1, 2]), rng.choice(["user", "assistant", "a: b", None, "x\n### y"]), rng.choice([*NASTY, None]))
            for _ in range(120)]
    rows += [(None, 0, "user", "lost"), rows[0], (9, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as formatted", "'q' as loss", "2 as turns", "'z' as rewritten_at").repartition(3)
    assert digests(C.read_back(C.format_conversations(df))) == brute.chat_digests(rows)


def test_empty_table_and_long_conversation(spark):
    assert digests(C.read_back(C.format_conversations(spark.createDataFrame([], SCHEMA)))) == {}
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} " * 50) for t in range(300)] + [(2, 0, "assistant", "x" * 3_000_000)]
    assert digests(C.read_back(C.format_conversations(spark.createDataFrame(rows, SCHEMA)))) == brute.chat_digests(rows)


TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a:b", "#<\\\n"]),
                           st.one_of(st.sampled_from(NASTY), st.text("\\#</turn>hlcn: \n", max_size=20))), max_size=6)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_marked_turns_round_trip_and_spans(turns):
    t = C.MarkedTurns()
    r = C.locate(t, turns)
    assert t.parse(r.formatted) == turns
    assert r.rewritten_at is None
    assert [t.unescape(r.formatted[s[2]:s[3]]) for s in r.spans] == [x for _, x in turns]
    assert [s[0] for s in r.spans] + [len(r.formatted)] == [0] * (not turns) + [s[0] for s in r.spans[:1]] + [s[1] for s in r.spans]


def closing(turns):
    return "<s>" + "".join(f"<|{r}|>{x}\n" for r, x in turns) + "</s>"


def strips_earlier(turns):
    last = len(turns) - 1
    return "".join(f"[{r}]{x if i == last else x.split('=>')[-1]}[/]" for i, (r, x) in enumerate(turns))


def numbers_turns(turns):
    return f"({len(turns)})" + "".join(f"[{r}]{x}" for r, x in turns)


def drops_text(turns):
    return "".join(f"[{r}]" for r, _ in turns)


def test_moving_close_mark_is_not_rewriting():
    turns = [("user", "hi"), ("assistant", "</s>"), ("user", "<")]
    r = C.locate(closing, turns)
    assert r.formatted == closing(turns) and r.rewritten_at is None
    assert [r.formatted[s[2]:s[3]] for s in r.spans] == ["hi", "</s>", "<"]


@pytest.mark.parametrize("render,at", [(strips_earlier, 2), (numbers_turns, 0)])
def test_rewritten_history_is_found(render, at):
    turns = [("user", "q"), ("assistant", "thought=>yes"), ("user", "more")]
    r = C.locate(render, turns)
    assert (r.rewritten_at, r.spans, r.formatted) == (at, None, render(turns))
    # without anything to strip, the same template only appends
    assert C.locate(strips_earlier, [("user", "q"), ("assistant", "yes"), ("user", "more")]).rewritten_at is None


def test_text_that_the_template_hides_has_no_bounds():
    r = C.locate(drops_text, [("user", "a"), ("assistant", "b")])
    assert [s[2:] for s in r.spans] == [(-1, -1), (-1, -1)]


def test_rewriting_template_gets_no_mask(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "t=>yes"), (1, 2, "user", "x"), (2, 0, "assistant", "ok")]
    out = {r.conv_id: r for r in C.format_conversations(spark.createDataFrame(rows, SCHEMA), strips_earlier).collect()}
    assert out[1].rewritten_at == 2 and out[1].loss is None
    assert out[2].rewritten_at is None and [out[2].formatted[s.start:s.end] for s in out[2].loss] == ["ok"]
