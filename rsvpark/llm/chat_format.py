"""Chat formatting by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string.
Nothing else is asked of it: each conversation's successive turn prefixes are
rendered and consecutive outputs compared.  If an output begins with the one
before, the rest is the new turn; two probe texts in the turn's place show
where its text begins and ends.  A fixed closing mark that moves to the end of
each output is recognised as the common end of all of them.  Any other change of
earlier output means that the template rewrites history: ``rewritten_at`` names
the first turn that causes it, and no span or loss mask is given, since training
on the whole would not match what the model sees turn by turn.

``MarkedTurns``, the default template, writes ``### role: text</turn>`` per turn
and escapes its control strings, so that a text that holds them can be told from
a real mark and read back unchanged.

A conversation's turns are streamed to its task in order, and one conversation
is held at a time; rendering its prefixes costs its length times its turns.

Defined cases.  Turns are ordered by ``turn`` (null first), then role, then
text.  A null role or text is empty.  A row without ``conv_id`` belongs to no
conversation and is left out.  Repeated rows are repeated turns.  An empty table
gives no rows.  Columns other than ``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Render = Callable[[Sequence[Turn]], str]

LEARNT = "assistant"
FLUSH = 1 << 20
_PROBES = ("\ue000", "\ue001")

FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("turns", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "text_start", "text_end")]))),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("rewritten_at", pa.int64())])
FORMATTED_DDL = ("conv_id long, n_turns long, formatted string, turns array<struct<start:long,end:long,text_start:long,text_end:long>>, "
                 "loss array<struct<start:long,end:long>>, rewritten_at long")
READ_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten_at long"


class MarkedTurns:
    """``### role: text</turn>`` and a line feed per turn.

    Inside a text, a backslash is doubled and the first character of ``###`` or ``</turn>`` becomes
    ``\\h`` or ``\\l``; in a role, also a colon and a line feed become ``\\c`` and ``\\n``.
    """

    OPEN, CLOSE = "### ", "</turn>\n"
    _LETTER = {"\\": "\\", "#": "h", "<": "l", ":": "c", "\n": "n"}
    _BACK = {v: k for k, v in _LETTER.items()}
    _IN_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
    _IN_ROLE = re.compile(r"[\\#<:\n]")
    _ESCAPED = re.compile(r"\\(.)")

    def __call__(self, turns: Sequence[Turn]) -> str:
        return "".join([f"{self.OPEN}{self._hide(self._IN_ROLE, role)}: {self._hide(self._IN_TEXT, text)}{self.CLOSE}" for role, text in turns])

    def _hide(self, what: re.Pattern, s: str) -> str:
        return what.sub(lambda m: "\\" + self._LETTER[m[0]], s)

    def unescape(self, s: str) -> str:
        return self._ESCAPED.sub(lambda m: self._BACK[m[1]], s)

    def parse(self, formatted: str) -> list[Turn]:
        """The turns that a formatted conversation was made of."""
        out, at = [], 0
        while at < len(formatted):
            colon = formatted.index(": ", at)
            close = formatted.index(self.CLOSE, colon)
            if not formatted.startswith(self.OPEN, at):
                raise ValueError(f"no turn begins at {at}")
            out.append((self.unescape(formatted[at + len(self.OPEN):colon]), self.unescape(formatted[colon + 2:close])))
            at = close + len(self.CLOSE)
        return out


@dataclass
class Located:
    """A rendered conversation: of each turn ``(start, end, text_start, text_end)`` in code points
    (text bounds -1 where the template doesn't show the text as one piece)."""

    formatted: str
    spans: list[tuple[int, int, int, int]] | None
    rewritten_at: int | None


def _common(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _text_bounds(one: str, other: str, turn: str) -> tuple[int, int]:
    """Bounds of the text inside a turn's output, from the outputs of two one-character probes."""
    head = _common(one, other)
    foot = _common(one[head:][::-1], other[head:][::-1])
    if head == min(len(one), len(other)) or len(one) != head + 1 + foot or len(turn) < head + foot or turn[:head] != one[:head] or turn[len(turn) - foot:] != one[len(one) - foot:]:
        return -1, -1
    return head, len(turn) - foot


def locate(render: Render, turns: Sequence[Turn]) -> Located:
    """Spans of all turns in the whole conversation's output, by rendering its prefixes."""
    found = _walk(render, turns, "")
    if found.rewritten_at is not None:
        tail = _closing(render, turns)
        if tail:
            again = _walk(render, turns, tail)
            if again.rewritten_at is None:
                return again
    return found


def _closing(render: Render, turns: Sequence[Turn]) -> str:
    """What all prefixes' outputs end with."""
    tail = render(())
    for i in range(len(turns)):
        if not tail:
            break
        out = render(turns[:i + 1])
        k = _common(tail[::-1], out[::-1])
        tail = tail[len(tail) - k:]
    return tail


def _walk(render: Render, turns: Sequence[Turn], tail: str) -> Located:
    def body(prefix: Sequence[Turn]) -> str:
        out = render(prefix)
        return out[:len(out) - len(tail)] if tail and out.endswith(tail) else out

    spans, before = [], body(())
    for i, (role, _) in enumerate(turns):
        now = body(turns[:i + 1])
        if not now.startswith(before):
            return Located(render(turns), None, i)
        at = len(before)
        probes = [body([*turns[:i], (role, p)]) for p in _PROBES]
        lo, hi = _text_bounds(*[p[at:] for p in probes], now[at:]) if all(p.startswith(before) for p in probes) else (-1, -1)
        spans.append((at, len(now), at + lo if lo >= 0 else -1, at + hi if lo >= 0 else -1))
        before = now
    return Located(before + tail, spans, None)


def _conversations(batches):
    """Sorted rows to ``(conv_id, turns)``; one conversation is held."""
    conv, turns = None, []
    for b in batches:
        ids, roles, texts = (b.column(i) for i in range(3))
        for i in range(b.num_rows):
            c = ids[i].as_py()
            if c != conv:
                if conv is not None:
                    yield conv, turns
                conv, turns = c, []
            turns.append((roles[i].as_py(), texts[i].as_py()))
    if conv is not None:
        yield conv, turns


def format_conversations(conversations: DataFrame, render: Render | None = None, learnt: str = LEARNT) -> DataFrame:
    """One row per conversation: ``formatted``, its ``turns``' spans, the ``loss`` mask (text spans of
    ``learnt`` turns) and ``rewritten_at`` (null unless the template rewrites history)."""
    render = render or MarkedTurns()

    def run(batches):
        rows, size = [], 0
        for conv, turns in _conversations(batches):
            r = locate(render, turns)
            names = ("start", "end", "text_start", "text_end")
            spans = None if r.spans is None else [dict(zip(names, s)) for s in r.spans]
            loss = None if r.spans is None else [{"start": s[2], "end": s[3]} for s, t in zip(r.spans, turns) if t[0] == learnt and s[2] >= 0]
            rows.append((conv, len(turns), r.formatted, spans, loss, r.rewritten_at))
            size += len(r.formatted)
            if size > FLUSH:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    turn, text = F.col("turn").asc_nulls_first(), F.coalesce("text", F.lit(""))
    return (conversations.where("conv_id is not null")
            .select("conv_id", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), F.col("turn").cast("long").alias("turn"))
            .repartition("conv_id").sortWithinPartitions("conv_id", turn, "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, FORMATTED_DDL))


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), FORMATTED)], schema=FORMATTED)


def read_back(formatted: DataFrame, template: MarkedTurns | None = None) -> DataFrame:
    """Digests of what the formatted conversations say: turns by parsing, the loss text by the mask.
    Where the template rewrote history there is no mask, so no loss text."""
    template = template or MarkedTurns()
    names = [f.split()[0] for f in READ_DDL.split(", ")]

    def run(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                conv, text, loss, at = (b.column(k)[i].as_py() for k in ("conv_id", "formatted", "loss", "rewritten_at"))
                turns = template.parse(text)
                all_turns = hashlib.sha256()
                for role, said in turns:
                    all_turns.update(f"{role}\n{said}\n".encode())
                learnt = "".join(template.unescape(text[x["start"]:x["end"]]) for x in loss or [])
                out.append((conv, len(turns), all_turns.hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text), at))
            if out:
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    return formatted.select("conv_id", "formatted", "loss", "rewritten_at").mapInArrow(run, READ_DDL)
