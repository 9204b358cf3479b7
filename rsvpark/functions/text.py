"""Scalar string and array functions as ``Column -> Column`` builders.

All of these are built-in Spark expressions (regexp, split, transform,
filter, array_distinct ...) so they stay inside whole-stage codegen; no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rsvpark import constants as K

# Unicode whitespace as Python's str.strip()/str.split() see it: Java's
# Unicode \s plus the four ASCII separators U+001C..U+001F.
WS = r"[\s\x{1c}-\x{1f}]"
_STRIP_RE = rf"(?U)^{WS}+|{WS}+$"
_SPLIT_WS_RE = rf"(?U){WS}+"
_NON_WS_RE = r"(?U)[^\s\x{1c}-\x{1f}]"
# One trailing full-width bracket group, e.g. "Networking （结识同行）".
_TRANSLATION_RE = rf"(?U){WS}*（[^）]*）{WS}*$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Trim Unicode whitespace at both ends (``F.trim`` only strips spaces)."""
    return F.regexp_replace(col_(c), _STRIP_RE, "")


def strip_long(c: Column | str) -> Column:
    """``strip_ws`` of a long text, which the pattern passes over only when an end is a space."""
    c = col_(c)
    return F.when(F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1)).rlike(f"(?U){WS}"), strip_ws(c)).otherwise(c)


def is_blank(c: Column | str) -> Column:
    """True for null or whitespace-only text.

    Tested as "holds no non-whitespace character": the regex stops at the
    first such character, so a long answer is neither scanned nor copied.
    """
    return F.coalesce(~col_(c).rlike(_NON_WS_RE), F.lit(True))


def na_null(c: Column | str) -> Column:
    """Null out cells that are exactly one of the CSV missing-value tokens."""
    c = col_(c)
    return F.when(~c.isin(*K.NA_TOKENS), c)


def strip_translation(c: Column | str) -> Column:
    """Drop one trailing full-width bracket group and trim; keep the input
    when nothing would be left."""
    c = col_(c)
    t = strip_ws(F.regexp_replace(c, _TRANSLATION_RE, ""))
    return F.when(t != "", t).otherwise(c)


def choice_picks(c: Column | str) -> Column:
    """Options of one multiple-choice answer: split on ``|`` only, trim, drop
    blanks, drop translations, de-duplicate keeping first order."""
    parts = F.transform(F.split(col_(c), r"\|", -1), strip_ws)
    kept = F.filter(parts, lambda x: x != "")
    return F.array_distinct(F.transform(kept, strip_translation))


def raw_split(c: Column | str) -> Column:
    """Split on ``|`` when present, else on ``,`` / ``;`` (pieces kept raw)."""
    c = col_(c)
    return F.when(c.contains("|"), F.split(c, r"\|", -1)).otherwise(F.split(c, "[,;]", -1))


def multiselect_labels(c: Column | str) -> Column:
    """Labels of a multi-select answer with the comma fallback; no de-dupe."""
    cleaned = F.transform(raw_split(c), lambda x: strip_translation(strip_ws(x)))
    return F.filter(cleaned, lambda x: x != "")


def part_count(c: Column | str) -> Column:
    """Number of pieces before blank removal (``Product,`` has two)."""
    return F.size(raw_split(c))


def combo_label(c: Column | str) -> Column:
    """Normalised raw combination: pieces split on ``|``, cleaned, re-joined."""
    pieces = F.transform(F.split(col_(c), r"\|", -1), lambda x: strip_translation(strip_ws(x)))
    return F.array_join(pieces, " | ")


def shorten_label(c: Column | str, max_words: int = K.SHORTEN_MAX_WORDS) -> Column:
    """Cut at the first separator type present, else cap the word count."""
    c = col_(c)
    words = F.split(strip_ws(c), _SPLIT_WS_RE)
    n_words = F.when(strip_ws(c) == "", F.lit(0)).otherwise(F.size(words))
    capped = F.when(n_words <= max_words, c).otherwise(
        F.concat(F.array_join(F.slice(words, 1, max_words), " "), F.lit(K.ELLIPSIS))
    )
    out = capped
    for sep in reversed(K.SHORTEN_SEPARATORS):
        out = F.when(c.contains(sep), strip_ws(F.substring_index(c, sep, 1))).otherwise(out)
    return out


def starts_with_any(c: Column | str, prefixes: list[str]) -> Column:
    """Case-insensitive prefix test against a fixed label list."""
    low = F.lower(col_(c))
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | low.startswith(p.lower())
    return cond


def is_experienced(c: Column | str) -> Column:
    return starts_with_any(c, K.EXPERIENCED_LABELS)


def html_escape(c: Column | str) -> Column:
    """Escape ``& < > " '`` (ampersand first)."""
    out = col_(c)
    for src, dst in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def slug(stem: Column | str) -> Column:
    """Folder-safe event key from a file stem; ``event`` when nothing is left."""
    s = F.regexp_replace(F.regexp_replace(col_(stem), "[^A-Za-z0-9_-]+", "-"), "^-+|-+$", "")
    return F.when(s != "", s).otherwise(F.lit("event"))


_PUNCT_CLASS = "".join("\\" + ch if ch in ".?!" else ch for ch in K.FILLER_TRAILING_PUNCT)
# A filler answer is, after leading whitespace, a filler word (lower-casing
# never shortens text, so at most this many characters) followed only by
# whitespace and end punctuation.
_FILLER_SPAN = 2 * max(len(f) for f in K.FILLER_ANSWERS)
# The shape is an optional group, so the search always ends at position 0
# (whole text when the shape fits, else empty) instead of being retried at
# every position of a long answer.
_FILLER_SHAPE_RE = rf"(?sU)^(?:{WS}*.{{0,{_FILLER_SPAN}}}[\s\x{{1c}}-\x{{1f}}{_PUNCT_CLASS}]*$)?"


def filler_key(c: Column | str) -> Column:
    """Normal form used to compare an answer with the filler list."""
    return strip_ws(F.regexp_replace(F.lower(strip_ws(c)), f"[{_PUNCT_CLASS}]+$", ""))


def is_filler(c: Column | str) -> Column:
    """Answer equal to a filler word after normalising (``filler_key``).

    The shape test runs first and is a necessary condition, so long genuine
    answers are rejected without lower-casing or copying them (``And``
    evaluates its right side only when the left is true).
    """
    c = col_(c)
    shaped = F.length(F.regexp_extract(c, _FILLER_SHAPE_RE, 0)) > 0
    return shaped & filler_key(c).isin(*K.FILLER_ANSWERS)
