"""Number, date and sentence formatting as ``Column -> Column`` builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rsvpark import constants as K
from rsvpark.functions.text import col_


def pct_even(n: Column | str, d: Column | str) -> Column:
    """``round(n / d * 100)`` with half-to-even rounding; 0 when d is 0."""
    ratio = F.try_divide(col_(n).cast("double"), col_(d).cast("double"))
    return F.coalesce(F.bround(ratio * 100, 0), F.lit(0.0)).cast("int")


def pct_half_up(n: Column | str, d: Column | str) -> Column:
    """Legend percent as a browser's ``Math.round`` gives it (half up)."""
    ratio = F.try_divide(col_(n).cast("double"), col_(d).cast("double"))
    return F.coalesce(F.floor(ratio * 100 + 0.5), F.lit(0)).cast("int")


def day_label(d: Column | str) -> Column:
    """``Sep 01``."""
    return F.date_format(col_(d), "MMM dd")


def long_day_label(d: Column | str) -> Column:
    """``Mon Sep 01``."""
    return F.date_format(col_(d), "EEE MMM dd")


def money_text(total: Column | str) -> Column:
    """``Free ($0 AUD)`` or ``$1234 AUD collected`` (whole dollars, half-even)."""
    t = col_(total)
    whole = F.bround(t, 0).cast("decimal(38,0)").cast("string")
    return F.when(t == 0, F.lit(K.MONEY_FREE)).otherwise(
        F.concat(F.lit("$"), whole, F.lit(K.MONEY_SUFFIX))
    )


def join_and(arr: Column | str) -> Column:
    """``a`` / ``a and b`` / ``a, b and c``; null for an empty array."""
    a = col_(arr)
    n = F.size(a)
    many = F.concat(F.array_join(F.slice(a, F.lit(1), n - 1), ", "), F.lit(" and "), F.element_at(a, -1))
    return F.when(n == 1, F.element_at(a, 1)).when(n > 1, many)


def rank_text(r: Column | str) -> Column:
    """Zero-padded rank ``01``."""
    return F.format_string("%02d", col_(r).cast("int"))


def nice_max(m: Column | str) -> Column:
    """Axis top: the maximum rounded up to a multiple of five."""
    return (F.ceil(col_(m) / 5) * 5).cast("bigint")


def axis_ticks(nice: Column | str, steps: int = 5) -> Column:
    """Tick values ``round(nice * i / steps)`` for i = 0..steps, as text."""
    ticks = F.transform(
        F.sequence(F.lit(0), F.lit(steps)),
        lambda i: F.floor(col_(nice) * i / steps + 0.5).cast("bigint").cast("string"),
    )
    return F.array_join(ticks, ",")


def palette_at(pos0: Column | str, palette: list[str], default: str | None = None) -> Column:
    """Colour for a 0-based position: cycled when ``default`` is None,
    else looked up with ``default`` past the end."""
    arr = F.array(*[F.lit(p) for p in palette])
    p = col_(pos0).cast("int")
    if default is None:
        return F.element_at(arr, F.pmod(p, F.lit(len(palette))) + 1)
    return F.when(p < len(palette), F.element_at(arr, p + 1)).otherwise(F.lit(default))


def md5_bucket(c: Column | str, n: Column | int) -> Column:
    """Bucket ``0 .. n-1`` from the first 60 bits of the MD5 of the value's
    text.  A spread-out hash (row ids may be strided) that SQL engines
    without Spark's xxhash64 can recompute, so the split is checkable."""
    h = F.conv(F.substring(F.md5(col_(c).cast("string")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(h, n if isinstance(n, Column) else F.lit(n))
