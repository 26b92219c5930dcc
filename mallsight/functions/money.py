"""Money and text helpers (FN10-FN19, PRJ11) as built-in Column expressions.

Money is integral yen in BIGINT everywhere; formatting only happens in report
columns, never in numeric outputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .time import col


# A decimal number, optionally signed and with an exponent; surrounding blanks allowed.
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def clean_int(c, default: int = 0) -> Column:
    """PRJ11/FN16: '1,200' -> 1200, '12.7' -> 12, 'nan'/''/junk -> default.

    The text itself must be a decimal number ('12d' and '0x1p3' are junk).
    Whole numbers are cast directly, so 16-digit amounts stay exact; others
    truncate toward zero.  All casts are ``try_`` (ANSI-safe).
    """
    txt = F.replace(col(c).cast("string"), F.lit(","), F.lit(""))
    # text of ASCII digits alone needs no pattern; the patterns are tried on the rest
    digits = F.when(F.translate(txt, "0123456789", "") == "", txt.try_cast("bigint"))
    whole = F.when(txt.rlike(_INTEGER), F.trim(txt).try_cast("bigint"))
    fraction = F.when(txt.rlike(_NUMBER), txt.try_cast("double")).try_cast("bigint")
    return F.coalesce(digits, whole, fraction, F.lit(default).cast("bigint"))


def first_nonzero(*cols) -> Column:
    """PRJ7: the first argument that is non-NULL and non-zero, else 0."""
    return F.coalesce(*[F.nullif(col(c), F.lit(0)) for c in cols], F.lit(0).cast("bigint"))


def nonempty(c) -> Column:
    """FN17: '' -> NULL."""
    return F.nullif(col(c), F.lit(""))


def delta(cur, prev) -> tuple[Column, Column]:
    """FN10: (difference, percent change); both 0 when the previous value is 0 or NULL."""
    cur, prev = col(cur), col(prev)
    zero = F.coalesce(prev, F.lit(0)) == 0
    diff = F.when(zero, F.lit(0)).otherwise(cur - prev)
    rate = F.when(zero, F.lit(0.0)).otherwise((cur - prev).cast("double") * 100.0 / prev)
    return diff, rate


def yen(c) -> Column:
    """FN13: 1234567 -> '¥1,234,567'; -5 -> '¥-5' (half-even on fractions, like Python's format)."""
    return F.concat(F.lit("¥"), F.format_number(col(c), 0))


def signed_pct(rate) -> Column:
    """FN14: 12.34 -> '+12.3%', -5 -> '-5.0%'."""
    r = F.bround(col(rate), 1)
    return F.concat(F.when(r >= 0, F.lit("+")).otherwise(F.lit("")),
                    F.format_string("%.1f", r), F.lit("%"))


def yoy_text(cur, prev) -> Column:
    """FN11: '¥prev → ¥cur（±x.x%）'; 'no prior-year data' text when prev is NULL or 0."""
    cur, prev = col(cur), col(prev)
    pct = (cur - prev).cast("double") * 100.0 / prev
    sign = F.when(cur - prev >= 0, F.lit("+")).otherwise(F.lit(""))
    return F.when(F.coalesce(prev, F.lit(0)) == 0, F.lit(NO_PRIOR_YEAR)).otherwise(
        F.concat(yen(prev), F.lit(" → "), yen(cur), F.lit("（"), sign,
                 F.format_string("%.1f", F.bround(pct, 1)), F.lit("%）")))


# Report wording.
NO_PRIOR_YEAR = "前年データなし"


def compact_yen(c) -> Column:
    """FN12: >=1M -> '¥x.xM', >=1K -> '¥xK', else '¥1,234'."""
    c = col(c)
    return (F.when(c >= 1_000_000, F.concat(F.lit("¥"), F.format_string("%.1f", F.bround(c / 1e6, 1)), F.lit("M")))
             .when(c >= 1_000, F.concat(F.lit("¥"), F.format_number(F.bround(c / 1e3, 0), 0), F.lit("K")))
             .otherwise(yen(c)))


def short_name(c, n: int = 30) -> Column:
    """FN15: first n characters + '...' (always appended)."""
    return F.concat(F.substring(col(c), 1, n), F.lit("..."))
