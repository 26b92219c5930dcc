"""Timestamp parsing and calendar parts (FN1-FN7, FN9) as Column expressions.

Every function returns a built-in expression; nothing here runs Python per row.
Results never depend on the session time zone: offsets in the input are turned
into the JST wall clock by exact microsecond arithmetic on TIMESTAMP_NTZ, and
offset-free text is parsed straight to TIMESTAMP_NTZ.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order times are JST wall clock; JST is UTC+9 with no DST.
JST_OFFSET_HOURS = 9
_JST_EPOCH = _dt.datetime(1970, 1, 1, JST_OFFSET_HOURS, 0, 0)
# Weekday names, Monday first (index = weekday()).
WEEKDAY_NAMES = ["月", "火", "水", "木", "金", "土", "日"]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a Python date/datetime, independent of the session zone.

    ``F.lit(datetime)`` builds a zoned TIMESTAMP and the cast to NTZ would go
    through the session zone; the ISO text casts straight to the wall clock.
    """
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def instant_to_jst(ts) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding the JST wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col(ts)), ntz(_JST_EPOCH))


def parse_wall_clock(s, fmt: str) -> Column:
    """Offset-free text -> TIMESTAMP_NTZ; unparseable -> NULL (ANSI-safe).

    ``try_to_timestamp`` only guards the parse; the value itself comes from
    ``to_timestamp_ntz`` which never consults the session zone.
    """
    s = col(s)
    return F.when(F.try_to_timestamp(s, F.lit(fmt)).isNotNull(),
                  F.to_timestamp_ntz(s, F.lit(fmt)))


# Offset pattern letters and what text they parse ends with.
_OFFSET_ENDS = (("XXX", r"([Zz]|[+-]\d\d:\d\d)$"), ("XX", r"([Zz]|[+-]\d{4})$"), ("X", r"([Zz]|[+-]\d\d(\d\d)?)$"))


def parse_offset_time(s) -> Column:
    """FN1/FN3: ISO-8601 text with an offset (+0900, +09:00, Z) -> JST NTZ.

    Date and time are separated by ``T`` or one blank; seconds, or the whole
    time of day (midnight), may be missing.  Text without an offset is read as
    JST wall clock; bad or empty -> NULL.
    """
    s = F.nullif(F.trim(col(s)), F.lit(""))
    s = F.regexp_replace(s, r"^(\d{4}-\d{2}-\d{2}) (?=\d)", "$1T")
    s = F.regexp_replace(s, r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00")
    base = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS]"
    # a parse that fails costs an exception, so each is tried only on text that ends like its offset
    with_offset = F.coalesce(*[F.when(s.rlike(end), F.try_to_timestamp(s, F.lit(base + z))) for z, end in _OFFSET_ENDS])
    return F.coalesce(instant_to_jst(with_offset), parse_wall_clock(s, base))


def parse_compact_time(s) -> Column:
    """FN2: the first 14 characters as yyyyMMddHHmmss (JST wall clock); bad -> NULL."""
    s = F.substring(col(s), 1, 14)
    return F.when(_may_fit(s, "yyyyMMddHHmmss"), parse_wall_clock(s, "yyyyMMddHHmmss"))


# The text layouts accepted for CSV order dates, tried in order.
CSV_DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMddHHmmss", "yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd",
]


def _may_fit(s: Column, fmt: str) -> Column:
    """False only for text that ``fmt`` cannot parse: a parse that fails costs an exception, this does not."""
    if not re.fullmatch(r"yyyy(MM|dd|HH|mm|ss|'T'|[-/: ])*", fmt):
        return F.lit(True)
    shape = re.sub("[A-Za-z]", "_", fmt.replace("'T'", "_"))[4:]      # all but the year have two digits
    return s.like("%" + shape) if shape.strip("_") else s.rlike("^[0-9+]+$")


# The layouts of CSV_DATE_FORMATS that a cast reads too, with every digit written as 0.
_CAST_SHAPES = ["0000-00-00 00:00:00", "0000-00-00"]


def _cast_time(s: Column) -> Column:
    """What a cast reads from text of exactly such a layout, a fraction of a format's cost; anything else NULL."""
    dashed = F.translate(s, "/", "-")
    fits = F.translate(dashed, "123456789", "000000000").isin(*_CAST_SHAPES) & ~s.startswith("0000")
    # one kind of separator only, as in the layouts
    fits = fits & ~(s.contains("/") & s.contains("-"))
    return F.when(fits, dashed.try_cast("timestamp_ntz"))


def parse_lenient_time(s, formats=CSV_DATE_FORMATS) -> Column:
    """FN4: first format that parses wins; none -> NULL."""
    s = F.nullif(F.trim(col(s)), F.lit(""))
    quick = [_cast_time(s)] if formats is CSV_DATE_FORMATS else []
    return F.coalesce(*quick, *[F.when(_may_fit(s, f), parse_wall_clock(s, f)) for f in formats])


def parse_iso_date(s) -> Column:
    """FN5: strict yyyy-MM-dd -> DATE, bad -> NULL."""
    return F.try_to_date(col(s), "yyyy-MM-dd")


def month_text(t) -> Column:
    """'yyyy-MM' from calendar fields (no zone conversion of the wall clock)."""
    t = col(t)
    return F.when(t.isNotNull(), F.format_string("%04d-%02d", F.year(t), F.month(t)))


def with_time_parts(df, ts: str = "order_datetime"):
    """FN6/PRJ5: order_date, order_hour, order_month (yyyy-MM), order_weekday (0=Mon)."""
    t = F.col(ts)
    return (df.withColumn("order_date", F.to_date(t))
              .withColumn("order_hour", F.hour(t))
              .withColumn("order_month", month_text(t))
              .withColumn("order_weekday", F.weekday(t)))


def weekday_name(weekday) -> Column:
    """FN8: 0..6 -> 月..日; NULL or out of range -> NULL."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    w = col(weekday)
    return F.when(w.between(0, 6), F.element_at(names, w + 1))


def format_date(d, style: str = "iso") -> Column:
    """FN7: DATE -> 'yyyy-MM-dd' | 'yyyyMMdd' | 'MM/dd'."""
    pattern = {"iso": "yyyy-MM-dd", "compact": "yyyyMMdd", "short": "MM/dd"}[style]
    return F.date_format(col(d), pattern)


def year_ago(d) -> Column:
    """D5: same month/day one year earlier; 29 February -> NULL (no comparison)."""
    d = col(d)
    return F.try_to_date(F.format_string("%04d-%02d-%02d", F.year(d) - 1, F.month(d),
                                         F.dayofmonth(d)), "yyyy-MM-dd")
