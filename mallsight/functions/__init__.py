"""Scalar functions (FN*): built-in Column expressions only, no Python UDFs."""

from .money import (clean_int, compact_yen, delta, first_nonzero, nonempty, short_name,
                    signed_pct, yen, yoy_text)
from .time import (WEEKDAY_NAMES, format_date, instant_to_jst, parse_compact_time,
                   parse_iso_date, parse_lenient_time, parse_offset_time, parse_wall_clock,
                   weekday_name, with_time_parts, year_ago)

__all__ = [
    "clean_int", "compact_yen", "delta", "first_nonzero", "nonempty", "short_name", "signed_pct",
    "yen", "yoy_text", "WEEKDAY_NAMES", "format_date", "instant_to_jst", "parse_compact_time",
    "parse_iso_date", "parse_lenient_time", "parse_offset_time", "parse_wall_clock",
    "weekday_name", "with_time_parts", "year_ago",
]
