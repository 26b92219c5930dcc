"""Period helpers (FLT13-FLT15, FN9): as-of date -> (start, end) date pairs.

Pure parameter arithmetic on the driver, like any job computing its window
before it builds a plan; no data passes through here.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Period:
    name: str
    start: dt.date | None
    end: dt.date | None      # inclusive

    @property
    def days(self) -> int:
        return max((self.end - self.start).days + 1, 1) if self.start and self.end else 1


def year_ago(d: dt.date) -> dt.date | None:
    """D5: the same day one year earlier; 29 February has none."""
    try:
        return d.replace(year=d.year - 1)
    except ValueError:
        return None


def yesterday(as_of: dt.date) -> Period:
    y = as_of - dt.timedelta(days=1)
    return Period("yesterday", y, y)


def month_to_date(as_of: dt.date) -> Period:
    """FLT15: first of yesterday's month through yesterday."""
    y = as_of - dt.timedelta(days=1)
    return Period("month_to_date", y.replace(day=1), y)


def year_ago_period(p: Period) -> Period | None:
    """The same period one year earlier (None when the end is 29 February)."""
    end = year_ago(p.end)
    if end is None:
        return None
    return Period(p.name + "_year_ago", year_ago(p.start) or p.start.replace(day=28, year=p.start.year - 1), end)


def preset(name: str, as_of: dt.date, start: dt.date | None = None, end: dt.date | None = None) -> Period:
    """FLT13: this month / last 7 days / last 30 days / custom, ending today."""
    if name == "this_month":
        y = as_of - dt.timedelta(days=1)
        return Period(name, y.replace(day=1), as_of)
    if name == "last_7_days":
        return Period(name, as_of - dt.timedelta(days=7), as_of)
    if name == "last_30_days":
        return Period(name, as_of - dt.timedelta(days=30), as_of)
    if name == "custom":
        return Period(name, start, end)
    raise ValueError(f"unknown period preset: {name}")


def cli_range(as_of: dt.date, days: int = 30, start: str | None = None,
              end: str | None = None) -> tuple[dt.datetime, dt.datetime]:
    """FLT14: explicit yyyy-MM-dd range (end at 23:59:59) or the last N days.

    Returned as half-open datetimes [start, end) (D8).
    """
    if start and end:
        s = dt.datetime.strptime(start, "%Y-%m-%d")
        e = dt.datetime.strptime(end, "%Y-%m-%d") + dt.timedelta(days=1)
        return s, e
    e = dt.datetime.combine(as_of, dt.time())
    return e - dt.timedelta(days=days), e


def previous_day(as_of: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """Daily job window: yesterday 00:00 to today 00:00, half-open."""
    e = dt.datetime.combine(as_of, dt.time())
    return e - dt.timedelta(days=1), e


def last_week(as_of: dt.date) -> tuple[dt.datetime, dt.datetime]:
    e = dt.datetime.combine(as_of, dt.time())
    return e - dt.timedelta(days=7), e


def previous_month(as_of: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """Monthly job window: first of previous month to first of this month."""
    first = as_of.replace(day=1)
    prev = (first - dt.timedelta(days=1)).replace(day=1)
    return dt.datetime.combine(prev, dt.time()), dt.datetime.combine(first, dt.time())
