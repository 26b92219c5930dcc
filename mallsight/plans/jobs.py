"""Scheduled jobs (RPT9-RPT12): compute from ``plans.reports`` plus their sinks.

Jobs take an explicit as-of date (no clock reads) and write through Spark's
commit protocol; scheduling itself is left to whatever runs the job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sinks as S
from ..functions.time import ntz, parse_offset_time
from ..operators.filters import time_range
from . import reports as RP
from . import windows as W


def _docs_in(raw_docs: DataFrame, start: dt.datetime, end: dt.datetime,
             time_col: str = "orderDatetime") -> DataFrame:
    t = parse_offset_time(time_col)
    return raw_docs.filter((t >= ntz(start)) & (t < ntz(end)))


def run_daily_job(lines: DataFrame, as_of: dt.date, table: str,
                  raw_docs: DataFrame | None = None, raw_dir: str | None = None) -> bool:
    """RPT9: yesterday's daily totals appended to ``table``; the day's raw documents to JSON.

    The day is the run key: running the job again replaces the day's row (``sinks.append_run``).
    """
    s, e = W.previous_day(as_of)
    wrote = S.append_run(RP.daily_job(lines, as_of), table, run=s.date().isoformat())
    if raw_docs is not None and raw_dir is not None:
        S.write_json(_docs_in(raw_docs, s, e), f"{raw_dir}/{S.stamp('orders', dt.datetime.combine(as_of, dt.time()))}")
    return wrote


def run_weekly_job(lines: DataFrame, as_of: dt.date, tables_dir: str, updated_at: dt.datetime) -> dict:
    """RPT10: last 7 days -> daily, monthly, top-50 products and key/value summary tables."""
    s, e = W.last_week(as_of)
    t = RP.weekly_job(S.materialize(time_range(lines, s, e), "weekly_lines"), as_of, updated_at)
    return S.summary_bundle(t["daily"], t["monthly"], t["products"], t["summary"], tables_dir)


def run_monthly_job(lines: DataFrame, as_of: dt.date, out_dir: str,
                    raw_docs: DataFrame | None = None) -> DataFrame:
    """RPT11: previous month -> raw JSON + line CSV; returns the month's summary stats."""
    s, e = W.previous_month(as_of)
    t = RP.monthly_job(S.materialize(time_range(lines, s, e), "monthly_lines"), as_of)
    tag = s.strftime("%Y%m")
    if raw_docs is not None:
        S.write_json(_docs_in(raw_docs, s, e), f"{out_dir}/orders_{tag}")
    S.write_csv(t["lines"], f"{out_dir}/sales_{tag}")
    return t["stats"]


def run_full(lines: DataFrame, start: str, end: str, as_of: dt.date, out_dir: str,
             tables_dir: str | None = None, raw_docs: DataFrame | None = None,
             updated_at: dt.datetime | None = None) -> DataFrame:
    """RPT12: CLI range -> daily / monthly / product / hourly / summary; CSV + JSON + tables.

    Returns the console summary lines (RPT6) for the range.
    """
    s, e = W.cli_range(as_of, start=start, end=end)
    r = RP.full_run(S.materialize(time_range(lines, s, e), "run_lines"), start, end, as_of)
    stamp = S.stamp("run", updated_at or dt.datetime.combine(as_of, dt.time()))
    if raw_docs is not None:
        S.write_json(_docs_in(raw_docs, s, e), f"{out_dir}/orders_{stamp}")
    S.export_csvs(r["daily"], r["products"], r["lines"], f"{out_dir}/{stamp}")
    if tables_dir is not None:
        kv = RP.summary_kv(r["stats"], updated_at or dt.datetime.combine(as_of, dt.time()))
        S.summary_bundle(r["daily"], r["monthly"], r["products"], kv, tables_dir)
    return RP.cli_summary(r["lines"], s.date(), e.date()).orderBy("line_no").select(F.col("text"))
