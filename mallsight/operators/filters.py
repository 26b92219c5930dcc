"""Row filters (FLT1-FLT12) and the preview limit (LIM4).

Filters are plain predicates on stored or derived columns; when the column is
stored in parquet, Catalyst pushes the comparison into the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ntz
from ..sources.adapters import CANCELLED


def drop_cancelled(df: DataFrame, status: str = "status") -> DataFrame:
    """FLT1: drop status 900 (a missing status counts as 0, i.e. kept)."""
    return df.filter(F.coalesce(F.col(status), F.lit(0)) != CANCELLED)


def time_range(df: DataFrame, start: dt.datetime, end: dt.datetime,
               ts: str = "order_datetime") -> DataFrame:
    """FLT2: half-open [start, end) on the order time (D8)."""
    return df.filter((F.col(ts) >= ntz(start)) &
                     (F.col(ts) < ntz(end)))


def status_in(df: DataFrame, statuses, status: str = "status") -> DataFrame:
    """FLT3/FLT5: status in the given list (no filter when the list is empty/None)."""
    return df.filter(F.col(status).isin(list(statuses))) if statuses else df


def sorted_by_time(df: DataFrame, ts: str = "order_datetime") -> DataFrame:
    """FLT4: list pages come back in order-time order."""
    return df.orderBy(F.col(ts).asc_nulls_last())


def date_between(df: DataFrame, start, end, date_col: str = "order_date") -> DataFrame:
    """FLT7: inclusive date mask."""
    return df.filter(F.col(date_col).between(F.lit(start), F.lit(end)))


def date_and_source(df: DataFrame, start, end, source: str) -> DataFrame:
    """FLT8: date mask AND store equality."""
    return date_between(df, start, end).filter(F.col("source") == source)


def source_eq(df: DataFrame, source: str) -> DataFrame:
    """FLT9: one store."""
    return df.filter(F.col("source") == source)


def skip_empty_ids(df: DataFrame, col: str) -> DataFrame:
    """FLT11: drop NULL or empty ids."""
    return df.filter(F.nullif(F.col(col), F.lit("")).isNotNull())


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """LIM4: the first n lines in arrival order (the limit is the feature)."""
    return df.orderBy("ingest_seq", "line_seq", "item_id", "quantity", "unit_price",
                      "shipping_charge").limit(n)
