"""Exact period results from day states (AGG9, AGG10, AGG11, RPT1/RPT2 for any period).

A result that counts each order once cannot be added up over days: an order that was fetched again
under another date, or stands in two stores, would count twice.  Day states keep what adds up, and
the rest:

* ``days``     per (day, store): money of the orders seen in this day and store only; quantities
  and line dates of all lines;
* ``marks``    per (day, store): a bitmap of the numbers of all its orders, in buckets of 32,768
  (``bitmap_construct_agg``); orders are numbered by their first day, so a day fills few buckets;
* ``repeats``  one row for each (day, store) of the few orders that were seen in several.

Any period then merges ``days`` by sums, ``marks`` by ``bitmap_or_agg`` (distinct orders, exactly)
and picks the first document of each repeated order, without reading a line again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import materialize
from ..sinks.published import publish, read_published
from .grain import numbered

MONEY = ("order_net_sales", "total_price")
CELL = ["date", "source"]
#: Of the state tables, for those that hold no row yet.
SCHEMAS = {"days": "date date, source string, order_net_sales bigint, total_price bigint, items bigint",
           "marks": "date date, source string, bucket bigint, orders binary",
           "repeats": "n bigint, date date, source string, seq bigint, order_net_sales bigint, total_price bigint"}


def numbered_orders(cells: DataFrame) -> DataFrame:
    """``(order_number, n, cells)``: orders numbered from 1 by (first day, order number), and their cells."""
    orders = cells.groupBy("order_number").agg(F.min("date").alias("first_day"), F.count("*").alias("cells"))
    return numbered(orders, ("first_day", "order_number")).select("order_number", "n", "cells")


def day_states(lines: DataFrame) -> dict[str, DataFrame]:
    """The three state tables of canonical order lines; lines are read once.

    A NULL order number is one order, as in the aggregates over lines."""
    cells = materialize(lines.groupBy("order_number", "source", F.to_date("order_datetime").alias("date")).agg(
        F.min("ingest_seq").alias("seq"), *[F.min_by(m, "ingest_seq").alias(m) for m in MONEY], F.sum("quantity").alias("items")), "day_cells")
    numbers = numbered_orders(cells).withColumnRenamed("order_number", "number")
    cells = materialize(cells.join(numbers, F.col("order_number").eqNullSafe(F.col("number"))).drop("number"), "numbered_cells")
    alone = F.col("cells") == 1
    days = cells.groupBy(*CELL).agg(*[F.sum(F.when(alone, F.col(m))).alias(m) for m in MONEY], F.sum("items").alias("items"))
    marks = cells.groupBy(*CELL, F.bitmap_bucket_number("n").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("orders"))
    return {"days": days, "marks": marks, "repeats": cells.filter(~alone).select("n", *CELL, "seq", *MONEY)}


def write_day_states(lines: DataFrame, root: str) -> dict[str, bool]:
    """Publish the states of ``lines`` below ``root``: all three tables in one commit."""
    return publish(lines.sparkSession, root, day_states(lines), dates_as_text=False)


def _merged(spark: SparkSession, root: str, start, end, group) -> DataFrame:
    """Per ``group`` (``()`` or ``("source",)``): orders, money, items, first and last day of [start, end]."""
    def part(name):
        df = read_published(spark, root, name, schema=T._parse_datatype_string(SCHEMAS[name]))
        if start is not None:
            df = df.filter(F.col("date") >= F.lit(start))
        return df if end is None else df.filter(F.col("date") <= F.lit(end))
    group = list(group)
    days, marks, repeats = part("days"), part("marks"), part("repeats")
    sums = days.groupBy(*group).agg(*[F.sum(m).alias(m) for m in MONEY], F.sum("items").alias("items"),
                                    F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    orders = (marks.groupBy(*group, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("orders")).alias("orders"))
              .groupBy(*group).agg(F.sum("orders").alias("orders")))
    first = (repeats.groupBy(*group, "n").agg(*[F.min_by(m, "seq").alias(m) for m in MONEY])
             .groupBy(*group).agg(*[F.sum(m).alias(f"r_{m}") for m in MONEY]))
    if group:
        same = lambda a, b: a.join(b.withColumnsRenamed({g: f"_{g}" for g in group}), F.col(group[0]).eqNullSafe(F.col(f"_{group[0]}")), "left") \
            .drop(f"_{group[0]}")
        out = same(same(sums, orders), first)
    else:  # one row each
        out = sums.crossJoin(orders).crossJoin(first)
    zero = F.lit(0)
    return out.select(*group, F.coalesce("orders", zero).cast("bigint").alias("orders"),
                      *[(F.coalesce(m, zero) + F.coalesce(f"r_{m}", zero)).cast("bigint").alias(m) for m in MONEY],
                      F.coalesce("items", zero).cast("bigint").alias("items"), "first_day", "last_day")


def period_kpi(spark: SparkSession, root: str, start, end, group=()) -> DataFrame:
    """AGG10 (AGG11 with ``group=("source",)``) from published day states: sales, orders, items of [start, end]."""
    return _merged(spark, root, start, end, group).select(*group, F.col("order_net_sales").alias("sales"), "orders", "items")


def summary_stats(spark: SparkSession, root: str, start=None, end=None, group=()) -> DataFrame:
    """AGG9 from published day states: order count, money, items, average order value, first and last day."""
    m = _merged(spark, root, start, end, group)
    return m.select(*group, F.col("orders").alias("total_orders"), F.col("order_net_sales").alias("total_sales"),
                    F.col("total_price").alias("gross_sales"), F.col("items").alias("total_items"),
                    F.when(F.col("orders") > 0, F.col("order_net_sales").cast("double") / F.col("orders")).otherwise(0.0).alias("avg_order_value"),
                    "first_day", "last_day")
