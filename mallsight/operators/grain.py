"""Order grain and keep-first / keep-last selections (AGG1, WIN1-WIN3).

All selections are ``groupBy`` + ``min_by``/``max_by`` rather than a
``row_number`` window: the aggregate combines map-side, so a hot key (say a
third of all lines carry the empty order number) collapses to one partial row
per task before the shuffle instead of landing whole in one window task.

Input order is explicit (D1): ``ingest_seq`` orders documents, ``line_seq``
orders lines inside a document, ``item_id`` breaks the remaining ties.  Lines
of one document share every order attribute, so the first *document* of a key
is found with ``ingest_seq`` alone, a single BIGINT that keeps the aggregation
buffer fixed-width (hash aggregation, no sort).  Whole-row picks
(``keep_first`` / ``keep_last``) carry string payloads, so Spark plans them as
sort-based aggregates; they still combine map-side and spill safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import LINE_ORDER

# Parity with the reference: orders are deduplicated by number alone.
DEFAULT_KEY = ("order_number",)
STORE_KEY = ("source", "order_number")


def first_by_doc(attr: str, seq: str = "ingest_seq") -> Column:
    """The attribute of the first document of the group."""
    return F.min_by(F.col(attr), F.col(seq)).alias(attr)


def order_grain(lines: DataFrame, attrs, key=DEFAULT_KEY, items: bool = False) -> DataFrame:
    """AGG1: one row per order key carrying ``attrs`` of its first document.

    ``items=True`` adds ``items`` = Σ quantity over *all* lines of the key
    (line grain), which is what the order-grain aggregates pair with.
    """
    aggs = [first_by_doc(a) for a in attrs if a not in key]
    if items:
        aggs.append(F.sum("quantity").alias("items"))
    return lines.groupBy(*key).agg(*aggs)


def keep_first(df: DataFrame, key, order_cols=LINE_ORDER, columns=None) -> DataFrame:
    """WIN1: the whole first row per key under an explicit ascending order."""
    columns = list(columns or [c for c in df.columns])
    payload = [c for c in columns if c not in key]
    picked = F.min_by(F.struct(*[F.col(c) for c in payload]),
                      F.struct(*[F.col(c) for c in order_cols])).alias("_row")
    return df.groupBy(*key).agg(picked).select(*key, "_row.*").select(*columns)


def keep_last(df: DataFrame, key, order_cols, columns=None) -> DataFrame:
    """WIN2: the whole last row per key (keep='last') under an explicit order."""
    columns = list(columns or [c for c in df.columns])
    payload = [c for c in columns if c not in key]
    picked = F.max_by(F.struct(*[F.col(c) for c in payload]),
                      F.struct(*[F.col(c) for c in order_cols])).alias("_row")
    return df.groupBy(*key).agg(picked).select(*key, "_row.*").select(*columns)


# Status precedence when one order id shows up in several status sets.
STATUS_PRIORITY = ["COMPLETED", "SHIPPED", "WAITING_FOR_SHIPMENT"]


def status_rank(status) -> Column:
    s = F.col(status) if isinstance(status, str) else status
    expr = F.lit(len(STATUS_PRIORITY))
    for i, name in reversed(list(enumerate(STATUS_PRIORITY))):
        expr = F.when(s == name, F.lit(i)).otherwise(expr)
    return expr


def priority_first(df: DataFrame, key: str, status: str, order_cols, columns=None) -> DataFrame:
    """WIN3: one row per id; the best status wins, then the first in arrival order."""
    ranked = df.withColumn("_rank", status_rank(status))
    return keep_first(ranked, (key,), ("_rank", *order_cols), columns=columns or df.columns)


def numbered(df: DataFrame, order_cols, name: str = "n") -> DataFrame:
    """``df`` with ``name``: the row's place, from 1, in the order of ``order_cols`` over the whole frame.

    A distributed rank: rows are sorted in ranges (written once, so that the ranges stay as they
    are), counted per range, and numbered within.  No key gathers in one task, and the broadcast
    offsets have one row a range.
    """
    from ..sinks import materialize
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order_cols).withColumn("_range", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order_cols))
    return ranged.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + place).drop("_range", "_start")
