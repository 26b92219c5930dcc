"""STR1 with late copies: the lowest sequence of an order counts, whenever its document arrives.

readStream (JSON, explicit schema) -> drop cancelled -> one row per document -> the lowest document of
every order number in the micro-batch, written under the batch's number -> after the last batch, one row
a day and micro-batch.

* What is kept of the orders are those rows, for good, beside the checkpoint.  The lowest document of an
  order after a batch is the minimum over its rows so far; where it beats the one before, that one's
  amounts are taken back and its own are added.  Nothing waits for a watermark and no row is dropped as
  late, so the sums over all batches do not depend on the order in which files land.
* The minimum of a batch is combined before the shuffle, so a hot order number leaves one row a task, and
  one row a batch in what is kept.
* Day changes are worked out once a run, for the batches that have none yet: from their orders' rows only.
* A day is closed by the first batch after which the latest counted order is ``delay`` past the
  day's end.  What its sums were then, and what later batches changed, are two results of the
  same written rows (``closed_totals``, ``corrections``).
* A micro-batch that runs again writes the folder of its own number again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import parse_offset_time
from ..operators.flatten import parse_once
from ..sources.adapters import CANCELLED
from ..sources.readers import R_ORDER_LANDED, path_exists
from .daily import _items_in_document, event_time

#: What is kept of a document, in the order that decides between documents: lowest first.
DOC = ("seq", "at", "goods", "coupon", "units")
LOWEST = "orderNumber string, " + ", ".join(f"{c} long" for c in DOC) + ", batch_id long"
SUMS = ("order_count", "total_sales", "gross_sales", "coupon_total", "item_count")
DELTAS = "date date, " + ", ".join(f"{c} long" for c in SUMS) + ", seen_to long, batch_id long"
_LAST = (1 << 63) - 1
_DAY_MICROS = 86_400_000_000


def documents_stream(stream: DataFrame) -> DataFrame:
    """``(orderNumber, seq, at, goods, coupon, units)`` from a stream of R order documents.

    ``at`` is the order's wall clock in microseconds.  Cancelled documents and those without a
    readable time or without items take no part; a NULL order number counts as the empty one, a
    document without a sequence comes after all that have one.
    """
    units, n_items = _items_in_document()
    zero = F.lit(0).cast("long")
    return (stream.filter(F.coalesce(F.col("orderProgress"), F.lit(0)) != CANCELLED)
            .select("*", *parse_once(event_time(parse_offset_time("orderDatetime")).alias("event_time")))
            .filter(F.col("event_time").isNotNull() & (n_items > 0))
            .select(F.coalesce("orderNumber", F.lit("")).alias("orderNumber"),
                    F.coalesce(F.col("_ingest_seq"), F.lit(_LAST)).alias("seq"), F.unix_micros("event_time").alias("at"),
                    F.coalesce("goodsPrice", zero).alias("goods"), F.coalesce("couponAllTotalPrice", zero).alias("coupon"),
                    F.coalesce(units, zero).alias("units")))


def _lowest(docs: DataFrame) -> DataFrame:
    """The lowest document of every order number."""
    return docs.groupBy("orderNumber").agg(F.min(F.struct(*DOC)).alias("doc")).select("orderNumber", "doc.*")


def _changes(lowest: DataFrame) -> DataFrame:
    """``(batch_id, sign, *DOC)`` from rows ``LOWEST``: in each batch the documents that beat what their order
    had before (sign 1), and what they beat (-1)."""
    doc, before = F.struct(*DOC), Window.partitionBy("orderNumber").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    beaten = lowest.select("batch_id", doc.alias("doc"), F.min(doc).over(before).alias("old"))
    signed = lambda sign, c: F.struct(F.lit(sign).alias("sign"), *[F.col(c)[x].alias(x) for x in DOC])
    return (beaten.filter(F.col("old").isNull() | (F.col("doc") < F.col("old")))
            .select("batch_id", F.inline(F.array_compact(F.array(signed(1, "doc"), F.when(F.col("old").isNotNull(), signed(-1, "old")))))))


def _day_changes(changes: DataFrame) -> DataFrame:
    """One row a day and micro-batch: signed sums and the latest order added."""
    signed = lambda c: F.sum(F.col("sign") * c).cast("long")
    return changes.groupBy("batch_id", F.date_from_unix_date(F.floor(F.col("at") / _DAY_MICROS).cast("int")).alias("date")).agg(
        signed(F.lit(1)).alias("order_count"), signed(F.col("goods") - F.col("coupon")).alias("total_sales"),
        signed(F.col("goods")).alias("gross_sales"), signed(F.col("coupon")).alias("coupon_total"),
        signed(F.col("units")).alias("item_count"), F.max(F.when(F.col("sign") > 0, F.col("at"))).alias("seen_to"))


def _batches(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the micro-batches written below ``path``."""
    if not path_exists(spark, path):
        return set()
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return {int(f.getPath().getName().partition("=")[2]) for f in found or []}


def run_with_corrections(spark: SparkSession, source: str, sink: str, checkpoint: str,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the stream over everything landed so far (availableNow); the day changes of all batches so far.

    Rerunning with the same checkpoint reads only new files.  The lowest documents of each batch are
    kept for good in ``<checkpoint>/lowest``: a copy may come at any time.  Nothing landed yet gives no rows.
    """
    reader = spark.readStream.schema(R_ORDER_LANDED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_exists(spark, f"{checkpoint}/state"):
        raise ValueError(f"{checkpoint} keeps its orders in a state store, as earlier versions did: start with a new checkpoint and sink")
    kept = f"{checkpoint}/lowest"

    def write(batch: DataFrame, batch_id: int) -> None:
        _lowest(batch).write.mode("overwrite").parquet(f"{kept}/batch_id={batch_id}")

    (documents_stream(reader.json(source)).writeStream.foreachBatch(write).outputMode("append")
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    done = _batches(spark, sink)
    if new := sorted(_batches(spark, kept) - done):
        lowest, is_new = spark.read.schema(LOWEST).parquet(kept), F.col("batch_id").isin(new)
        if done:  # only the orders of the new batches
            lowest = lowest.join(lowest.filter(is_new).select("orderNumber"), "orderNumber", "left_semi")
        # a batch's days are one file, so its folder is there whole or not at all
        (_day_changes(_changes(lowest).filter(is_new)).repartition("batch_id")
         .write.mode("append").partitionBy("batch_id").parquet(sink))
    if not path_exists(spark, sink):
        return spark.createDataFrame([], DELTAS)
    return spark.read.schema(DELTAS).parquet(sink)


def current_totals(deltas: DataFrame) -> DataFrame:
    """Daily totals over all batches: what a batch job over all documents gives.  Days left without orders are dropped."""
    return (deltas.groupBy("date").agg(*[F.sum(c).alias(c) for c in SUMS]).filter("order_count <> 0"))


def _with_closing(deltas: DataFrame, delay_days: int) -> DataFrame:
    """``deltas`` and ``closed_by``, the batch that closed the row's day (NULL: open).

    The windows sort one row a batch and one a day.
    """
    so_far = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    seen = deltas.groupBy("batch_id").agg(F.max("seen_to").alias("seen_to")).select("batch_id", F.max("seen_to").over(so_far).alias("t"))
    end = (F.unix_date("date").cast("long") + 1 + delay_days) * _DAY_MICROS
    days = deltas.select("date").distinct().select("date", end.alias("t"))
    both = seen.filter("t is not null").withColumn("date", F.lit(None).cast("date")).unionByName(
        days.withColumn("batch_id", F.lit(None).cast("long")))
    # the first batch that has seen so far: the lowest number among those at or behind the day's end
    later = Window.orderBy("t").rangeBetween(0, Window.unboundedFollowing)
    closed = both.select("date", F.min("batch_id").over(later).alias("closed_by")).filter("date is not null")
    return deltas.join(closed, "date")


def closed_totals(deltas: DataFrame, delay_days: int = 1) -> DataFrame:
    """``(date, closed_by, *sums)``: the totals of every closed day as they were when it closed.

    A day that had no order by then gives no row; its later orders are all corrections.
    """
    return (_with_closing(deltas, delay_days).filter("batch_id <= closed_by")
            .groupBy("date", "closed_by").agg(*[F.sum(c).alias(c) for c in SUMS]))


def corrections(deltas: DataFrame, delay_days: int = 1) -> DataFrame:
    """``(date, batch_id, *sums)``: what later batches changed in days that were closed, signed.

    ``closed_totals`` plus these give ``current_totals`` of the closed days.
    """
    changed = F.lit(False)
    for c in SUMS:
        changed = changed | (F.col(c) != 0)
    return _with_closing(deltas, delay_days).filter("batch_id > closed_by").filter(changed).select("date", "batch_id", *SUMS)
