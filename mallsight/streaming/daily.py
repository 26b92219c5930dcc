"""STR1: incremental daily sales from landed order documents.

readStream (JSON, explicit schema) -> drop cancelled -> event time ->
withWatermark -> dropDuplicatesWithinWatermark(orderNumber) -> one row per
document with its item count -> groupBy(window(1 day)) -> append to parquet.

* Whole documents are deduplicated *before* anything is exploded, so a
  re-fetched order never doubles its lines.  Item counts are summed inside the
  document with higher-order functions (no explode, no shuffle).
* Day windows follow the JST calendar whatever the session zone: the event
  time is the JST wall clock read as UTC (exact microsecond arithmetic).
* Append mode emits a day once the watermark passes its end; open days stay in
  state.  Events older than the watermark of their micro-batch are dropped, the
  standard late-data rule, and ``run_daily_totals`` counts them: a run that
  dropped any raises.  Land files in time order when running many batches.
* The checkpoint lives under the shared checkpoint folder, so a restarted
  driver resumes where the stream stopped and a lost executor only re-runs
  its tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import ntz, parse_offset_time
from ..operators.flatten import parse_once
from ..sources.adapters import CANCELLED
from ..sources.readers import R_ORDER_LANDED

_EPOCH = dt.datetime(1970, 1, 1)
_DAY_MICROS = 86_400_000_000


def event_time(wall_clock: Column) -> Column:
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP whose UTC reading is that wall clock."""
    micros = F.timestamp_diff("MICROSECOND", ntz(_EPOCH), wall_clock)
    return F.timestamp_micros(micros)


def _items_in_document() -> tuple[Column, Column]:
    """(Σ units over all items, number of items) of one R document."""
    empty = F.array().cast("array<struct<itemId:string,itemName:string,itemNumber:string,"
                           "price:bigint,units:bigint>>")
    items = F.flatten(F.transform(F.coalesce("PackageModelList", F.array()),
                                  lambda p: F.coalesce(p.getField("ItemModelList"), empty)))
    units = F.aggregate(items, F.lit(0).cast("bigint"),
                        lambda acc, x: acc + F.coalesce(x.getField("units"), F.lit(1).cast("bigint")))
    return units, F.size(items)


DEDUP_SALTS = 64


def daily_totals_stream(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Streaming plan: closed-day totals from a stream of R order documents.

    Deduplication runs in two stages so a hot order number (say the empty one
    on a third of all documents) never lands whole in one task: first per
    (number, salt) where the salt hashes the document's content and sequence,
    then per number over at most ``DEDUP_SALTS`` survivors per number and batch.
    Copies that differ in content: the first to arrive counts.
    """
    units, n_items = _items_in_document()
    goods = F.coalesce(F.col("goodsPrice"), F.lit(0).cast("bigint"))
    coupon = F.coalesce(F.col("couponAllTotalPrice"), F.lit(0).cast("bigint"))
    salt = F.pmod(F.xxhash64(F.col("orderDatetime"), F.col("goodsPrice"), F.col("_store_name"),
                             F.col("_ingest_seq")), F.lit(DEDUP_SALTS))
    docs = (stream.filter(F.coalesce(F.col("orderProgress"), F.lit(0)) != CANCELLED)
            .select("*", *parse_once(event_time(parse_offset_time("orderDatetime")).alias("event_time")))
            # documents without lines give no row (D15), so they must not win the deduplication
            .withColumn("_n_items", n_items)
            .filter(F.col("event_time").isNotNull() & (F.col("_n_items") > 0))
            .withColumn("_salt", salt)
            .withWatermark("event_time", watermark)
            .dropDuplicatesWithinWatermark(["orderNumber", "_salt"])
            .dropDuplicatesWithinWatermark(["orderNumber"])
            .select("orderNumber", "event_time", goods.alias("goods"), coupon.alias("coupon"), units.alias("units")))
    agg = docs.groupBy(F.window("event_time", "1 day")).agg(
        F.count("orderNumber").alias("order_count"),
        F.sum(F.col("goods") - F.col("coupon")).alias("total_sales"),
        F.sum("goods").alias("gross_sales"),
        F.sum("coupon").alias("coupon_total"),
        F.sum("units").alias("item_count"))
    day = F.date_from_unix_date((F.unix_micros(F.col("window.start")) / _DAY_MICROS).cast("int"))
    return agg.select(day.alias("date"), "order_count", "total_sales", "gross_sales",
                      "coupon_total", "item_count")


class LateRowsError(RuntimeError):
    """Rows arrived after their day was closed and were left out of the totals."""


#: Batches whose progress Spark keeps during a run, at least; it is read every second.
RETAINED = 1000


def _late_rows(q: StreamingQuery, retained: int) -> int:
    """Waits for ``q`` and sums the rows that the watermark dropped over all of its batches."""
    late: dict[int, int] = {}
    ended = False
    while not ended:
        ended = q.awaitTermination(1)
        seen = {p.batchId: sum(op.numRowsDroppedByWatermark for op in p.stateOperators) for p in q.recentProgress}
        if seen and (min(seen) > max(late) + 1 if late else len(seen) >= retained):
            q.stop()
            raise LateRowsError("batches ran faster than their progress was read: late rows are not known")
        late.update(seen)
    return sum(late.values())


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_daily_totals(spark: SparkSession, source: str, sink: str, checkpoint: str,
                     watermark: str = "1 day", max_files_per_trigger: int | None = None,
                     allow_late: bool = False) -> DataFrame:
    """Run the stream over everything landed so far (availableNow) and read the sink.

    Rerunning with the same checkpoint processes only new files and appends
    only newly closed days (exactly once into the file sink).  State lives in
    RocksDB on the executors' disks, not in their heaps.  ``max_files_per_trigger``
    bounds a batch; files must then land in time order.  Rows that come after
    the watermark has closed their day are counted, and raise ``LateRowsError``
    unless ``allow_late``: the totals in the sink lack them.
    """
    reader = spark.readStream.schema(R_ORDER_LANDED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source)
    retention = "spark.sql.streaming.numRecentProgressUpdates"
    retained = max(int(spark.conf.get(retention, "100")), RETAINED)
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, retention: str(retained)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        q = (daily_totals_stream(stream, watermark).writeStream
             .outputMode("append").format("parquet")
             .option("path", sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        late = _late_rows(q, retained)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if late and not allow_late:
        raise LateRowsError(f"{late} rows came after their day was closed and are not in the totals")
    return spark.read.parquet(sink)
