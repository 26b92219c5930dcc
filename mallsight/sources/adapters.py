"""Driver tables -> canonical order lines.

``star_lines``  orders ⋈ lineitem (⋈ part) (⋈ customer ⋈ nation ⋈ region)
``event_lines`` events, one single-line order per event (sub-day times)

Each adapter has a SQL twin (``*_sql``) producing the same rows in DuckDB's
dialect; the oracle queries in ``plans.catalog`` are built on the twins.

Join plan (scale notes)
-----------------------
* Dimensions are joined LEFT on their primary key, so an adapter without a
  dimension returns exactly the same lines; callers that do not need product
  or store columns skip those joins (``product=False`` / ``store=False``).
* ``nation ⋈ region`` is fixed-size by definition (25 x 5 rows).  ``part`` and ``customer`` grow with the data: the
  planner broadcasts them only under ``spark.sql.autoBroadcastJoinThreshold``
  (static estimate) or AQE's runtime size check, and sort-merge joins otherwise.
* ``orders`` is enriched with its store first (orders-sized join) and then
  joined to ``lineitem`` on the order key, so the line-sized side is shuffled
  once on ``l_orderkey``.  The order-grain aggregates group by the text number
  and shuffle again, after combining map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import with_time_parts
from ..schema import ORDER_LINE_COLUMNS
from .tables import read_table, table_path

CANCELLED = 900      # fixed value: order status code of a cancelled order
ACTIVE = 100


def cents(c: str):
    """Decimal currency (double) -> integral minor units."""
    return F.round(F.col(c) * 100).cast("bigint")


def _store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    # nation and region have a fixed row count (25 / 5) at every scale factor.
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left") \
        .select("n_nationkey", F.col("n_name").alias("source"), F.col("r_name").alias("mall"))


def star_orders(spark: SparkSession, sf_dir: str, store: bool = True,
                drop_cancelled: bool = True) -> DataFrame:
    """Order-grain attributes of the star tables (one row per order)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_totalprice", "o_orderdate", "o_orderpriority"])
    if drop_cancelled:
        # FLT1 expressed on the stored column so the parquet reader can skip it.
        o = o.filter(~F.col("o_orderstatus").eqNullSafe("P"))
    total = cents("o_totalprice")
    # coupon = total x (first digit of the priority) percent, integer division
    coupon = F.expr("CAST(ROUND(o_totalprice * 100) AS BIGINT) "
                    "* CAST(substring(o_orderpriority, 1, 1) AS INT) DIV 100")
    o = o.select(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.col("o_orderkey").cast("string").alias("order_number"),
        F.col("o_orderkey").alias("ingest_seq"),
        F.col("o_orderdate").alias("order_datetime"),
        F.when(F.col("o_orderstatus") == "P", F.lit(CANCELLED)).otherwise(F.lit(ACTIVE)).alias("status"),
        total.alias("total_price"),
        coupon.alias("coupon_used"),
        ((F.col("o_custkey") % 4) * 100).alias("point_used"),
    ).withColumn("order_net_sales", F.col("total_price") - F.col("coupon_used"))
    if store:
        cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
        o = (o.join(cust, o.o_custkey == cust.c_custkey, "left")
              .join(_store_dim(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .withColumnRenamed("c_mktsegment", "payment_method"))
    else:
        o = (o.withColumn("payment_method", F.lit(None).cast("string"))
              .withColumn("source", F.lit(None).cast("string"))
              .withColumn("mall", F.lit(None).cast("string")))
    return o


def star_lines(spark: SparkSession, sf_dir: str, product: bool = True, store: bool = True,
               drop_cancelled: bool = True) -> DataFrame:
    """Canonical order lines from the star tables (columns: schema.ORDER_LINE)."""
    o = star_orders(spark, sf_dir, store=store, drop_cancelled=drop_cancelled)
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey",
                                                  "l_linenumber", "l_quantity", "l_extendedprice"])
    df = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    if product:
        part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_size"])
        df = df.join(part, df.l_partkey == part.p_partkey, "left")
        item_name = F.col("p_name")
        item_number = F.when(F.col("p_size") < 5, F.lit("")).otherwise(
            F.concat(F.lit("SKU-"), (F.col("p_partkey") % 500).cast("string")))
    else:
        item_name = F.lit(None).cast("string")
        item_number = F.lit(None).cast("string")
    qty = F.col("l_quantity").cast("bigint")
    unit_price = F.expr("CAST(ROUND(l_extendedprice * 100) AS BIGINT) DIV CAST(l_quantity AS BIGINT)")
    df = df.select(
        "order_number", "order_datetime",
        F.col("l_partkey").cast("string").alias("item_id"),
        item_name.alias("item_name"),
        item_number.alias("item_number"),
        unit_price.alias("unit_price"),
        qty.alias("quantity"),
        (unit_price * qty).alias("subtotal"),
        "point_used", "coupon_used",
        ((F.col("l_suppkey") % 5) * 100).alias("shipping_charge"),
        "total_price", "order_net_sales", "payment_method", "status", "source", "mall",
        F.col("l_linenumber").cast("bigint").alias("line_seq"),
        "ingest_seq",
    )
    return with_time_parts(df).select(*ORDER_LINE_COLUMNS)


def event_lines(spark: SparkSession, sf_dir: str, drop_cancelled: bool = True) -> DataFrame:
    """Canonical order lines from ``events``: each event is a one-line order.

    order_number = event_id, store = event_type, status 900 for 'error',
    net = value in minor units, quantity = 1 + user_id % 3, item = props.k.
    """
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    if drop_cancelled:
        e = e.filter(~F.col("event_type").eqNullSafe("error"))
    total = cents("value")
    qty = (F.lit(1) + F.col("user_id") % 3).cast("bigint")
    unit = F.expr("CAST(ROUND(value * 100) AS BIGINT) DIV (1 + user_id % 3)")
    df = e.select(
        F.col("event_id").cast("string").alias("order_number"),
        F.col("ts").alias("order_datetime"),
        F.get_json_object("props", "$.k").alias("item_id"),
        F.col("event_type").alias("item_name"),
        F.lit("").alias("item_number"),
        unit.alias("unit_price"),
        qty.alias("quantity"),
        (unit * qty).alias("subtotal"),
        F.lit(0).cast("bigint").alias("point_used"),
        F.lit(0).cast("bigint").alias("coupon_used"),
        F.lit(0).cast("bigint").alias("shipping_charge"),
        total.alias("total_price"),
        total.alias("order_net_sales"),
        F.lit("").alias("payment_method"),
        F.when(F.col("event_type") == "error", F.lit(CANCELLED)).otherwise(F.lit(ACTIVE)).alias("status"),
        F.col("event_type").alias("source"),
        F.lit("events").alias("mall"),
        F.lit(0).cast("bigint").alias("line_seq"),
        F.col("event_id").alias("ingest_seq"),
    )
    return with_time_parts(df).select(*ORDER_LINE_COLUMNS)


# ---------------------------------------------------------------------------
# SQL twins (DuckDB dialect, tables registered as views by name)
# ---------------------------------------------------------------------------
_TIME_PARTS_SQL = """
       CAST({t} AS DATE) AS order_date,
       CAST(hour({t}) AS INTEGER) AS order_hour,
       strftime({t}, '%Y-%m') AS order_month,
       CAST(isodow({t}) - 1 AS INTEGER) AS order_weekday"""


def star_lines_sql(product: bool = True, store: bool = True, drop_cancelled: bool = True) -> str:
    item_name = "p.p_name" if product else "CAST(NULL AS VARCHAR)"
    item_number = ("CASE WHEN p.p_size < 5 THEN '' ELSE 'SKU-' || CAST(p.p_partkey % 500 AS VARCHAR) END"
                   if product else "CAST(NULL AS VARCHAR)")
    part_join = "LEFT JOIN part p ON l.l_partkey = p.p_partkey" if product else ""
    store_cols = ("c.c_mktsegment AS payment_method, n.n_name AS source, r.r_name AS mall"
                  if store else "CAST(NULL AS VARCHAR) AS payment_method, CAST(NULL AS VARCHAR) AS source, "
                                "CAST(NULL AS VARCHAR) AS mall")
    store_join = ("LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
                  "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey "
                  "LEFT JOIN region r ON n.n_regionkey = r.r_regionkey") if store else ""
    where = "WHERE o.o_orderstatus IS DISTINCT FROM 'P'" if drop_cancelled else ""
    total = "CAST(ROUND(o.o_totalprice * 100) AS BIGINT)"
    coupon = f"({total} * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)) // 100"
    unit = "CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) // CAST(l.l_quantity AS BIGINT)"
    return f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_number,
       o.o_orderdate AS order_datetime,{_TIME_PARTS_SQL.format(t='o.o_orderdate')},
       CAST(l.l_partkey AS VARCHAR) AS item_id,
       {item_name} AS item_name,
       {item_number} AS item_number,
       {unit} AS unit_price,
       CAST(l.l_quantity AS BIGINT) AS quantity,
       ({unit}) * CAST(l.l_quantity AS BIGINT) AS subtotal,
       (o.o_custkey % 4) * 100 AS point_used,
       {coupon} AS coupon_used,
       (l.l_suppkey % 5) * 100 AS shipping_charge,
       {total} AS total_price,
       {total} - {coupon} AS order_net_sales,
       {store_cols},
       CASE WHEN o.o_orderstatus = 'P' THEN 900 ELSE 100 END AS status,
       CAST(l.l_linenumber AS BIGINT) AS line_seq,
       o.o_orderkey AS ingest_seq
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
{part_join}
{store_join}
{where}"""


def event_lines_sql(drop_cancelled: bool = True) -> str:
    where = "WHERE event_type IS DISTINCT FROM 'error'" if drop_cancelled else ""
    total = "CAST(ROUND(value * 100) AS BIGINT)"
    unit = f"{total} // (1 + user_id % 3)"
    return f"""
SELECT CAST(event_id AS VARCHAR) AS order_number,
       ts AS order_datetime,{_TIME_PARTS_SQL.format(t='ts')},
       json_extract_string(props, '$.k') AS item_id,
       event_type AS item_name,
       '' AS item_number,
       {unit} AS unit_price,
       CAST(1 + user_id % 3 AS BIGINT) AS quantity,
       ({unit}) * (1 + user_id % 3) AS subtotal,
       CAST(0 AS BIGINT) AS point_used,
       CAST(0 AS BIGINT) AS coupon_used,
       CAST(0 AS BIGINT) AS shipping_charge,
       {total} AS total_price,
       {total} AS order_net_sales,
       '' AS payment_method,
       CASE WHEN event_type = 'error' THEN 900 ELSE 100 END AS status,
       event_type AS source,
       'events' AS mall,
       CAST(0 AS BIGINT) AS line_seq,
       event_id AS ingest_seq
FROM events
{where}"""


__all__ = ["star_lines", "star_orders", "event_lines", "star_lines_sql", "event_lines_sql",
           "cents", "CANCELLED", "table_path"]
