"""Sales aggregates over canonical order lines (AGG2-AGG18, JON1/JON2, SRT*, LIM*).

Money and order counts are taken once per order, quantities once per line.

Order grain (``first_orders``): one ``groupBy(key)`` with ``min_by(x, ingest_seq)``
for every order attribute.  Lines of one document share those attributes, so
this is the first document of the key; the buffers are fixed-width (number or
timestamp over a BIGINT ordering), so Spark plans a HashAggregate that combines
map-side: even a key carrying a third of all lines leaves one partial row per
task before the shuffle.  No window, no join on lines.

Line-grain quantities ride along: results with both grains aggregate once by
(order, calendar value), mark each order's first row in that reduced frame and
sum conditionally, so the facts are read and joined once.  Calendar parts are
always derived from ``order_datetime`` (schema invariant:
order_date/hour/month/weekday are functions of it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import short_name
from ..functions.time import WEEKDAY_NAMES, month_text, ntz, weekday_name
from .grain import DEFAULT_KEY

MONEY = ("order_net_sales", "total_price", "coupon_used")


def first_orders(lines: DataFrame, key=DEFAULT_KEY, money=MONEY) -> DataFrame:
    """One row per key: order time and money of its first document (AGG1).

    Lines of one document share these attributes, so the row with the smallest
    ``ingest_seq`` is the first document.  ``min_by`` over a BIGINT keeps the
    buffers fixed-width (HashAggregate) and combines map-side: a hot key
    leaves one partial row per task.
    """
    return lines.groupBy(*key).agg(
        F.min_by("order_datetime", "ingest_seq").alias("order_datetime"),
        *[F.min_by(m, "ingest_seq").alias(m) for m in money],
    )


def orders_with_lines(lines: DataFrame, key=DEFAULT_KEY, money=MONEY) -> DataFrame:
    """``first_orders`` plus per-key line sums (items, first arrival, date range).

    When the grouping of a result is part of the order key, line-grain totals
    roll up exactly from these per-key sums, so one scan and one shuffle give
    both grains.
    """
    return lines.groupBy(*key).agg(
        F.min_by("order_datetime", "ingest_seq").alias("order_datetime"),
        *[F.min_by(m, "ingest_seq").alias(m) for m in money],
        F.sum("quantity").alias("_items"),
        F.min("ingest_seq").alias("_first_seq"),
        F.min(F.to_date("order_datetime")).alias("_dmin"),
        F.max(F.to_date("order_datetime")).alias("_dmax"))


def _count_orders(key, group=()) -> Column:
    # nunique(order_number) over the deduplicated rows.  When the key is the
    # number plus grouping columns, every row of a group already has a
    # distinct number and a plain count avoids the distinct-aggregate rewrite.
    if set(key) - set(group) - {"order_number"} == set():
        return F.count("order_number")
    return F.count_distinct("order_number")


TIME_PARTS = {
    "date": lambda t: F.to_date(t),
    "month": lambda t: month_text(t),
    "hour": lambda t: F.hour(t),
    "weekday": lambda t: F.weekday(t),
}


def _first_per_order(lines: DataFrame, part: str, key, money, items: bool) -> DataFrame:
    """One row per (key, calendar value): money of its first document, Σ quantity, and whether
    it is the key's first row (``_first``).

    One pass over the lines: the aggregate combines map-side, and the window sees at most one
    row per calendar value of a key, however hot the key is.
    """
    t = TIME_PARTS[part](F.col("order_datetime"))
    per = lines.groupBy(*key, t.alias(part)).agg(
        F.min("ingest_seq").alias("_seq"), *[F.min_by(m, "ingest_seq").alias(m) for m in money],
        *([F.sum("quantity").alias("_items")] if items else []))
    earliest = Window.partitionBy(*key).orderBy("_seq", F.col(part).asc_nulls_last())
    return per.withColumn("_first", F.row_number().over(earliest) == 1)


def _by_time(lines: DataFrame, part: str, key, money: dict, items: bool, group=()) -> DataFrame:
    """First documents (and line quantities) grouped by a calendar part, inside ``group``.

    ``money`` maps output names to order-level columns.  Values without any first document
    have no row.  Item counts follow each line's own date.
    """
    key = tuple(dict.fromkeys((*group, *key)))
    per = _first_per_order(lines, part, key, tuple(money.values()), items).filter(F.col(part).isNotNull())
    number = F.when(F.col("_first"), F.col("order_number"))
    plain = set(key) - set(group) - {"order_number"} == set()
    return (per.groupBy(*group, part).agg(
        (F.count(number) if plain else F.count_distinct(number)).alias("order_count"),
        *[F.sum(F.when(F.col("_first"), F.col(c))).alias(n) for n, c in money.items()],
        F.max(F.col("_first")).alias("_any"),
        *([F.sum("_items").alias("item_count")] if items else []))
        .filter("_any").drop("_any"))


NET = {"total_sales": "order_net_sales"}


def daily_sales(lines: DataFrame, key=DEFAULT_KEY, group=()) -> DataFrame:
    """AGG2 (+JON1): date, order_count, total_sales, gross_sales, coupon_total, item_count (per ``group``)."""
    out = _by_time(lines, "date", key, NET | {"gross_sales": "total_price", "coupon_total": "coupon_used"}, True, group)
    return out.select(*group, "date", "order_count", "total_sales", "gross_sales", "coupon_total",
                      "item_count").orderBy(*group, "date")


def monthly_sales(lines: DataFrame, key=DEFAULT_KEY, group=()) -> DataFrame:
    """AGG3 (+JON2): month, order_count, total_sales, item_count (per ``group``)."""
    out = _by_time(lines, "month", key, NET, True, group)
    return out.select(*group, "month", "order_count", "total_sales", "item_count").orderBy(*group, "month")


def _first_by_time(lines: DataFrame, part: str, key, group) -> DataFrame:
    # no line quantities: first documents alone, one hash aggregate per order
    key = tuple(dict.fromkeys((*group, *key)))
    orders = first_orders(lines, key, money=("order_net_sales",))
    return (orders.withColumn(part, TIME_PARTS[part](F.col("order_datetime"))).filter(F.col(part).isNotNull())
            .groupBy(*group, part).agg(_count_orders(key, (*group, part)).alias("order_count"),
                                       F.sum("order_net_sales").alias("total_sales")))


def hourly_sales(lines: DataFrame, key=DEFAULT_KEY, group=()) -> DataFrame:
    """AGG6: hour, order_count, total_sales (per ``group``)."""
    out = _first_by_time(lines, "hour", key, group)
    return out.select(*group, "hour", "order_count", "total_sales").orderBy(*group, "hour")


def weekday_sales(lines: DataFrame, key=DEFAULT_KEY, group=()) -> DataFrame:
    """AGG7: weekday (0=Mon), order_count, total_sales, weekday_name (per ``group``)."""
    out = _first_by_time(lines, "weekday", key, group)
    return out.select(*group, "weekday", "order_count", "total_sales",
                      weekday_name("weekday").alias("weekday_name")).orderBy(*group, "weekday")


def hour_weekday_heatmap(lines: DataFrame, key=DEFAULT_KEY, group=()) -> DataFrame:
    """AGG8: one row per hour seen, one column per weekday 月..日 (Σ net, 0 fill), per ``group``."""
    key = tuple(dict.fromkeys((*group, *key)))
    orders = first_orders(lines, key, money=("order_net_sales",))
    t = F.col("order_datetime")
    o = (orders.select(*group, F.hour(t).alias("order_hour"), F.weekday(t).alias("wd"), "order_net_sales")
               .filter(F.col("order_hour").isNotNull() & F.col("wd").isNotNull()))
    # Pivot by conditional sums: fixed column order, zero for unseen weekdays, and a
    # single hash aggregation (groupBy().pivot() plans two levels plus PivotFirst).
    return o.groupBy(*group, "order_hour").agg(*[
        F.coalesce(F.sum(F.when(F.col("wd") == i, F.col("order_net_sales"))), F.lit(0)).cast("bigint").alias(n)
        for i, n in enumerate(WEEKDAY_NAMES)]).orderBy(*group, "order_hour")


def summary_stats(lines: DataFrame, key=DEFAULT_KEY, group=()) -> DataFrame:
    """AGG9: one row (per ``group`` if given) of KPIs; zeros on empty input.

    total_orders  distinct order numbers over all lines
    total_sales / gross_sales / avg_order_value  over first documents
    total_items   Σ quantity over all lines; period_start/end min/max date.
    One per-order aggregate carries the line sums, then one small roll-up.
    """
    key = tuple(dict.fromkeys((*group, *key)))
    per = orders_with_lines(lines, key, money=("order_net_sales", "total_price"))
    out = per.groupBy(*group).agg(
        _count_orders(key, group).alias("total_orders"),
        F.sum("order_net_sales").alias("total_sales"),
        F.sum("total_price").alias("gross_sales"),
        F.avg("order_net_sales").alias("avg_order_value"),
        F.sum("_items").alias("total_items"),
        F.min("_dmin").alias("period_start"),
        F.max("_dmax").alias("period_end"))
    return out.select(
        *group,
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("total_sales", F.lit(0)).cast("bigint").alias("total_sales"),
        F.coalesce("gross_sales", F.lit(0)).cast("bigint").alias("gross_sales"),
        F.coalesce("total_items", F.lit(0)).cast("bigint").alias("total_items"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        "period_start", "period_end")


# ---------------------------------------------------------------------------
# Product aggregates (line grain)
# ---------------------------------------------------------------------------
def product_key() -> Column:
    """PRJ15: item_number when non-empty, else item_id."""
    return F.coalesce(F.nullif(F.col("item_number"), F.lit("")), F.col("item_id"))


def _first_nonnull(c: str, order: Column) -> Column:
    # pandas ``first``: first non-null value in input order; min_by skips NULL orderings.
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)


def product_sales(lines: DataFrame, group=()) -> DataFrame:
    """AGG4: per product key: first name/number/id, Σ quantity, Σ subtotal, distinct orders.

    One ``groupBy`` with ``COUNT(DISTINCT order_number)``: Spark plans the
    distinct aggregate in two hash-partitioned levels ((group, key, order) then
    (group, key)) and carries the other aggregates through them.
    """
    order = F.struct("ingest_seq", "line_seq", "item_id")
    g = lines.withColumn("_group_key", product_key()).filter(F.col("_group_key").isNotNull())
    return g.groupBy(*group, "_group_key").agg(
        _first_nonnull("item_name", order),
        F.sum("quantity").alias("quantity"),
        F.sum("subtotal").alias("total_sales"),
        F.count_distinct("order_number").alias("order_count"),
        _first_nonnull("item_number", order),
        _first_nonnull("item_id", order))


def product_sales_sorted(lines: DataFrame) -> DataFrame:
    """AGG4 + SRT2: total_sales desc, product key asc as tie-break (D17)."""
    return (product_sales(lines)
            .orderBy(F.desc("total_sales"), F.asc("_group_key"))
            .select("item_name", "quantity", "total_sales", "order_count", "item_number", "item_id"))


def product_sales_by_id_name(lines: DataFrame) -> DataFrame:
    """AGG5: fallback grouping by (item_id, item_name) when there is no item number."""
    return (lines.groupBy("item_id", "item_name").agg(
        F.sum("quantity").alias("quantity"), F.sum("subtotal").alias("total_sales"),
        F.count_distinct("order_number").alias("order_count"))
        .orderBy(F.desc("total_sales"), "item_id", "item_name"))


_TEXTS = ("item_name", "item_number", "item_id")
_PRODUCT_COLS = ("item_name", "quantity", "total_sales", "order_count", "item_number", "item_id")


def _product_numbers(lines: DataFrame, group=()) -> DataFrame:
    """AGG4 without its texts: sums, distinct orders, and for each text the first document that has it.

    All buffers are numbers, so the aggregate is hashed and no name travels with a partial row."""
    g = lines.withColumn("_group_key", product_key()).filter(F.col("_group_key").isNotNull())
    return g.groupBy(*group, "_group_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("subtotal").alias("total_sales"), F.count_distinct("order_number").alias("order_count"),
        *[F.min(F.when(F.col(c).isNotNull(), F.col("ingest_seq"))).alias(f"_{c}_at") for c in _TEXTS])


def _with_first_texts(winners: DataFrame, lines: DataFrame, group=()) -> DataFrame:
    """``winners`` of ``_product_numbers`` with their texts, fetched from the lines of their first documents only."""
    key = [*group, "_group_key"]
    ats = [F.col(f"_{c}_at") for c in _TEXTS]
    text = (lines.withColumn("_group_key", product_key()).select(*key, "ingest_seq", "line_seq", *[F.col(c).alias(f"_t_{c}") for c in _TEXTS])
            .withColumnsRenamed({k: f"_k_{k}" for k in key}))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    met = winners.join(text, same & F.col("ingest_seq").isin(*ats), "left")
    order = Window.partitionBy(*key).orderBy("ingest_seq", "line_seq", "_t_item_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = [F.first(f"_t_{c}", ignorenulls=True).over(order).alias(c) for c in _TEXTS]
    one = F.row_number().over(Window.partitionBy(*key).orderBy("ingest_seq", "line_seq", "_t_item_id")).alias("_one")
    return met.select(*winners.columns, *first, one).filter("_one = 1").drop("_one")


def top_products(lines: DataFrame, n: int) -> DataFrame:
    """LIM1-LIM3: the n best products (TakeOrderedAndProject: per-task top-n, then merge).

    Numbers first; only the winners fetch their texts, in a second pass over the lines."""
    best = _product_numbers(lines).orderBy(F.desc("total_sales"), F.asc("_group_key")).limit(n)
    return _with_first_texts(best, lines).orderBy(F.desc("total_sales"), F.asc("_group_key")).select(*_PRODUCT_COLS)


def top_products_per_store(lines: DataFrame, n: int = 10) -> DataFrame:
    """LIM3 for every store at once: row_number over the per-store product numbers, then the winners' texts."""
    w = Window.partitionBy("source").orderBy(F.desc("total_sales"), F.asc("_group_key"))
    best = _product_numbers(lines, ("source",)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return _with_first_texts(best, lines, ("source",)).select("source", "rank", *_PRODUCT_COLS)


def top_product_share(lines: DataFrame, n: int = 10) -> DataFrame:
    """AGG18/WIN4: share of each of the top-n products, merged by 30-char short name.

    NULL shares when the top products sum to 0.
    """
    top = top_products(lines, n).withColumn("short_name", short_name("item_name"))
    merged = top.groupBy("short_name").agg(F.sum("total_sales").alias("total_sales"))
    return merged.withColumn(
        "share", F.try_divide(F.col("total_sales"), F.sum("total_sales").over(Window.partitionBy())))


# ---------------------------------------------------------------------------
# Period / store KPIs (AGG10-AGG17)
# ---------------------------------------------------------------------------
def period_filter(lines: DataFrame, start, end) -> DataFrame:
    """FLT7: inclusive date range on the order date; a bound of None is open.

    Stated on ``order_datetime`` (a half-open day range) so it reaches the scan.
    """
    import datetime as _dt
    t = F.col("order_datetime")
    if start is not None:
        lines = lines.filter(t >= ntz(start))
    if end is not None:
        lines = lines.filter(t < ntz(end + _dt.timedelta(days=1)))
    return lines


def period_kpi(lines: DataFrame, start, end, key=DEFAULT_KEY, group=()) -> DataFrame:
    """AGG10: sales, orders, items for [start, end]; zeros when nothing matches."""
    p = period_filter(lines, start, end)
    key = tuple(dict.fromkeys((*group, *key)))
    per = orders_with_lines(p, key, money=("order_net_sales",))
    out = per.groupBy(*group).agg(F.sum("order_net_sales").alias("sales"),
                                  F.count(F.lit(1)).alias("orders"),
                                  F.sum("_items").alias("items"))
    return out.select(*group,
                      F.coalesce("sales", F.lit(0)).cast("bigint").alias("sales"),
                      F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
                      F.coalesce("items", F.lit(0)).cast("bigint").alias("items"))


def source_kpi(lines: DataFrame, start, end, stores=None, key=DEFAULT_KEY) -> DataFrame:
    """AGG11 set form: sales and orders per store for [start, end].

    Deduplication runs inside each store (the reference filters first).  With
    ``stores`` (a small configured list) every store appears, 0 when absent (JON5).
    """
    k = period_kpi(lines, start, end, key=key, group=("source",)).select("source", "sales", "orders")
    if stores is None:
        return k
    dim = store_dim(lines.sparkSession, stores)
    return (dim.join(k, dim.name == k.source, "left")
               .select(F.col("name").alias("source"),
                       F.coalesce("sales", F.lit(0)).alias("sales"),
                       F.coalesce("orders", F.lit(0)).alias("orders"), "store_seq")
               .orderBy("store_seq").drop("store_seq"))


def store_dim(spark, stores) -> DataFrame:
    """M10: the configured stores (a short parameter list)."""
    return spark.createDataFrame([(s, i) for i, s in enumerate(stores)], "name string, store_seq int")


def daily_store_sales(lines: DataFrame, key=DEFAULT_KEY) -> DataFrame:
    """AGG12: per (store, day): dedup inside the day and store, then Σ net."""
    k = tuple(dict.fromkeys(("source", "order_date", *key)))
    orders = first_orders(lines.filter(F.col("order_date").isNotNull()), k, money=("order_net_sales",))
    return (orders.groupBy("source", "order_date")
                  .agg(F.sum("order_net_sales").alias("total_sales"))
                  .select("source", F.col("order_date").alias("date"), "total_sales"))


def day_store_pivot(lines: DataFrame, stores, key=DEFAULT_KEY) -> DataFrame:
    """AGG13: one row per date in the data; one column per configured store; total (D19).

    One per-(date, store, order) aggregate over all lines, then conditional
    sums by date: dates whose orders all belong to other stores stay, with zeros.
    """
    k = tuple(dict.fromkeys(("order_date", "source", *key)))
    orders = first_orders(lines.filter(F.col("order_date").isNotNull()), k, money=("order_net_sales",))
    cols = [F.coalesce(F.sum(F.when(F.col("source") == s, F.col("order_net_sales"))), F.lit(0)).cast("bigint")
            for s in stores]
    wide = orders.groupBy(F.col("order_date").alias("date")).agg(
        *[c.alias(f"{s} 売上") for c, s in zip(cols, stores)])
    total = sum([F.col(f"`{s} 売上`") for s in stores[1:]], F.col(f"`{stores[0]} 売上`")) if stores \
        else F.lit(0).cast("bigint")
    return wide.withColumn("合計 売上", total).orderBy("date")


def daily_average(sales: Column, start, end) -> Column:
    """AGG15: sales / max(days in [start, end], 1)."""
    return average_over(sales, F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1)


def average_over(sales: Column, days: Column) -> Column:
    """AGG15 for a column of day counts."""
    return sales.cast("double") / F.greatest(days, F.lit(1))


def total_and_store_stats(lines: DataFrame, key=DEFAULT_KEY) -> DataFrame:
    """AGG14: summary stats for the whole set (scope='total') and for each store.

    The total deduplicates by ``key`` across stores, each store inside itself,
    exactly as filtering per store would.  One aggregate per (store, key) reads
    the lines once; its rows, tagged with both scopes, roll up from there.
    """
    money = ("order_net_sales", "total_price")
    per = orders_with_lines(lines, tuple(dict.fromkeys(("source", *key))), money=money)
    # an empty row makes the total appear (with zeros) when there are no lines
    per = per.unionByName(lines.sparkSession.range(1).select(F.lit(None).cast("string").alias("order_number")),
                          allowMissingColumns=True)
    own = [F.col(c).alias(f"_key_{c}") for c in key]
    scoped = (per.select(F.explode(F.array(F.lit("total"), F.lit("store"))).alias("scope"), "source", *own,
                         *money, "_first_seq", "_items", "_dmin", "_dmax")
              .filter((F.col("scope") == "total") | F.col("_first_seq").isNotNull())
              .withColumn("source", F.when(F.col("scope") == "store", F.col("source"))))
    orders = scoped.groupBy("scope", "source", *[f"_key_{c}" for c in key]).agg(
        *[F.min_by(m, "_first_seq").alias(m) for m in money], F.sum("_items").alias("_items"),
        F.min("_dmin").alias("_dmin"), F.max("_dmax").alias("_dmax"))
    out = orders.groupBy("scope", "source").agg(
        (F.count if tuple(key) == ("order_number",) else F.count_distinct)("_key_order_number").alias("total_orders"),
        F.sum("order_net_sales").alias("total_sales"), F.sum("total_price").alias("gross_sales"),
        F.avg("order_net_sales").alias("avg_order_value"), F.sum("_items").alias("total_items"),
        F.min("_dmin").alias("period_start"), F.max("_dmax").alias("period_end"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select("scope", "source", *[zero(c) for c in ("total_orders", "total_sales", "gross_sales", "total_items")],
                      F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"), "period_start", "period_end")


def import_summary(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """AGG16: row count and first/last date of an imported dataset."""
    return df.agg(F.count(F.lit(1)).alias("count"), F.min(date_col).alias("start"),
                  F.max(date_col).alias("end"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """AGG17: distinct dates / stores (sorted)."""
    return df.select(column).distinct().orderBy(column)
