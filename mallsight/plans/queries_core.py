"""Registered aggregate / filter / grain queries over the adapted driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import filters as FL
from ..operators import grain as G
from ..sources.adapters import event_lines, event_lines_sql, star_lines, star_lines_sql, star_orders
from .catalog import query
from .params import EVENTS_AS_OF, STAR_AS_OF, STAR_STORES
from .windows import month_to_date, yesterday

MTD = month_to_date(STAR_AS_OF)
YDAY = yesterday(STAR_AS_OF)
EV_MTD = month_to_date(EVENTS_AS_OF)


def _lines_cte(kind: str = "star", product: bool = True, store: bool = True) -> str:
    body = star_lines_sql(product=product, store=store) if kind == "star" else event_lines_sql()
    return f"lines AS ({body})"


# Reference-style order grain for the oracle: first row per order number in input order.
_FIRST_ROWS = """first_rows AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_number
                                 ORDER BY ingest_seq, line_seq, item_id) AS rn
    FROM lines) WHERE rn = 1)"""


def _d(d):
    return f"DATE '{d.isoformat()}'"


# --------------------------------------------------------------------- AGG1
@query("agg1_order_grain", oracle=f"""
WITH {_lines_cte(product=False, store=False)}, {_FIRST_ROWS},
items AS (SELECT order_number, CAST(sum(quantity) AS BIGINT) AS items FROM lines GROUP BY 1)
SELECT f.order_number, f.order_datetime, f.order_net_sales, f.total_price, f.coupon_used, i.items
FROM first_rows f JOIN items i USING (order_number)""")
def agg1_order_grain(spark, sf_dir):
    lines = star_lines(spark, sf_dir, product=False, store=False)
    return G.order_grain(lines, ["order_datetime", *A.MONEY], items=True)


# --------------------------------------------------------------------- AGG2
@query("agg2_daily_sales", oracle=f"""
WITH {_lines_cte(product=False, store=False)}, {_FIRST_ROWS},
d AS (SELECT order_date AS date, count(order_number) AS order_count,
             CAST(sum(order_net_sales) AS BIGINT) AS total_sales,
             CAST(sum(total_price) AS BIGINT) AS gross_sales,
             CAST(sum(coupon_used) AS BIGINT) AS coupon_total
      FROM first_rows WHERE order_date IS NOT NULL GROUP BY 1),
i AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS item_count
      FROM lines WHERE order_date IS NOT NULL GROUP BY 1)
SELECT d.date, d.order_count, d.total_sales, d.gross_sales, d.coupon_total, i.item_count
FROM d LEFT JOIN i ON d.date = i.date ORDER BY d.date""")
def agg2_daily_sales(spark, sf_dir):
    return A.daily_sales(star_lines(spark, sf_dir, product=False, store=False))


# --------------------------------------------------------------------- AGG3
@query("agg3_monthly_sales", oracle=f"""
WITH {_lines_cte(product=False, store=False)}, {_FIRST_ROWS},
m AS (SELECT order_month AS month, count(order_number) AS order_count,
             CAST(sum(order_net_sales) AS BIGINT) AS total_sales
      FROM first_rows WHERE order_month IS NOT NULL GROUP BY 1),
i AS (SELECT order_month AS month, CAST(sum(quantity) AS BIGINT) AS item_count
      FROM lines WHERE order_month IS NOT NULL GROUP BY 1)
SELECT m.month, m.order_count, m.total_sales, i.item_count
FROM m LEFT JOIN i ON m.month = i.month ORDER BY m.month""")
def agg3_monthly_sales(spark, sf_dir):
    return A.monthly_sales(star_lines(spark, sf_dir, product=False, store=False))


# --------------------------------------------------------------------- AGG4
_PRODUCT_SQL = """
g AS (SELECT *, coalesce(nullif(item_number, ''), item_id) AS gk FROM lines),
firsts AS (
  SELECT gk,
         arg_min(item_name, (ingest_seq, line_seq, item_id)) FILTER (WHERE item_name IS NOT NULL) AS item_name,
         arg_min(item_number, (ingest_seq, line_seq, item_id)) FILTER (WHERE item_number IS NOT NULL) AS item_number,
         arg_min(item_id, (ingest_seq, line_seq, item_id)) FILTER (WHERE item_id IS NOT NULL) AS item_id,
         CAST(sum(quantity) AS BIGINT) AS quantity,
         CAST(sum(subtotal) AS BIGINT) AS total_sales,
         count(DISTINCT order_number) AS order_count
  FROM g WHERE gk IS NOT NULL GROUP BY gk)"""


@query("agg4_product_sales", oracle=f"""
WITH {_lines_cte()}, {_PRODUCT_SQL}
SELECT item_name, quantity, total_sales, order_count, item_number, item_id
FROM firsts ORDER BY total_sales DESC, gk""")
def agg4_product_sales(spark, sf_dir):
    return A.product_sales_sorted(star_lines(spark, sf_dir, store=False))


# --------------------------------------------------------------------- AGG5
@query("agg5_product_by_id_name", oracle=f"""
WITH {_lines_cte()}
SELECT item_id, item_name, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(subtotal) AS BIGINT) AS total_sales, count(DISTINCT order_number) AS order_count
FROM lines GROUP BY item_id, item_name""")
def agg5_product_by_id_name(spark, sf_dir):
    return A.product_sales_by_id_name(star_lines(spark, sf_dir, store=False))


# --------------------------------------------------------------------- AGG6
@query("agg6_hourly_sales", oracle=f"""
WITH {_lines_cte('events')}, {_FIRST_ROWS}
SELECT order_hour AS hour, count(order_number) AS order_count,
       CAST(sum(order_net_sales) AS BIGINT) AS total_sales
FROM first_rows WHERE order_hour IS NOT NULL GROUP BY 1 ORDER BY 1""")
def agg6_hourly_sales(spark, sf_dir):
    return A.hourly_sales(event_lines(spark, sf_dir))


# --------------------------------------------------------------------- AGG7
_WEEKDAY_CASE = ("CASE order_weekday WHEN 0 THEN '月' WHEN 1 THEN '火' WHEN 2 THEN '水' "
                 "WHEN 3 THEN '木' WHEN 4 THEN '金' WHEN 5 THEN '土' WHEN 6 THEN '日' END")


@query("agg7_weekday_sales", oracle=f"""
WITH {_lines_cte(product=False, store=False)}, {_FIRST_ROWS}
SELECT order_weekday AS weekday, count(order_number) AS order_count,
       CAST(sum(order_net_sales) AS BIGINT) AS total_sales, {_WEEKDAY_CASE} AS weekday_name
FROM first_rows WHERE order_weekday IS NOT NULL GROUP BY order_weekday ORDER BY 1""")
def agg7_weekday_sales(spark, sf_dir):
    return A.weekday_sales(star_lines(spark, sf_dir, product=False, store=False))


@query("agg7_weekday_sales_events", oracle=f"""
WITH {_lines_cte('events')}, {_FIRST_ROWS}
SELECT order_weekday AS weekday, count(order_number) AS order_count,
       CAST(sum(order_net_sales) AS BIGINT) AS total_sales, {_WEEKDAY_CASE} AS weekday_name
FROM first_rows WHERE order_weekday IS NOT NULL GROUP BY order_weekday ORDER BY 1""")
def agg7_weekday_sales_events(spark, sf_dir):
    return A.weekday_sales(event_lines(spark, sf_dir))


# --------------------------------------------------------------------- AGG8
_HEAT_COLS = ",\n       ".join(
    f"CAST(coalesce(sum(order_net_sales) FILTER (WHERE order_weekday = {i}), 0) AS BIGINT) AS \"{n}\""
    for i, n in enumerate(["月", "火", "水", "木", "金", "土", "日"]))


@query("agg8_hour_weekday_heatmap", oracle=f"""
WITH {_lines_cte('events')}, {_FIRST_ROWS}
SELECT order_hour, {_HEAT_COLS}
FROM first_rows WHERE order_hour IS NOT NULL AND order_weekday IS NOT NULL
GROUP BY order_hour ORDER BY order_hour""")
def agg8_hour_weekday_heatmap(spark, sf_dir):
    return A.hour_weekday_heatmap(event_lines(spark, sf_dir))


@query("agg8_hour_weekday_heatmap_star", oracle=f"""
WITH {_lines_cte(product=False, store=False)}, {_FIRST_ROWS}
SELECT order_hour, {_HEAT_COLS}
FROM first_rows WHERE order_hour IS NOT NULL AND order_weekday IS NOT NULL
GROUP BY order_hour ORDER BY order_hour""")
def agg8_hour_weekday_heatmap_star(spark, sf_dir):
    return A.hour_weekday_heatmap(star_lines(spark, sf_dir, product=False, store=False))


# --------------------------------------------------------------------- AGG9
def _summary_sql(lines_cte: str, where: str = "TRUE") -> str:
    return f"""
WITH {lines_cte}, flt AS (SELECT * FROM lines WHERE {where}),
first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
               ORDER BY ingest_seq, line_seq, item_id) AS rn FROM flt) WHERE rn = 1)
SELECT (SELECT count(DISTINCT order_number) FROM flt) AS total_orders,
       CAST(coalesce((SELECT sum(order_net_sales) FROM first_rows), 0) AS BIGINT) AS total_sales,
       CAST(coalesce((SELECT sum(total_price) FROM first_rows), 0) AS BIGINT) AS gross_sales,
       CAST(coalesce((SELECT sum(quantity) FROM flt), 0) AS BIGINT) AS total_items,
       coalesce((SELECT avg(order_net_sales) FROM first_rows), 0.0) AS avg_order_value,
       (SELECT min(order_date) FROM flt) AS period_start,
       (SELECT max(order_date) FROM flt) AS period_end"""


@query("agg9_summary_stats", oracle=_summary_sql(_lines_cte(product=False, store=False)))
def agg9_summary_stats(spark, sf_dir):
    return A.summary_stats(star_lines(spark, sf_dir, product=False, store=False))


# -------------------------------------------------------------------- AGG10
@query("agg10_period_kpi", oracle=f"""
WITH {_lines_cte(product=False, store=False)},
p AS (SELECT * FROM lines WHERE order_date BETWEEN {_d(MTD.start)} AND {_d(MTD.end)}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM p) WHERE rn = 1)
SELECT CAST(coalesce((SELECT sum(order_net_sales) FROM f), 0) AS BIGINT) AS sales,
       (SELECT count(*) FROM f) AS orders,
       CAST(coalesce((SELECT sum(quantity) FROM p), 0) AS BIGINT) AS items""")
def agg10_period_kpi(spark, sf_dir):
    return A.period_kpi(star_lines(spark, sf_dir, product=False, store=False), MTD.start, MTD.end)


# -------------------------------------------------------------------- AGG11
@query("agg11_source_kpi", oracle=f"""
WITH {_lines_cte(product=False)},
p AS (SELECT * FROM lines WHERE order_date BETWEEN {_d(MTD.start)} AND {_d(MTD.end)}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM p) WHERE rn = 1)
SELECT source, CAST(sum(order_net_sales) AS BIGINT) AS sales, count(*) AS orders
FROM f GROUP BY source""")
def agg11_source_kpi(spark, sf_dir):
    return A.source_kpi(star_lines(spark, sf_dir, product=False), MTD.start, MTD.end)


# -------------------------------------------------------------------- AGG12
@query("agg12_daily_store_sales", oracle=f"""
WITH {_lines_cte(product=False)},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_date, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines WHERE order_date IS NOT NULL) WHERE rn = 1)
SELECT source, order_date AS date, CAST(sum(order_net_sales) AS BIGINT) AS total_sales
FROM f GROUP BY source, order_date""")
def agg12_daily_store_sales(spark, sf_dir):
    return A.daily_store_sales(star_lines(spark, sf_dir, product=False))


# -------------------------------------------------------------------- AGG13
_STORE_COLS = ",\n       ".join(
    f"CAST(coalesce(sum(total_sales) FILTER (WHERE source = '{s}'), 0) AS BIGINT) AS \"{s} 売上\""
    for s in STAR_STORES)
_STORE_TOTAL = " + ".join(
    f"coalesce(sum(total_sales) FILTER (WHERE source = '{s}'), 0)" for s in STAR_STORES)


@query("agg13_day_store_pivot", oracle=f"""
WITH {_lines_cte(product=False)},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_date, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines
      WHERE order_date IS NOT NULL AND source IN ({", ".join(f"'{s}'" for s in STAR_STORES)})) WHERE rn = 1),
per AS (SELECT source, order_date, sum(order_net_sales) AS total_sales FROM f GROUP BY 1, 2),
dates AS (SELECT DISTINCT order_date FROM lines WHERE order_date IS NOT NULL)
SELECT d.order_date AS date, {_STORE_COLS},
       CAST({_STORE_TOTAL} AS BIGINT) AS "合計 売上"
FROM dates d LEFT JOIN per p ON d.order_date = p.order_date
GROUP BY d.order_date ORDER BY 1""")
def agg13_day_store_pivot(spark, sf_dir):
    return A.day_store_pivot(star_lines(spark, sf_dir, product=False), STAR_STORES)


# -------------------------------------------------------------------- AGG14
@query("agg14_total_and_store_stats", oracle=f"""
WITH {_lines_cte(product=False)},
tf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1),
sf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1),
t_o AS (SELECT count(DISTINCT order_number) AS total_orders, sum(order_net_sales) AS total_sales,
        sum(total_price) AS gross_sales, avg(order_net_sales) AS avg_order_value FROM tf),
t_i AS (SELECT sum(quantity) AS total_items, min(order_date) AS period_start,
        max(order_date) AS period_end FROM lines),
s_o AS (SELECT source, count(DISTINCT order_number) AS total_orders, sum(order_net_sales) AS total_sales,
        sum(total_price) AS gross_sales, avg(order_net_sales) AS avg_order_value FROM sf GROUP BY 1),
s_i AS (SELECT source, sum(quantity) AS total_items, min(order_date) AS period_start,
        max(order_date) AS period_end FROM lines GROUP BY 1)
SELECT 'total' AS scope, CAST(NULL AS VARCHAR) AS source, total_orders,
       CAST(total_sales AS BIGINT) AS total_sales, CAST(gross_sales AS BIGINT) AS gross_sales,
       CAST(total_items AS BIGINT) AS total_items, avg_order_value, period_start, period_end
FROM t_o, t_i
UNION ALL
SELECT 'store', s_o.source, total_orders, CAST(total_sales AS BIGINT), CAST(gross_sales AS BIGINT),
       CAST(total_items AS BIGINT), avg_order_value, period_start, period_end
FROM s_o JOIN s_i ON s_o.source IS NOT DISTINCT FROM s_i.source""")
def agg14_total_and_store_stats(spark, sf_dir):
    return A.total_and_store_stats(star_lines(spark, sf_dir, product=False))


# -------------------------------------------------------------------- AGG15
@query("agg15_daily_average", oracle=f"""
WITH {_lines_cte(product=False)},
p AS (SELECT * FROM lines WHERE order_date BETWEEN {_d(MTD.start)} AND {_d(MTD.end)}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM p) WHERE rn = 1)
SELECT source, CAST(sum(order_net_sales) AS BIGINT) AS sales,
       sum(order_net_sales) / {MTD.days}.0 AS daily_average
FROM f GROUP BY source""")
def agg15_daily_average(spark, sf_dir):
    k = A.source_kpi(star_lines(spark, sf_dir, product=False), MTD.start, MTD.end)
    return k.select("source", "sales", A.daily_average(F.col("sales"), MTD.start, MTD.end).alias("daily_average"))


# -------------------------------------------------------------------- AGG16
@query("agg16_import_summary", oracle=f"""
WITH {_lines_cte(product=False, store=False)}
SELECT count(*) AS count, min(order_date) AS start, max(order_date) AS "end" FROM lines""")
def agg16_import_summary(spark, sf_dir):
    return A.import_summary(star_lines(spark, sf_dir, product=False, store=False))


# -------------------------------------------------------------------- AGG17
@query("agg17_distinct_dates", oracle=f"""
WITH {_lines_cte(product=False, store=False)}
SELECT DISTINCT order_date FROM lines ORDER BY 1""")
def agg17_distinct_dates(spark, sf_dir):
    return A.distinct_values(star_lines(spark, sf_dir, product=False, store=False), "order_date")


@query("agg17_distinct_sources", oracle=f"""
WITH {_lines_cte(product=False)}
SELECT DISTINCT source FROM lines ORDER BY 1""")
def agg17_distinct_sources(spark, sf_dir):
    return A.distinct_values(star_lines(spark, sf_dir, product=False), "source")


# -------------------------------------------------------------------- AGG18
@query("agg18_top_product_share", oracle=f"""
WITH {_lines_cte()}, {_PRODUCT_SQL},
top AS (SELECT * FROM firsts ORDER BY total_sales DESC, gk LIMIT 10),
m AS (SELECT substr(item_name, 1, 30) || '...' AS short_name, CAST(sum(total_sales) AS BIGINT) AS total_sales
      FROM top GROUP BY 1)
SELECT short_name, total_sales, total_sales / sum(total_sales) OVER () AS share FROM m""")
def agg18_top_product_share(spark, sf_dir):
    return A.top_product_share(star_lines(spark, sf_dir, store=False), 10)


# ------------------------------------------------------------------ LIM1-4
def _top_sql(n: int) -> str:
    return f"""
WITH {_lines_cte()}, {_PRODUCT_SQL}
SELECT item_name, quantity, total_sales, order_count, item_number, item_id
FROM firsts ORDER BY total_sales DESC, gk LIMIT {n}"""


@query("lim1_top5_products", oracle=_top_sql(5))
def lim1_top5_products(spark, sf_dir):
    return A.top_products(star_lines(spark, sf_dir, store=False), 5)


@query("lim2_top50_products", oracle=_top_sql(50))
def lim2_top50_products(spark, sf_dir):
    return A.top_products(star_lines(spark, sf_dir, store=False), 50)


@query("lim3_top10_per_store", oracle=f"""
WITH {_lines_cte()},
g AS (SELECT *, coalesce(nullif(item_number, ''), item_id) AS gk FROM lines),
p AS (
  SELECT source, gk,
         arg_min(item_name, (ingest_seq, line_seq, item_id)) FILTER (WHERE item_name IS NOT NULL) AS item_name,
         arg_min(item_number, (ingest_seq, line_seq, item_id)) FILTER (WHERE item_number IS NOT NULL) AS item_number,
         arg_min(item_id, (ingest_seq, line_seq, item_id)) FILTER (WHERE item_id IS NOT NULL) AS item_id,
         CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(subtotal) AS BIGINT) AS total_sales,
         count(DISTINCT order_number) AS order_count
  FROM g WHERE gk IS NOT NULL GROUP BY source, gk),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY total_sales DESC, gk) AS rank FROM p)
SELECT source, CAST(rank AS INTEGER) AS rank, item_name, quantity, total_sales, order_count, item_number, item_id
FROM r WHERE rank <= 10""")
def lim3_top10_per_store(spark, sf_dir):
    return A.top_products_per_store(star_lines(spark, sf_dir), 10)


_LINE_COLS = ("order_number, order_datetime, order_date, order_hour, order_month, order_weekday, item_id, "
              "item_name, item_number, unit_price, quantity, subtotal, point_used, coupon_used, "
              "shipping_charge, total_price, order_net_sales, payment_method, status, source, mall, "
              "line_seq, ingest_seq")


@query("lim4_preview_rows", oracle=f"""
WITH {_lines_cte()}
SELECT {_LINE_COLS} FROM lines
ORDER BY ingest_seq, line_seq, item_id, quantity, unit_price, shipping_charge LIMIT 5""")
def lim4_preview_rows(spark, sf_dir):
    return FL.preview(star_lines(spark, sf_dir), 5)


# ------------------------------------------------------------------ WIN1-3
@query("win1_keep_first_line", oracle=f"""
WITH {_lines_cte()}
SELECT {_LINE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY order_number
       ORDER BY ingest_seq, line_seq, item_id, quantity, unit_price, shipping_charge) AS rn FROM lines) WHERE rn = 1""")
def win1_keep_first_line(spark, sf_dir):
    lines = star_lines(spark, sf_dir)
    return G.keep_first(lines, ("order_number",))


@query("win2_keep_last_per_item", oracle=f"""
WITH {_lines_cte()}
SELECT {_LINE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY order_number, item_name
       ORDER BY ingest_seq DESC, line_seq DESC, item_id DESC, quantity DESC, unit_price DESC,
                shipping_charge DESC) AS rn FROM lines) WHERE rn = 1""")
def win2_keep_last_per_item(spark, sf_dir):
    lines = star_lines(spark, sf_dir)
    return G.keep_last(lines, ("order_number", "item_name"),
                       ("ingest_seq", "line_seq", "item_id", "quantity", "unit_price", "shipping_charge"))


# ------------------------------------------------------------------ FLT*
@query("flt1_drop_cancelled", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS order_number,
       CASE WHEN o_orderstatus = 'P' THEN 900 ELSE 100 END AS status,
       CAST(ROUND(o_totalprice * 100) AS BIGINT) AS total_price
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P'""")
def flt1_drop_cancelled(spark, sf_dir):
    o = star_orders(spark, sf_dir, store=False, drop_cancelled=False)
    return FL.drop_cancelled(o).select("order_number", "status", "total_price")


@query("flt2_time_range", oracle=f"""
WITH {_lines_cte()}
SELECT {_LINE_COLS} FROM lines
WHERE order_datetime >= TIMESTAMP '{MTD.start} 00:00:00' AND order_datetime < TIMESTAMP '{STAR_AS_OF} 00:00:00'""")
def flt2_time_range(spark, sf_dir):
    import datetime as dt
    return FL.time_range(star_lines(spark, sf_dir), dt.datetime.combine(MTD.start, dt.time()),
                         dt.datetime.combine(STAR_AS_OF, dt.time()))


@query("flt3_status_in", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS order_number,
       CASE WHEN o_orderstatus = 'P' THEN 900 ELSE 100 END AS status
FROM orders WHERE (CASE WHEN o_orderstatus = 'P' THEN 900 ELSE 100 END) IN (900)""")
def flt3_status_in(spark, sf_dir):
    o = star_orders(spark, sf_dir, store=False, drop_cancelled=False)
    return FL.status_in(o, [900]).select("order_number", "status")


@query("flt7_date_between", oracle=f"""
WITH {_lines_cte()}
SELECT {_LINE_COLS} FROM lines WHERE order_date BETWEEN {_d(MTD.start)} AND {_d(MTD.end)}""")
def flt7_date_between(spark, sf_dir):
    return A.period_filter(star_lines(spark, sf_dir), MTD.start, MTD.end)


@query("flt8_date_and_source", oracle=f"""
WITH {_lines_cte()}
SELECT {_LINE_COLS} FROM lines
WHERE order_date BETWEEN DATE '1998-01-01' AND {_d(MTD.end)} AND source = '{STAR_STORES[0]}'""")
def flt8_date_and_source(spark, sf_dir):
    import datetime as dt
    return FL.date_and_source(star_lines(spark, sf_dir), dt.date(1998, 1, 1), MTD.end, STAR_STORES[0])


@query("flt9_source_eq", oracle=f"""
WITH {_lines_cte()}
SELECT {_LINE_COLS} FROM lines WHERE source = '{STAR_STORES[1]}'""")
def flt9_source_eq(spark, sf_dir):
    return FL.source_eq(star_lines(spark, sf_dir), STAR_STORES[1])


@query("flt11_skip_empty_ids", oracle=f"""
WITH {_lines_cte('events')}
SELECT DISTINCT item_id FROM lines WHERE nullif(item_id, '') IS NOT NULL""")
def flt11_skip_empty_ids(spark, sf_dir):
    return FL.skip_empty_ids(event_lines(spark, sf_dir), "item_id").select("item_id").distinct()


# ------------------------------------------------------------------ events
@query("agg2_daily_sales_events", oracle=f"""
WITH {_lines_cte('events')}, {_FIRST_ROWS},
d AS (SELECT order_date AS date, count(order_number) AS order_count,
             CAST(sum(order_net_sales) AS BIGINT) AS total_sales,
             CAST(sum(total_price) AS BIGINT) AS gross_sales,
             CAST(sum(coupon_used) AS BIGINT) AS coupon_total
      FROM first_rows WHERE order_date IS NOT NULL GROUP BY 1),
i AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS item_count
      FROM lines WHERE order_date IS NOT NULL GROUP BY 1)
SELECT d.date, d.order_count, d.total_sales, d.gross_sales, d.coupon_total, i.item_count
FROM d LEFT JOIN i ON d.date = i.date ORDER BY d.date""")
def agg2_daily_sales_events(spark, sf_dir):
    return A.daily_sales(event_lines(spark, sf_dir))


@query("agg10_period_kpi_events", oracle=f"""
WITH {_lines_cte('events')},
p AS (SELECT * FROM lines WHERE order_date BETWEEN {_d(EV_MTD.start)} AND {_d(EV_MTD.end)}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM p) WHERE rn = 1),
o AS (SELECT source, sum(order_net_sales) AS sales, count(*) AS orders FROM f GROUP BY 1),
i AS (SELECT source, sum(quantity) AS items FROM p GROUP BY 1)
SELECT coalesce(o.source, i.source) AS source, CAST(coalesce(sales, 0) AS BIGINT) AS sales,
       CAST(coalesce(orders, 0) AS BIGINT) AS orders, CAST(coalesce(items, 0) AS BIGINT) AS items
FROM o FULL JOIN i ON o.source = i.source""")
def agg10_period_kpi_events(spark, sf_dir):
    return A.period_kpi(event_lines(spark, sf_dir), EV_MTD.start, EV_MTD.end, group=("source",))


from .catalog import ORACLE  # noqa: E402

ORACLE_DAILY_EVENTS = ORACLE["agg2_daily_sales_events"].replace("ORDER BY d.date", "")

# ------------------------------------------------------------------ JON5
_STORES_PLUS = STAR_STORES + ["NO_SUCH_STORE"]


@query("jon5_store_dimension_kpi", oracle=f"""
WITH {_lines_cte(product=False)},
p AS (SELECT * FROM lines WHERE order_date BETWEEN {_d(MTD.start)} AND {_d(MTD.end)}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM p) WHERE rn = 1),
k AS (SELECT source, sum(order_net_sales) AS sales, count(*) AS orders FROM f GROUP BY source),
dim AS (SELECT * FROM (VALUES {", ".join(f"('{s}')" for s in _STORES_PLUS)}) AS t(name))
SELECT dim.name AS source, CAST(coalesce(k.sales, 0) AS BIGINT) AS sales,
       CAST(coalesce(k.orders, 0) AS BIGINT) AS orders
FROM dim LEFT JOIN k ON dim.name = k.source""")
def jon5_store_dimension_kpi(spark, sf_dir):
    """JON5: every configured store appears (0 when it has no rows)."""
    return A.source_kpi(star_lines(spark, sf_dir, product=False), MTD.start, MTD.end, stores=_STORES_PLUS)


# ------------------------------------------------------------------ FN7 / FN12-FN14
@query("fn13_daily_display_table", oracle=f"""
WITH d AS ({ORACLE_DAILY_EVENTS}),
c AS (SELECT *, lag(total_sales) OVER (ORDER BY date) AS prev FROM d)
SELECT strftime(date, '%m/%d') AS "日付", order_count AS "注文数",
       '¥' || format('{{:,}}', total_sales) AS "売上",
       CASE WHEN total_sales >= 1000000 THEN '¥' || format('{{:.1f}}', round(total_sales / 1000000.0, 1)) || 'M'
            WHEN total_sales >= 1000 THEN '¥' || format('{{:,.0f}}', round(total_sales / 1000.0, 0)) || 'K'
            ELSE '¥' || format('{{:,}}', total_sales) END AS "売上_略",
       CASE WHEN coalesce(prev, 0) = 0 THEN NULL
            ELSE (total_sales - prev) * 100.0 / prev END AS change_pct
FROM c""")
def fn13_daily_display_table(spark, sf_dir):
    """FN7, FN10, FN12, FN13: the daily table as displayed (MM/dd, ¥ text, compact ¥, day-over-day %).

    The day-over-day change uses ``lag`` over the (small) daily result.
    """
    from pyspark.sql import Window
    from ..functions.money import compact_yen, yen
    from ..functions.time import format_date
    d = A.daily_sales(event_lines(spark, sf_dir))
    prev = F.lag("total_sales").over(Window.orderBy("date"))
    return d.select(
        format_date("date", "short").alias("日付"), F.col("order_count").alias("注文数"),
        yen("total_sales").alias("売上"), compact_yen("total_sales").alias("売上_略"),
        F.when(F.coalesce(prev, F.lit(0)) == 0, F.lit(None).cast("double"))
         .otherwise((F.col("total_sales") - prev) * 100.0 / prev).alias("change_pct"))


# ------------------------------------------------------------------ event-table variants
@query("agg4_product_sales_events", oracle=f"""
WITH {_lines_cte('events')}, {_PRODUCT_SQL}
SELECT item_name, quantity, total_sales, order_count, item_number, item_id
FROM firsts ORDER BY total_sales DESC, gk""")
def agg4_product_sales_events(spark, sf_dir):
    """AGG4 over sub-day event orders (product key = item id, names change per event type)."""
    return A.product_sales_sorted(event_lines(spark, sf_dir))


@query("agg12_daily_store_sales_events", oracle=f"""
WITH {_lines_cte('events')},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_date, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines WHERE order_date IS NOT NULL) WHERE rn = 1)
SELECT source, order_date AS date, CAST(sum(order_net_sales) AS BIGINT) AS total_sales
FROM f GROUP BY source, order_date""")
def agg12_daily_store_sales_events(spark, sf_dir):
    return A.daily_store_sales(event_lines(spark, sf_dir))


@query("agg14_total_and_store_stats_events", oracle=f"""
WITH {_lines_cte('events')},
tf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1),
sf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1),
t_o AS (SELECT count(DISTINCT order_number) AS total_orders, sum(order_net_sales) AS total_sales,
        sum(total_price) AS gross_sales, avg(order_net_sales) AS avg_order_value FROM tf),
t_i AS (SELECT sum(quantity) AS total_items, min(order_date) AS period_start,
        max(order_date) AS period_end FROM lines),
s_o AS (SELECT source, count(DISTINCT order_number) AS total_orders, sum(order_net_sales) AS total_sales,
        sum(total_price) AS gross_sales, avg(order_net_sales) AS avg_order_value FROM sf GROUP BY 1),
s_i AS (SELECT source, sum(quantity) AS total_items, min(order_date) AS period_start,
        max(order_date) AS period_end FROM lines GROUP BY 1)
SELECT 'total' AS scope, CAST(NULL AS VARCHAR) AS source, total_orders,
       CAST(total_sales AS BIGINT) AS total_sales, CAST(gross_sales AS BIGINT) AS gross_sales,
       CAST(total_items AS BIGINT) AS total_items, avg_order_value, period_start, period_end
FROM t_o, t_i
UNION ALL
SELECT 'store', s_o.source, total_orders, CAST(total_sales AS BIGINT), CAST(gross_sales AS BIGINT),
       CAST(total_items AS BIGINT), avg_order_value, period_start, period_end
FROM s_o JOIN s_i ON s_o.source IS NOT DISTINCT FROM s_i.source""")
def agg14_total_and_store_stats_events(spark, sf_dir):
    return A.total_and_store_stats(event_lines(spark, sf_dir))


# ------------------------------------------------------------------ AGG11 single store / D1 store key
@query("agg11_source_kpi_single", oracle=f"""
WITH {_lines_cte(product=False)},
p AS (SELECT * FROM lines WHERE order_date BETWEEN {_d(MTD.start)} AND {_d(MTD.end)}
      AND source = '{STAR_STORES[0]}'),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM p) WHERE rn = 1)
SELECT CAST(coalesce((SELECT sum(order_net_sales) FROM f), 0) AS BIGINT) AS sales,
       (SELECT count(*) FROM f) AS orders""")
def agg11_source_kpi_single(spark, sf_dir):
    """AGG11: sales and orders of one store for [start, end] (dedup inside the store)."""
    lines = FL.source_eq(star_lines(spark, sf_dir, product=False), STAR_STORES[0])
    return A.period_kpi(lines, MTD.start, MTD.end).select("sales", "orders")


@query("agg2_daily_sales_store_key", oracle=f"""
WITH {_lines_cte(product=False)},
first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
               ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1),
d AS (SELECT order_date AS date, count(DISTINCT order_number) AS order_count,
             CAST(sum(order_net_sales) AS BIGINT) AS total_sales,
             CAST(sum(total_price) AS BIGINT) AS gross_sales,
             CAST(sum(coupon_used) AS BIGINT) AS coupon_total
      FROM first_rows WHERE order_date IS NOT NULL GROUP BY 1),
i AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS item_count
      FROM lines WHERE order_date IS NOT NULL GROUP BY 1)
SELECT d.date, d.order_count, d.total_sales, d.gross_sales, d.coupon_total, i.item_count
FROM d LEFT JOIN i ON d.date = i.date""")
def agg2_daily_sales_store_key(spark, sf_dir):
    """AGG2 with the store-scoped dedup key (source, order_number) recommended by D1."""
    return A.daily_sales(star_lines(spark, sf_dir, product=False), key=G.STORE_KEY)
