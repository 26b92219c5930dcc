"""Registered source / flatten queries.

Each query lands documents derived by Spark from the driver tables (once per
session folder), reads them back through the reader under test and flattens
them; the oracle computes the same lines straight from the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregates as A
from ..operators.flatten import flatten_m, flatten_r, flatten_y, m_nodes_from_pages
from ..sources import documents as D
from ..sources import readers as R
from ..sources.adapters import star_lines_sql
from ..sources.landing import land
from .catalog import ORACLE, query
from .params import STAR_STORES

# ------------------------------------------------------------------ landing
_WIN_START, _WIN_END = dt.datetime(1998, 1, 1), dt.datetime(1999, 1, 1)


def landed_r_orders(spark, sf_dir) -> str:
    # compressed: field names and quotes are most of a document, and no file is larger than what one task gathers
    return land(spark, sf_dir, "r_orders", lambda: D.r_documents(spark, sf_dir).withColumn(
        "store", F.col("_store_name")),
        lambda df, p: df.write.mode("overwrite").partitionBy("store").json(p, compression="gzip"))


def landed_r_search(spark, sf_dir) -> str:
    return land(spark, sf_dir, "r_search_1998",
                lambda: D.r_search_pages(spark, sf_dir, _WIN_START, _WIN_END),
                lambda df, p: df.write.mode("overwrite").json(p))


def landed_y_xml(spark, sf_dir) -> str:
    # compressed, as the order documents are: tags are most of a response
    return land(spark, sf_dir, "y_xml", lambda: D.y_xml_documents(spark, sf_dir).unionByName(
        D.y_error_documents(spark, sf_dir)), lambda df, p: df.write.mode("overwrite").json(p, compression="gzip"))


def landed_m_pages(spark, sf_dir) -> str:
    return land(spark, sf_dir, "m_pages", lambda: D.m_pages(spark, sf_dir),
                lambda df, p: df.write.mode("overwrite").json(p, compression="gzip"))


def r_lines(spark, sf_dir):
    return flatten_r(R.read_order_json(spark, landed_r_orders(spark, sf_dir)))


def y_lines(spark, sf_dir):
    return flatten_y(R.read_text_documents(spark, landed_y_xml(spark, sf_dir)))


def m_lines(spark, sf_dir, start=_WIN_START, end=dt.datetime(1998, 12, 31, 23, 59, 59)):
    nodes, _ = m_nodes_from_pages(R.read_graphql_pages(spark, landed_m_pages(spark, sf_dir)))
    return flatten_m(nodes, start, end)


# ------------------------------------------------------------ oracle pieces
_CMP_COLS = ["order_number", "order_datetime", "order_date", "order_hour", "order_month",
             "order_weekday", "item_id", "item_name", "item_number", "unit_price", "quantity",
             "subtotal", "point_used", "coupon_used", "shipping_charge", "total_price",
             "order_net_sales", "payment_method", "status", "source", "ingest_seq"]

_Y_LINES_SQL = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_number, o.o_orderdate AS order_datetime,
       CAST(o.o_orderdate AS DATE) AS order_date, CAST(hour(o.o_orderdate) AS INTEGER) AS order_hour,
       strftime(o.o_orderdate, '%Y-%m') AS order_month, CAST(isodow(o.o_orderdate) - 1 AS INTEGER) AS order_weekday,
       CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE CAST(l.l_partkey AS VARCHAR) END AS item_id,
       CASE WHEN l.l_orderkey IS NULL THEN '' ELSE p.p_name END AS item_name,
       '' AS item_number,
       CASE WHEN l.l_orderkey IS NULL THEN CAST(ROUND(o.o_totalprice * 100) AS BIGINT)
            ELSE CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) // CAST(l.l_quantity AS BIGINT) END AS unit_price,
       CASE WHEN l.l_orderkey IS NULL THEN 1 ELSE CAST(l.l_quantity AS BIGINT) END AS quantity,
       CASE WHEN l.l_orderkey IS NULL THEN CAST(ROUND(o.o_totalprice * 100) AS BIGINT)
            WHEN l.l_returnflag = 'R' THEN 0
            ELSE (CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) // CAST(l.l_quantity AS BIGINT))
                 * CAST(l.l_quantity AS BIGINT) END AS subtotal,
       (o.o_custkey % 4) * 100 AS point_used,
       (CAST(ROUND(o.o_totalprice * 100) AS BIGINT) * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)) // 100
           AS coupon_used,
       CAST(0 AS BIGINT) AS shipping_charge,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS total_price,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) - (o.o_custkey % 4) * 100
         - (CAST(ROUND(o.o_totalprice * 100) AS BIGINT) * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)) // 100
           AS order_net_sales,
       '' AS payment_method, CAST(NULL AS INTEGER) AS status, 'Yahoo' AS source, 'Y' AS mall,
       o.o_orderkey AS ingest_seq
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey"""

_M_TS = """CASE WHEN o.o_orderkey % 7 = 0 THEN (CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderdate END)
            WHEN o.o_orderkey % 13 = 0 THEN NULL WHEN o.o_orderkey % 11 = 0 THEN NULL
            ELSE o.o_orderdate END"""

_M_LINES_SQL = f"""
SELECT * FROM (
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_number, {_M_TS} AS order_datetime,
       CAST({_M_TS} AS DATE) AS order_date, CAST(hour({_M_TS}) AS INTEGER) AS order_hour,
       strftime({_M_TS}, '%Y-%m') AS order_month, CAST(isodow({_M_TS}) - 1 AS INTEGER) AS order_weekday,
       CAST(o.o_custkey % 97 AS VARCHAR) AS item_id, c.c_name AS item_name, '' AS item_number,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS unit_price, CAST(1 AS BIGINT) AS quantity,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS subtotal,
       CAST(0 AS BIGINT) AS point_used, CAST(0 AS BIGINT) AS coupon_used, CAST(0 AS BIGINT) AS shipping_charge,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS total_price,
       CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS order_net_sales,
       '' AS payment_method, CAST(NULL AS INTEGER) AS status, 'M' AS source, 'M' AS mall
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)
WHERE order_datetime IS NULL
   OR order_datetime BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-12-31 23:59:59'"""
_M_ALL_LINES_SQL = _M_LINES_SQL[:_M_LINES_SQL.index("WHERE order_datetime IS NULL")]


def _cols(cols):
    return ", ".join(cols)


# ------------------------------------------------------------------ SRC1/PRJ1
@query("src1_read_order_json", oracle=f"""
WITH lines AS ({star_lines_sql()})
SELECT {_cols(_CMP_COLS)} FROM lines""")
def src1_read_order_json(spark, sf_dir):
    """SRC1 + PRJ1-PRJ5 + FLT1: landed nested JSON -> order lines."""
    return r_lines(spark, sf_dir).select(*_CMP_COLS)


@query("prj1_daily_from_order_json", oracle=ORACLE["agg2_daily_sales"])
def prj1_daily_from_order_json(spark, sf_dir):
    return A.daily_sales(r_lines(spark, sf_dir))


@query("prj1_monthly_from_order_json", oracle=ORACLE["agg3_monthly_sales"])
def prj1_monthly_from_order_json(spark, sf_dir):
    return A.monthly_sales(r_lines(spark, sf_dir))


# ------------------------------------------------------------------ SRC3/4
@query("src3_search_ids", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS order_number FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00'""")
def src3_search_ids(spark, sf_dir):
    return R.read_search_pages(spark, landed_r_search(spark, sf_dir))


@query("jon4_details_for_search_ids", oracle=f"""
WITH lines AS ({star_lines_sql()})
SELECT {_cols(_CMP_COLS)} FROM lines
WHERE order_datetime >= TIMESTAMP '1998-01-01 00:00:00' AND order_datetime < TIMESTAMP '1999-01-01 00:00:00'""")
def jon4_details_for_search_ids(spark, sf_dir):
    """SRC2-SRC4: id search pages ⋉ detail documents -> flatten."""
    ids = R.read_search_pages(spark, landed_r_search(spark, sf_dir))
    details = R.read_order_json(spark, landed_r_orders(spark, sf_dir))
    return flatten_r(R.details_for_ids(details, ids)).select(*_CMP_COLS)


# ------------------------------------------------------------------ SRC5
_STORE_IN = ", ".join(f"'{s}'" for s in STAR_STORES)


@query("src5_multi_store_stats", oracle=f"""
WITH lines AS ({star_lines_sql()}),
fl AS (SELECT * FROM lines WHERE source IN ({_STORE_IN})),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM fl) WHERE rn = 1),
o AS (SELECT source, count(DISTINCT order_number) AS total_orders, sum(order_net_sales) AS total_sales,
      sum(total_price) AS gross_sales, avg(order_net_sales) AS avg_order_value FROM f GROUP BY 1),
i AS (SELECT source, sum(quantity) AS total_items, min(order_date) AS period_start,
      max(order_date) AS period_end FROM fl GROUP BY 1)
SELECT o.source, total_orders, CAST(total_sales AS BIGINT) AS total_sales,
       CAST(gross_sales AS BIGINT) AS gross_sales, CAST(total_items AS BIGINT) AS total_items,
       avg_order_value, period_start, period_end
FROM o JOIN i ON o.source = i.source""")
def src5_multi_store_stats(spark, sf_dir):
    """SRC5 + SET1: configured stores read in store order (partition pruning), stats per store."""
    docs = R.read_store_orders(spark, landed_r_orders(spark, sf_dir), STAR_STORES)
    return A.summary_stats(flatten_r(docs), group=("source",))


# ------------------------------------------------------------------ SRC6-10/PRJ6-9
@query("prj6_flatten_xml_orders", oracle=f"""
SELECT {_cols(c for c in _CMP_COLS)} FROM ({_Y_LINES_SQL})""")
def prj6_flatten_xml_orders(spark, sf_dir):
    """SRC7-SRC10 + PRJ6-PRJ9: XML responses (3 wrappers, namespaces) -> order lines."""
    lines, _ = y_lines(spark, sf_dir)
    return lines.select(*_CMP_COLS)


@query("src9_xml_quarantine", oracle="""
SELECT 'error_response' AS reason, count(*) AS documents FROM nation""")
def src9_xml_quarantine(spark, sf_dir):
    """SRC9/D14: whole responses set aside, counted by reason."""
    _, q = y_lines(spark, sf_dir)
    return q.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


@query("prj6_daily_from_xml", oracle=f"""
WITH lines AS ({_Y_LINES_SQL}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number ORDER BY ingest_seq) AS rn
      FROM lines) WHERE rn = 1),
d AS (SELECT order_date AS date, count(order_number) AS order_count,
      CAST(sum(order_net_sales) AS BIGINT) AS total_sales, CAST(sum(total_price) AS BIGINT) AS gross_sales,
      CAST(sum(coupon_used) AS BIGINT) AS coupon_total FROM f GROUP BY 1),
i AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS item_count FROM lines GROUP BY 1)
SELECT d.date, order_count, total_sales, gross_sales, coupon_total, item_count
FROM d LEFT JOIN i ON d.date = i.date""")
def prj6_daily_from_xml(spark, sf_dir):
    lines, _ = y_lines(spark, sf_dir)
    return A.daily_sales(lines)


# ------------------------------------------------------------------ SRC11-12/PRJ19
_M_CMP = [c for c in _CMP_COLS if c != "ingest_seq"]


@query("prj19_graphql_orders", oracle=f"""
SELECT {_cols(_M_CMP)} FROM ({_M_LINES_SQL})""")
def prj19_graphql_orders(spark, sf_dir):
    """SRC11-SRC12 + FLT6 + FLT11 + SET4 + WIN3 + PRJ19: GraphQL pages -> one line per order."""
    return m_lines(spark, sf_dir).select(*_M_CMP)


@query("src11_failed_pages", oracle="""
SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS set_seq,
       'Throttled' AS message
FROM orders GROUP BY 1""")
def src11_failed_pages(spark, sf_dir):
    _, failed = m_nodes_from_pages(R.read_graphql_pages(spark, landed_m_pages(spark, sf_dir)))
    return failed.select("set_seq", "message")


# ------------------------------------------------------------------ SET3
@query("set3_union_marketplaces", oracle=f"""
WITH r AS ({star_lines_sql()}), y AS ({_Y_LINES_SQL}), m AS ({_M_ALL_LINES_SQL}),
u AS (SELECT 'R' AS mall, quantity, subtotal FROM r
      UNION ALL SELECT mall, quantity, subtotal FROM y
      UNION ALL SELECT mall, quantity, subtotal FROM m)
SELECT mall, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(subtotal) AS BIGINT) AS subtotal FROM u GROUP BY mall""")
def set3_union_marketplaces(spark, sf_dir):
    """SET3: lines of all marketplaces in one frame (missing columns -> NULL)."""
    y, _ = y_lines(spark, sf_dir)
    m = m_lines(spark, sf_dir, None, None).drop("payment_method")      # every order, undated ones too
    u = r_lines(spark, sf_dir).unionByName(y).unionByName(m, allowMissingColumns=True)
    return u.groupBy("mall").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"),
                                 F.sum("subtotal").alias("subtotal"))


# ------------------------------------------------------------------ CSV (SRC13-15, PRJ10-14, SNK6, WIN2)
# import id -> (layout, lines filter on the order key, quantity bumped in a re-export)
_IMPORTS = {"0": (0, 3, 0, False), "1": (1, 3, 1, False), "2": (2, 3, 2, False), "3": (1, 10, 0, True)}


_EXPORT_COLS = ["order_number", "order_datetime", "item_id", "item_name", "unit_price", "quantity", "point_used", "coupon_used",
                "shipping_charge", "total_price", "line_seq", "ingest_seq"]


def export_lines(spark, sf_dir) -> DataFrame:
    """Order lines with the columns of the CSV exports, cancelled orders too, joined once for all exports."""
    from ..sources.adapters import star_lines
    path = land(spark, sf_dir, "export_lines", lambda: star_lines(spark, sf_dir, drop_cancelled=False).select(*_EXPORT_COLS),
                lambda df, p: df.write.mode("overwrite").parquet(p))
    return spark.read.parquet(path)


def landed_csv_export(spark, sf_dir, import_id: str) -> str:
    layout, mod, rem, bump = _IMPORTS[import_id]
    enc = D.CSV_LAYOUTS[layout][0]

    def build():
        lines = export_lines(spark, sf_dir)
        return D.csv_export(lines.filter(F.col("ingest_seq") % mod == rem), layout, bump)

    from ..sources.csv_export import write_export
    return land(spark, sf_dir, f"csv_export_{import_id}", build, lambda df, p: write_export(df, p, enc, compression="gzip"))


def landed_import_dataset(spark, sf_dir) -> str:
    from ..sources import csv_export as C

    def build():
        parts = []
        for import_id, (layout, *_rest) in _IMPORTS.items():
            path = landed_csv_export(spark, sf_dir, import_id)
            parts.append(C.as_import(C.parse_order_csv(spark, path, D.CSV_LAYOUTS[layout][0]), import_id))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return land(spark, sf_dir, "csv_imports", build, lambda df, p: C.save_imports(df, p, mode="overwrite"))


_CSV_KEEP_LAST = f"""
WITH lines AS ({star_lines_sql(drop_cancelled=False)}),
imp AS (
  SELECT 0 AS imp, quantity AS q, * FROM lines WHERE ingest_seq % 3 = 0
  UNION ALL SELECT 1, quantity, * FROM lines WHERE ingest_seq % 3 = 1
  UNION ALL SELECT 2, quantity, * FROM lines WHERE ingest_seq % 3 = 2
  UNION ALL SELECT 3, quantity + 1, * FROM lines WHERE ingest_seq % 10 = 0),
c AS (
  SELECT imp, ingest_seq, line_seq, item_id, quantity AS oq, unit_price AS ou, shipping_charge,
         order_number, order_datetime AS order_date, item_name, q AS quantity, unit_price,
         unit_price * q AS subtotal, total_price,
         CASE WHEN imp = 2 THEN 0 ELSE point_used END AS use_point,
         CASE WHEN imp = 2 THEN 0 ELSE coupon_used END AS coupon_discount,
         total_price - CASE WHEN imp = 2 THEN 0 ELSE point_used + coupon_used END AS order_net_sales,
         'Yahoo' AS source
  FROM imp),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number, item_name
         ORDER BY imp DESC, ingest_seq DESC, line_seq DESC, item_id DESC, oq DESC, ou DESC,
                  shipping_charge DESC) AS rn FROM c) WHERE rn = 1)"""

_CSV_COLS = ("order_number, order_date, item_name, quantity, unit_price, subtotal, total_price, use_point, "
             "coupon_discount, order_net_sales, source")


@query("src14_load_saved_imports", oracle=f"""{_CSV_KEEP_LAST}
SELECT {_CSV_COLS} FROM last""")
def src14_load_saved_imports(spark, sf_dir):
    """SRC13-SRC14 + PRJ10-PRJ14 + SNK6 + WIN2: exports (3 header sets, cp932/UTF-8+BOM)
    -> import dataset -> last row per (order, item) across imports."""
    from ..sources import csv_export as C
    return C.load_saved_imports(spark, landed_import_dataset(spark, sf_dir))


@query("flt10_csv_date_range", oracle=f"""{_CSV_KEEP_LAST}
SELECT {_CSV_COLS} FROM last
WHERE order_date >= TIMESTAMP '1998-03-01 00:00:00' AND order_date <= TIMESTAMP '1998-06-30 00:00:00'""")
def flt10_csv_date_range(spark, sf_dir):
    from ..sources import csv_export as C
    return C.load_saved_imports(spark, landed_import_dataset(spark, sf_dir),
                                dt.datetime(1998, 3, 1), dt.datetime(1998, 6, 30))


@query("agg16_import_summary_csv", oracle=f"""{_CSV_KEEP_LAST}
SELECT count(*) AS count, min(order_date) AS start, max(order_date) AS "end" FROM last""")
def agg16_import_summary_csv(spark, sf_dir):
    from ..sources import csv_export as C
    return A.import_summary(C.load_saved_imports(spark, landed_import_dataset(spark, sf_dir)))


@query("src13_parse_exports", oracle=f"""
WITH lines AS ({star_lines_sql(drop_cancelled=False)}),
imp AS (
  SELECT 0 AS imp, quantity AS q, * FROM lines WHERE ingest_seq % 3 = 0
  UNION ALL SELECT 1, quantity, * FROM lines WHERE ingest_seq % 3 = 1
  UNION ALL SELECT 2, quantity, * FROM lines WHERE ingest_seq % 3 = 2
  UNION ALL SELECT 3, quantity + 1, * FROM lines WHERE ingest_seq % 10 = 0)
SELECT order_number, order_datetime AS order_date, item_name, q AS quantity, unit_price,
       unit_price * q AS subtotal, total_price,
       CASE WHEN imp = 2 THEN 0 ELSE point_used END AS use_point,
       CASE WHEN imp = 2 THEN 0 ELSE coupon_used END AS coupon_discount,
       total_price - CASE WHEN imp = 2 THEN 0 ELSE point_used + coupon_used END AS order_net_sales,
       'Yahoo' AS source, CAST(imp AS VARCHAR) AS import_id
FROM imp""")
def src13_parse_exports(spark, sf_dir):
    """SRC13 + PRJ10-PRJ14: every landed export (cp932 Japanese headers with '1,234' amounts,
    UTF-8+BOM English headers, UTF-8 headers without points/coupons), parsed and unioned."""
    from ..sources import csv_export as C
    parts = []
    for import_id, (layout, *_rest) in _IMPORTS.items():
        path = landed_csv_export(spark, sf_dir, import_id)
        parsed = C.parse_order_csv(spark, path, D.CSV_LAYOUTS[layout][0])
        parts.append(parsed.drop("_file", "_pos").withColumn("import_id", F.lit(import_id)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ STR1
def _closed_daily_sql():
    """Batch daily totals of R documents for the days a 1-day watermark has closed."""
    return f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}),
fr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1),
d AS (SELECT order_date AS date, count(order_number) AS order_count,
      CAST(sum(order_net_sales) AS BIGINT) AS total_sales, CAST(sum(total_price) AS BIGINT) AS gross_sales,
      CAST(sum(coupon_used) AS BIGINT) AS coupon_total FROM fr GROUP BY 1),
i AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS item_count FROM lines GROUP BY 1),
wm AS (SELECT max(order_datetime) - INTERVAL 1 DAY AS watermark FROM lines)
SELECT d.date, order_count, total_sales, gross_sales, coupon_total, item_count
FROM d JOIN i ON d.date = i.date, wm
WHERE CAST(d.date AS TIMESTAMP) + INTERVAL 1 DAY <= wm.watermark"""


@query("str1_incremental_daily", oracle=_closed_daily_sql())
def str1_incremental_daily(spark, sf_dir):
    """STR1: readStream over landed order documents -> watermark -> dedup -> daily windows."""
    from ..session import unique_dir
    from ..streaming import run_daily_totals
    source = landed_r_orders(spark, sf_dir)
    out = unique_dir(spark, "stream_daily")        # a fresh sink + checkpoint per run
    return run_daily_totals(spark, source, out + "/sink", out + "/checkpoint")


# ------------------------------------------------------------------ sinks round trips
@query("snk3_table_roundtrip", oracle=f"""
SELECT strftime(date, '%Y-%m-%d') AS date, order_count, total_sales, gross_sales, coupon_total, item_count
FROM ({ORACLE['agg2_daily_sales']})""")
def snk3_table_roundtrip(spark, sf_dir):
    """SNK3 + SRC16: daily sales written as a table (dates as text), read back."""
    from ..sinks import overwrite_table
    from ..sources.adapters import star_lines
    from ..sources.landing import landed_path
    target = landed_path(spark, sf_dir, "table_daily_sales")
    overwrite_table(A.daily_sales(star_lines(spark, sf_dir, product=False, store=False)), target)
    return spark.read.parquet(target)


@query("snk8_snapshot_roundtrip", oracle=f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}),
flt AS (SELECT * FROM lines WHERE order_date BETWEEN DATE '1998-06-01' AND DATE '1998-06-15'),
fr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM flt) WHERE rn = 1),
d AS (SELECT order_date AS date, count(order_number) AS order_count,
      CAST(sum(order_net_sales) AS BIGINT) AS total_sales, CAST(sum(total_price) AS BIGINT) AS gross_sales,
      CAST(sum(coupon_used) AS BIGINT) AS coupon_total FROM fr GROUP BY 1),
i AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS item_count FROM flt GROUP BY 1)
SELECT d.date, order_count, total_sales, gross_sales, coupon_total, item_count FROM d JOIN i ON d.date = i.date""")
def snk8_snapshot_roundtrip(spark, sf_dir):
    """SNK8 + SRC17: lines snapshot partitioned by order_date; a date-bounded read prunes partitions."""
    from ..sinks import write_snapshot
    from ..sources.adapters import star_lines
    from ..sources.landing import landed_path
    path = landed_path(spark, sf_dir, "snapshot_lines")
    write_snapshot(star_lines(spark, sf_dir, product=False, store=False), path)
    snap = R.read_snapshot(spark, path, dt.date(1998, 6, 1), dt.date(1998, 6, 15))
    return A.daily_sales(snap)


@query("snk1_csv_roundtrip", oracle=f"""
SELECT item_name, CAST(quantity AS VARCHAR) AS quantity, CAST(total_sales AS VARCHAR) AS total_sales,
       CAST(order_count AS VARCHAR) AS order_count, nullif(item_number, '') AS item_number, item_id
FROM ({ORACLE['agg4_product_sales']})""")
def snk1_csv_roundtrip(spark, sf_dir):
    """SNK1/SNK7: product sales as UTF-8+BOM CSV, read back as text columns.

    An empty text cell reads back as NULL, as a CSV round trip through pandas does.
    """
    from ..sinks import write_csv
    from ..sources.adapters import star_lines
    from ..sources.csv_export import read_raw_export
    from ..sources.landing import landed_path
    path = landed_path(spark, sf_dir, "csv_product_sales")
    write_csv(A.product_sales_sorted(star_lines(spark, sf_dir, store=False)), path)
    return read_raw_export(spark, path, "UTF-8")


# ------------------------------------------------------------------ SRC6 / SRC10 / FLT4 / FLT5
_Y_WIN = (dt.datetime(1998, 6, 1), dt.datetime(1998, 7, 1))


def landed_y_list(spark, sf_dir) -> str:
    return land(spark, sf_dir, "y_list_199806", lambda: D.y_list_pages(spark, sf_dir, *_Y_WIN),
                lambda df, p: df.write.mode("overwrite").json(p))


@query("src6_xml_order_list", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_time, o_orderstatus AS status
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-07-01 00:00:00'
ORDER BY order_time""")
def src6_xml_order_list(spark, sf_dir):
    """SRC6 + FLT4: list pages (two paths, scalar-or-list) -> ids sorted by order time."""
    from ..operators.filters import sorted_by_time
    from ..operators.flatten import y_list_ids
    ids = y_list_ids(spark.read.schema("page bigint, value string").json(landed_y_list(spark, sf_dir)))
    return sorted_by_time(ids, "order_time")


@query("src10_list_then_details", oracle=f"""
SELECT {_cols(_CMP_COLS)} FROM ({_Y_LINES_SQL})
WHERE order_datetime >= TIMESTAMP '1998-06-01 00:00:00' AND order_datetime < TIMESTAMP '1998-07-01 00:00:00'""")
def src10_list_then_details(spark, sf_dir):
    """SRC10: list -> ids -> detail responses (semi join) -> order lines."""
    from ..operators.flatten import y_list_ids
    ids = y_list_ids(spark.read.schema("page bigint, value string").json(landed_y_list(spark, sf_dir)))
    lines, _ = y_lines(spark, sf_dir)
    return lines.join(ids.select(F.col("order_id").alias("order_number")), "order_number", "left_semi") \
        .select(*_CMP_COLS)


@query("flt5_status_equals", oracle="""
SELECT 'SHIPPED' AS status, count(*) AS nodes FROM orders WHERE o_orderstatus = 'O'
   OR (o_orderstatus = 'F' AND o_orderkey % 5 = 0)""")
def flt5_status_equals(spark, sf_dir):
    """FLT5: nodes of one status across all pages (the SHIPPED set incl. stale copies)."""
    from ..operators.filters import status_in
    nodes, _ = m_nodes_from_pages(R.read_graphql_pages(spark, landed_m_pages(spark, sf_dir)))
    shipped = status_in(nodes.select(F.col("node.status").alias("status")), ["SHIPPED"])
    return shipped.groupBy("status").agg(F.count(F.lit(1)).alias("nodes"))


# ------------------------------------------------------------------ SRC18
@query("src18_prefer_imported_csv", oracle=f"""{_CSV_KEEP_LAST},
fr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number ORDER BY order_date) AS r
       FROM last) WHERE r = 1),
d AS (SELECT CAST(order_date AS DATE) AS date, count(*) AS order_count,
      CAST(sum(order_net_sales) AS BIGINT) AS total_sales, CAST(sum(total_price) AS BIGINT) AS gross_sales,
      CAST(sum(coupon_discount) AS BIGINT) AS coupon_total FROM fr GROUP BY 1),
i AS (SELECT CAST(order_date AS DATE) AS date, CAST(sum(quantity) AS BIGINT) AS item_count FROM last GROUP BY 1)
SELECT d.date, order_count, total_sales, gross_sales, coupon_total, item_count FROM d JOIN i ON d.date = i.date""")
def src18_prefer_imported_csv(spark, sf_dir):
    """SRC18: imported CSV rows when there are any, else the XML API lines; then daily sales."""
    from ..sources import csv_export as C
    root = landed_import_dataset(spark, sf_dir)
    csv_lines = C.imports_as_order_lines(C.load_saved_imports(spark, root, keep_order=True))
    api_lines, _ = y_lines(spark, sf_dir)
    return A.daily_sales(R.prefer_first_nonempty(csv_lines, api_lines, probe=spark.read.parquet(root)))


# ------------------------------------------------------------------ WIN3 / SET4
@query("win3_status_priority", oracle="""
SELECT 'm' || CAST(o_orderkey AS VARCHAR) AS id,
       CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'SHIPPED' ELSE 'WAITING_FOR_SHIPMENT' END AS status
FROM orders""")
def win3_status_priority(spark, sf_dir):
    """SET4 + WIN3: nodes of the three status sets unioned; one per id, best status first."""
    from ..operators.grain import priority_first
    nodes, _ = m_nodes_from_pages(R.read_graphql_pages(spark, landed_m_pages(spark, sf_dir)))
    flat = nodes.select(F.col("node.id").alias("id"), F.col("node.status").alias("status"),
                        "set_seq", "page", "pos")
    return priority_first(flat, "id", "status", ("set_seq", "page", "pos"), columns=["id", "status"])


# ------------------------------------------------------------------ SNK2 / SNK4 / SNK5
@query("snk2_json_roundtrip", oracle=ORACLE["agg1_order_grain"])
def snk2_json_roundtrip(spark, sf_dir):
    """SNK2: order grain written as JSON lines and read back with an explicit schema."""
    from ..operators import grain as G
    from ..session import unique_dir
    from ..sinks import write_json
    from ..sources.adapters import star_lines
    og = G.order_grain(star_lines(spark, sf_dir, product=False, store=False),
                       ["order_datetime", *A.MONEY], items=True)
    path = write_json(og, unique_dir(spark, "json_order_grain"))
    return spark.read.schema(og.schema).json(path)


DAILY_TABLE = T.StructType([T.StructField("date", T.StringType())] + [
    T.StructField(c, T.LongType()) for c in ("order_count", "total_sales", "gross_sales", "coupon_total", "item_count")])


@query("snk4_append_daily_job", oracle=f"""
SELECT strftime(date, '%Y-%m-%d') AS date, order_count, total_sales, gross_sales, coupon_total, item_count
FROM ({ORACLE['agg2_daily_sales']})
WHERE date IN (DATE '1998-06-14', DATE '1998-06-15')""")
def snk4_append_daily_job(spark, sf_dir):
    """RPT9 + SNK4: the daily job run for two days, each appending its row to one table."""
    from ..plans.reports import daily_job
    from ..session import unique_dir
    from ..sinks import append_table
    from ..sources.adapters import star_lines
    target = unique_dir(spark, "daily_append")
    lines = star_lines(spark, sf_dir, product=False, store=False)
    for as_of in (dt.date(1998, 6, 15), dt.date(1998, 6, 16)):
        append_table(daily_job(lines, as_of), target)      # an empty day appends nothing
    return R.read_parquet_or_empty(spark, target, DAILY_TABLE)


_ALL_DAYS = f"""
SELECT strftime(date, '%Y-%m-%d') AS date, order_count, total_sales, gross_sales, coupon_total, item_count
FROM ({ORACLE['agg2_daily_sales']})"""


@query("snk4_append_twice", oracle=f"""{_ALL_DAYS}
WHERE date BETWEEN DATE '1998-06-12' AND DATE '1998-06-15'""")
def snk4_append_twice(spark, sf_dir):
    """RPT9 + SNK4: four days' jobs, the middle two run again (one of them first on half the lines): a row a day."""
    from ..plans.jobs import run_daily_job
    from ..session import unique_dir
    from ..sinks import ROWS
    from ..sinks.published import read_published
    from ..sources.adapters import star_lines
    target = unique_dir(spark, "daily_ledger")
    lines = star_lines(spark, sf_dir, product=False, store=False)
    for day, seen in ((13, lines), (14, lines), (15, lines.filter("ingest_seq % 2 = 0")), (14, lines), (15, lines), (16, lines)):
        run_daily_job(seen, dt.date(1998, 6, day), target)
    return read_published(spark, target, ROWS, schema=DAILY_TABLE)


@query("snk3_versioned_publish", oracle=f"""
SELECT 2 AS version, 'daily' AS name, date, order_count, total_sales FROM ({_ALL_DAYS})
UNION ALL SELECT 2, 'monthly', month, order_count, total_sales FROM ({ORACLE['agg3_monthly_sales']})
UNION ALL SELECT 1, 'daily', date, order_count, total_sales FROM ({_ALL_DAYS}) WHERE date < '1996-01-01'
UNION ALL SELECT 1, 'monthly', month, order_count, total_sales FROM ({ORACLE['agg3_monthly_sales']}) WHERE month < '1996-01'""")
def snk3_versioned_publish(spark, sf_dir):
    """SNK3 + SNK5: two tables published together, replaced by a second commit; both versions read back.

    A third publish of empty tables leaves them as they are."""
    from functools import reduce

    from ..session import unique_dir
    from ..sinks.published import publish, read_published, versions
    from ..sources.adapters import star_lines
    root = unique_dir(spark, "published")
    lines = star_lines(spark, sf_dir, product=False, store=False)
    for part in (lines.filter("order_datetime < TIMESTAMP_NTZ '1996-01-01 00:00:00'"), lines, lines.limit(0)):
        publish(spark, root, {"daily": A.daily_sales(part), "monthly": A.monthly_sales(part)})
    daily, monthly = ((name, c) for name, c in (("daily", "date"), ("monthly", "month")))
    return reduce(DataFrame.unionByName, [
        read_published(spark, root, name, version=v).select(F.lit(v).alias("version"), F.lit(name).alias("name"), F.col(c).alias("date"),
                                                            "order_count", "total_sales")
        for v in versions(spark, root) for name, c in (daily, monthly)])


@query("snk5_summary_bundle", oracle=ORACLE.get("rpt7_summary_table"))
def snk5_summary_bundle(spark, sf_dir):
    """SNK5 (RPT10): the weekly job's four tables; returns the key/value table read back."""
    from ..plans.reports import weekly_job
    from ..session import unique_dir
    from ..sinks import SUMMARY_TABLES, summary_bundle
    from ..sinks.published import read_published
    from ..sources.adapters import star_lines
    from .params import STAR_AS_OF
    t = weekly_job(star_lines(spark, sf_dir), STAR_AS_OF, dt.datetime(1998, 6, 16, 6, 0, 0))
    root = unique_dir(spark, "summary_bundle")
    summary_bundle(t["daily"], t["monthly"], t["products"], t["summary"], root)
    return read_published(spark, root, SUMMARY_TABLES[3])


# ------------------------------------------------------------------ SRC2
@query("src2_period_documents", oracle=f"""
WITH lines AS ({star_lines_sql()})
SELECT {_cols(_CMP_COLS)} FROM lines
WHERE order_datetime >= TIMESTAMP '1998-03-01 00:00:00' AND order_datetime < TIMESTAMP '1998-04-01 00:00:00'""")
def src2_period_documents(spark, sf_dir):
    """SRC2 + FLT2: documents whose order time falls in [start, end), flattened."""
    from ..functions.time import ntz, parse_offset_time
    docs = R.read_order_json(spark, landed_r_orders(spark, sf_dir))
    t = parse_offset_time("orderDatetime")
    window = docs.filter((t >= ntz(dt.datetime(1998, 3, 1))) & (t < ntz(dt.datetime(1998, 4, 1))))
    return flatten_r(window).select(*_CMP_COLS)
