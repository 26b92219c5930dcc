"""Registered queries over inputs where the operators could differ.

Re-fetched order documents (changed money, moved dates, one number in two stores), dirty
documents and files, per-store time tables, and every output of the scheduled jobs.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import WEEKDAY_NAMES
from ..operators import aggregates as A
from ..operators import grain as G
from ..operators.flatten import flatten_r, flatten_y, flatten_y_checked, m_nodes_from_pages
from ..sources import csv_export as C
from ..sources import documents as D
from ..sources import readers as R
from ..sources.adapters import event_lines, event_lines_sql, star_lines, star_lines_sql
from ..sources.landing import in_large_files, land, landed_path
from ..sources.tables import read_table
from ..sources.xml_records import xml_paths, xml_quarantine, xml_rows, xml_table
from .catalog import ORACLE, QUERIES, query
from .params import STAR_AS_OF
from .queries_core import MTD
from .queries_reports import _CLI_E, _CLI_END, _CLI_S, _CLI_START, _MJ_E, _MJ_S, _UPDATED, _WK_E, _WK_S, _window_where
from .queries_sources import _CMP_COLS, _CSV_COLS, _CSV_KEEP_LAST, _IMPORTS, export_lines, landed_csv_export

# ------------------------------------------------------------------ re-fetched documents
_FAR = 1_000_000_000


def refetched_documents(spark, sf_dir) -> DataFrame:
    """R documents plus later and earlier copies: changed money, a moved date, a second store."""
    d, k = D.r_documents(spark, sf_dir), F.col("_ingest_seq")
    moved = F.concat(F.date_format(F.to_timestamp_ntz(F.substring("orderDatetime", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
                                   + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss"), F.substring("orderDatetime", 20, 6))
    price, time, store = F.col("goodsPrice"), F.col("orderDatetime"), F.col("_store_name")

    def copy(price, time, store, seq):
        return F.struct(price.alias("goodsPrice"), time.alias("orderDatetime"), store.alias("_store_name"), seq.alias("_ingest_seq"))
    # a document and its copies leave one row of one scan
    copies = F.array(
        copy(price, time, store, k),
        F.when(k % 7 == 0, copy(price + 1000, time, store, F.when(k % 2 == 0, k - _FAR).otherwise(k + _FAR))),
        F.when(k % 11 == 0, copy(price, moved, store, F.when(k % 3 == 0, k - 2 * _FAR).otherwise(k + 2 * _FAR))),
        F.when(k % 13 == 0, copy(price + 500, time, F.lit("SECOND_STORE"), k + 3 * _FAR)))
    same = [c for c in d.columns if c not in ("goodsPrice", "orderDatetime", "_store_name", "_ingest_seq")]
    return d.select(*same, F.inline(F.array_compact(copies))).select(*d.columns)


def landed_refetched(spark, sf_dir) -> str:
    return land(spark, sf_dir, "r_refetched", lambda: refetched_documents(spark, sf_dir),
                lambda df, p: df.write.mode("overwrite").json(p, compression="gzip"))


def refetched_lines(spark, sf_dir) -> DataFrame:
    return flatten_r(R.read_order_json(spark, landed_refetched(spark, sf_dir)))


_NEXT = "order_datetime + INTERVAL 1 DAY"
_BASE = star_lines_sql()
_REFETCHED = f"""WITH base AS ({_BASE})
SELECT * FROM base
UNION ALL SELECT * REPLACE (total_price + 1000 AS total_price, order_net_sales + 1000 AS order_net_sales,
    CASE WHEN ingest_seq % 2 = 0 THEN ingest_seq - {_FAR} ELSE ingest_seq + {_FAR} END AS ingest_seq)
  FROM base WHERE ingest_seq % 7 = 0
UNION ALL SELECT * REPLACE ({_NEXT} AS order_datetime, CAST({_NEXT} AS DATE) AS order_date,
    strftime({_NEXT}, '%Y-%m') AS order_month, CAST(isodow({_NEXT}) - 1 AS INTEGER) AS order_weekday,
    CASE WHEN ingest_seq % 3 = 0 THEN ingest_seq - {2 * _FAR} ELSE ingest_seq + {2 * _FAR} END AS ingest_seq)
  FROM base WHERE ingest_seq % 11 = 0
UNION ALL SELECT * REPLACE (total_price + 500 AS total_price, order_net_sales + 500 AS order_net_sales,
    'SECOND_STORE' AS source, ingest_seq + {3 * _FAR} AS ingest_seq)
  FROM base WHERE ingest_seq % 13 = 0"""


def _over(name: str, lines_sql: str) -> str:
    """The oracle of a registered query with its order lines replaced by ``lines_sql``."""
    for body in (star_lines_sql(product=False, store=False), star_lines_sql(product=False), star_lines_sql(store=False), _BASE):
        if body in ORACLE[name]:
            return ORACLE[name].replace(body, lines_sql)
    raise ValueError(f"{name} is not stated over the star lines")


@query("agg1_order_grain_refetched", oracle=_over("agg1_order_grain", _REFETCHED))
def agg1_order_grain_refetched(spark, sf_dir):
    return G.order_grain(refetched_lines(spark, sf_dir), ["order_datetime", *A.MONEY], items=True)


@query("agg2_daily_sales_refetched", oracle=_over("agg2_daily_sales", _REFETCHED))
def agg2_daily_sales_refetched(spark, sf_dir):
    return A.daily_sales(refetched_lines(spark, sf_dir))


@query("agg3_monthly_sales_refetched", oracle=_over("agg3_monthly_sales", _REFETCHED))
def agg3_monthly_sales_refetched(spark, sf_dir):
    return A.monthly_sales(refetched_lines(spark, sf_dir))


@query("agg9_summary_stats_refetched", oracle=_over("agg9_summary_stats", _REFETCHED))
def agg9_summary_stats_refetched(spark, sf_dir):
    return A.summary_stats(refetched_lines(spark, sf_dir))


@query("agg12_daily_store_refetched", oracle=_over("agg12_daily_store_sales", _REFETCHED))
def agg12_daily_store_refetched(spark, sf_dir):
    return A.daily_store_sales(refetched_lines(spark, sf_dir))


@query("agg14_colliding_numbers", oracle=_over("agg14_total_and_store_stats", _REFETCHED))
def agg14_colliding_numbers(spark, sf_dir):
    return A.total_and_store_stats(refetched_lines(spark, sf_dir))


@query("str1_with_corrections", oracle=f"""
WITH r AS ({_REFETCHED}), f AS (SELECT order_number, min(ingest_seq) AS first FROM r GROUP BY 1),
d AS (SELECT any_value(order_date) AS date, any_value(order_net_sales) AS net, any_value(total_price) AS gross,
        any_value(coupon_used) AS coupon, sum(quantity) AS units
      FROM r JOIN f ON r.order_number = f.order_number AND ingest_seq = first GROUP BY r.order_number)
SELECT date, count(*) AS order_count, CAST(sum(net) AS BIGINT) AS total_sales, CAST(sum(gross) AS BIGINT) AS gross_sales,
  CAST(sum(coupon) AS BIGINT) AS coupon_total, CAST(sum(units) AS BIGINT) AS item_count FROM d GROUP BY 1""")
def str1_with_corrections(spark, sf_dir):
    """STR1: copies land in any order over several micro-batches; the lowest sequence of an order counts."""
    from ..session import unique_dir
    from ..streaming import current_totals, run_with_corrections
    out = unique_dir(spark, "stream_corrected")    # a fresh sink + checkpoint per run
    source = landed_refetched(spark, sf_dir)
    # four files a batch, more when there are many: the number of batches does not grow with the input
    files = len(spark.read.text(source).inputFiles())
    return current_totals(run_with_corrections(spark, source, out + "/sink", out + "/checkpoint",
                                               max_files_per_trigger=max(4, -(-files // 8))))


# ------------------------------------------------------------------ day states
_PERIODS = ((MTD.start, MTD.end), (dt.date(1997, 1, 1), dt.date(1997, 12, 31)), (dt.date(1992, 1, 1), dt.date(1999, 12, 31)),
            (dt.date(1998, 6, 15), dt.date(1998, 6, 15)))


def _landed_states(spark, sf_dir) -> str:
    from ..operators.day_states import write_day_states
    return land(spark, sf_dir, "day_states", lambda: refetched_lines(spark, sf_dir), write_day_states)


def _over_periods(name: str, columns: str) -> str:
    parts = []
    for i, (s, e) in enumerate(_PERIODS):
        sql = _over(name, _REFETCHED)
        for old, new in ((MTD.start, s), (MTD.end, e)):
            sql = sql.replace(f"DATE '{old}'", f"DATE '{new}'")
        parts.append(f"SELECT {i} AS period, {columns} FROM ({sql})")
    return " UNION ALL ".join(parts)


@query("agg10_from_day_states", oracle=_over_periods("agg10_period_kpi", "sales, orders, items"))
def agg10_from_day_states(spark, sf_dir):
    """AGG10: four periods of the re-fetched data from published day states; no line is read for them."""
    from ..operators import day_states as S
    root = _landed_states(spark, sf_dir)
    return reduce(DataFrame.unionByName, [S.period_kpi(spark, root, s, e).select(F.lit(i).alias("period"), "sales", "orders", "items")
                                          for i, (s, e) in enumerate(_PERIODS)])


@query("agg11_from_day_states", oracle=_over_periods("agg11_source_kpi", "source, sales, orders"))
def agg11_from_day_states(spark, sf_dir):
    """AGG11: the same periods per store, deduplicated inside each store."""
    from ..operators import day_states as S
    root = _landed_states(spark, sf_dir)
    return reduce(DataFrame.unionByName, [S.period_kpi(spark, root, s, e, ("source",)).select(F.lit(i).alias("period"), "source", "sales", "orders")
                                          for i, (s, e) in enumerate(_PERIODS)])


# ------------------------------------------------------------------ per-store time tables
def _store_first(lines_sql: str) -> str:
    return f"""WITH lines AS ({lines_sql}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1)"""


_WEEKDAY = "CASE weekday " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(WEEKDAY_NAMES)) + " END"
_STORE_LINES = star_lines_sql(product=False)


@query("agg6_hourly_per_store", oracle=f"""{_store_first(event_lines_sql())}
SELECT source, order_hour AS hour, count(*) AS order_count, CAST(sum(order_net_sales) AS BIGINT) AS total_sales
FROM f WHERE order_hour IS NOT NULL GROUP BY 1, 2""")
def agg6_hourly_per_store(spark, sf_dir):
    return A.hourly_sales(event_lines(spark, sf_dir), group=("source",))


@query("agg7_weekday_per_store", oracle=f"""{_store_first(_STORE_LINES)}
SELECT *, {_WEEKDAY} AS weekday_name FROM (
SELECT source, order_weekday AS weekday, count(*) AS order_count, CAST(sum(order_net_sales) AS BIGINT) AS total_sales
FROM f WHERE order_weekday IS NOT NULL GROUP BY 1, 2)""")
def agg7_weekday_per_store(spark, sf_dir):
    return A.weekday_sales(star_lines(spark, sf_dir, product=False), group=("source",))


_HEAT = ", ".join(f"CAST(coalesce(sum(order_net_sales) FILTER (WHERE order_weekday = {i}), 0) AS BIGINT) AS \"{n}\""
                  for i, n in enumerate(WEEKDAY_NAMES))


@query("agg8_heatmap_per_store", oracle=f"""{_store_first(event_lines_sql())}
SELECT source, order_hour, {_HEAT} FROM f
WHERE order_hour IS NOT NULL AND order_weekday IS NOT NULL GROUP BY 1, 2""")
def agg8_heatmap_per_store(spark, sf_dir):
    return A.hour_weekday_heatmap(event_lines(spark, sf_dir), group=("source",))


@query("agg3_monthly_per_store", oracle=f"""{_store_first(_STORE_LINES)},
i AS (SELECT source, order_month AS month, CAST(sum(quantity) AS BIGINT) AS item_count FROM lines GROUP BY 1, 2)
SELECT source, month, order_count, total_sales, item_count FROM (
  SELECT source, order_month AS month, count(*) AS order_count, CAST(sum(order_net_sales) AS BIGINT) AS total_sales
  FROM f WHERE order_month IS NOT NULL GROUP BY 1, 2) JOIN i USING (source, month)""")
def agg3_monthly_per_store(spark, sf_dir):
    return A.monthly_sales(star_lines(spark, sf_dir, product=False), group=("source",))


# ------------------------------------------------------------------ dirty documents
def _dirty_json(spark, sf_dir) -> str:
    """R documents as text: every third with a decimal amount, every 17th cut off."""
    def build():
        d = D.r_documents(spark, sf_dir)
        text, k = F.to_json(F.struct(*d.columns)), F.col("_ingest_seq")
        text = F.when(k % 3 == 0, F.regexp_replace(text, '"goodsPrice":([0-9]+)', '"goodsPrice":$1.0')).otherwise(text)
        return d.select(F.when(k % 17 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value"))
    return land(spark, sf_dir, "r_dirty", build, lambda df, p: df.write.mode("overwrite").text(p))


@query("src1_quarantine", oracle="""
SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'quarantined' ELSE 'read' END AS kind, count(*) AS documents FROM orders GROUP BY 1""")
def src1_quarantine(spark, sf_dir):
    """SRC1: malformed documents are set aside, none vanish."""
    good, bad = R.read_order_json_checked(spark, _dirty_json(spark, sf_dir))
    kinds = good.select(F.lit("read").alias("kind")).unionByName(bad.select(F.lit("quarantined").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("documents"))


@query("src1_decimal_amounts", oracle=f"""
SELECT {", ".join(_CMP_COLS)} FROM ({_BASE}) WHERE ingest_seq % 17 <> 0""")
def src1_decimal_amounts(spark, sf_dir):
    """SRC1 + PRJ2: amounts written as 1000.0 are amounts."""
    return flatten_r(R.read_order_json(spark, _dirty_json(spark, sf_dir))).select(*_CMP_COLS)


#: XML documents that one task parses, however few files their keys come from.
XML_DOCS_A_TASK = 100_000
_XML = "<OrderInfo><OrderId>{0}</OrderId><OrderTime>{1}</OrderTime><Pay><TotalPrice>{2}</TotalPrice></Pay>{3}</OrderInfo>"


@query("src9_xml_reasons", oracle="""
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 7 AS fault FROM orders)
SELECT 'error_response' AS reason, 'too many requests for ' || k AS error, 1 AS documents FROM o WHERE fault = 0
UNION ALL SELECT * FROM (SELECT 'error_response', 'Unknown error', count(*) AS n FROM o WHERE fault = 1
  UNION ALL SELECT 'unparsed', NULL, count(*) FROM o WHERE fault = 2
  UNION ALL SELECT 'bad_time', NULL, count(*) FROM o WHERE fault = 3
  UNION ALL SELECT 'bad_amount', NULL, count(*) FROM o WHERE fault = 4
  UNION ALL SELECT 'line', NULL, count(*) FROM o WHERE fault > 4) WHERE n > 0""")
def src9_xml_reasons(spark, sf_dir):
    """SRC7 + SRC9 + PRJ6: one document an order key, each with one kind of fault by its key.

    Nested and namespaced errors, broken XML, bad values; other roots, empty items."""
    n = read_table(spark, sf_dir, "orders", ["o_orderkey"]).withColumnRenamed("o_orderkey", "k")
    # a key takes a few bytes of a file and a document much time: tasks by the row count, not by the file's bytes
    n = n.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n.count() // XML_DOCS_A_TASK)))
    order = lambda time="19980101120000", amount="500", items="": F.format_string(
        _XML.replace("{0}", "%s").replace("{1}", time).replace("{2}", amount).replace("{3}", items), "k")
    texts = [F.concat(F.lit("<ResultSet><Error><Message>too many requests for "), "k", F.lit("</Message></Error></ResultSet>")),
             F.lit('<a:Answer xmlns:a="u"><a:Error/></a:Answer>'), F.lit("<ResultSet><Result><OrderInfo><OrderId>7"),
             F.concat(F.lit("<Result>"), order(time="soon"), F.lit("</Result>")), order(amount="twelve"),
             F.concat(F.lit("<!-- a comment -->\n<Answer><ResultSet><Result>"), order(items="<Item/>"), F.lit("</Result></ResultSet></Answer>")),
             F.concat(F.lit("<Answer>"), order(items="<Item/><Item><ItemId>1</ItemId><UnitPrice>500</UnitPrice></Item>"), F.lit("</Answer>"))]
    # only the text that a key asks for is built
    value = reduce(lambda c, i: c.when(F.col("k") % 7 == i, texts[i]), range(1, 7), F.when(F.col("k") % 7 == 0, texts[0]))
    checked = flatten_y_checked(n.select(value.alias("value"), F.col("k").alias("ingest_seq")))
    rows = checked.filter("reason is not null or (total_price = 500 and quantity = 1)").select(F.coalesce("reason", F.lit("line")).alias("reason"), "error")
    return rows.groupBy("reason", "error").agg(F.count(F.lit(1)).alias("documents"))


# one document an order; items stand once or several times, options are empty, text or nested
_ANY_XML = """
WITH i AS (SELECT l_orderkey AS k, l_partkey AS part, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n,
             count(*) OVER (PARTITION BY l_orderkey) AS of FROM lineitem),
t AS (SELECT k, part, 'Info/' || CASE WHEN of > 1 THEN 'Item[' || (n - 1) || ']' ELSE 'Item' END AS item FROM i WHERE k % 11 <> 0 AND k % 13 <> 0)"""


def _any_xml(spark, sf_dir) -> str:
    """Written rows of documents whose shapes differ: the parser runs once for both parts."""
    def build():
        k = F.col("o_orderkey")
        orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
        items = (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
                 .groupBy(F.col("l_orderkey").alias("o_orderkey"))
                 .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("items")))
        option = lambda x: F.when(x % 3 == 0, F.lit("<Option/>")).when(
            x % 3 == 1, F.format_string("<Option>size %s</Option>", x)).otherwise(F.format_string("<Option><Size> %s </Size></Option>", x))
        item = lambda x: F.concat(F.lit("<Item no='1'><Part>"), x["l_partkey"].cast("string"), F.lit("</Part>"),
                                  option(x["l_partkey"]), F.lit("</Item>"))
        body = F.concat(F.format_string("<Info><!-- x --><Id>%s</Id><Status><![CDATA[<%s>]]></Status>", k, F.col("o_orderstatus")),
                        F.array_join(F.transform(F.coalesce("items", F.array().cast(items.schema["items"].dataType)), item), ""), F.lit("</Info>"))
        text = (F.when(k % 11 == 0, F.concat(F.lit("<Answer>"), body))
                .when(k % 13 == 0, F.format_string("<Answer><Error><Message>no order %s</Message></Error></Answer>", k))
                .when(k % 2 == 0, F.concat(F.lit("<a:Answer xmlns:a='u' xmlns='v'>"), body, F.lit("</a:Answer>")))
                .otherwise(F.concat(F.lit("<?xml version='1.0' encoding='UTF-8'?>\n<Answer>"), body, F.lit("</Answer>"))))
        return xml_rows(orders.join(items, "o_orderkey", "left").select(text.alias("value"), k.alias("ingest_seq")))
    return land(spark, sf_dir, "any_xml_rows", build, lambda df, p: df.write.mode("overwrite").parquet(p))


@query("src8_any_xml", oracle=_ANY_XML + """
SELECT o_orderkey AS ingest_seq, 'Info/Id' AS path, 'Info/Id' AS tag_path, CAST(o_orderkey AS VARCHAR) AS value, NULL AS reason
  FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
UNION ALL SELECT o_orderkey, 'Info/Status', 'Info/Status', '<' || o_orderstatus || '>', NULL FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
UNION ALL SELECT k, item || '/Part', 'Info/Item/Part', CAST(part AS VARCHAR), NULL FROM t
UNION ALL SELECT k, item || '/Option', 'Info/Item/Option', CASE WHEN part % 3 = 1 THEN 'size ' || part END, NULL FROM t WHERE part % 3 < 2
UNION ALL SELECT k, item || '/Option/Size', 'Info/Item/Option/Size', ' ' || part || ' ', NULL FROM t WHERE part % 3 = 2
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, 'unparsed' FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT o_orderkey, NULL, NULL, 'no order ' || o_orderkey, 'error_response' FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0""")
def src8_any_xml(spark, sf_dir):
    """SRC8: XML without a schema as path / value rows; broken documents and errors set aside."""
    rows = spark.read.parquet(_any_xml(spark, sf_dir))
    none = F.lit(None).cast("string")
    bad = xml_quarantine(rows).select("ingest_seq", none.alias("path"), none.alias("tag_path"),
                                      F.when(F.col("reason") == "error_response", F.col("error")).alias("value"), "reason")
    return xml_paths(rows).drop("pos").withColumn("reason", none).unionByName(bad)


@query("src8_any_xml_items", oracle=_ANY_XML + """
SELECT k AS ingest_seq, item, CAST(part AS VARCHAR) AS part, CASE WHEN part % 3 = 1 THEN 'size ' || part END AS note,
  CASE WHEN part % 3 = 2 THEN ' ' || part || ' ' END AS size FROM t""")
def src8_any_xml_items(spark, sf_dir):
    """SRC8: list entries of schema-free XML as a table, the same for one entry and for many."""
    paths = xml_paths(spark.read.parquet(_any_xml(spark, sf_dir)))
    return xml_table(paths, {"part": "Part", "note": "Option", "size": "Option/Size"}, each="Info/Item")


@query("src11_truncated_pages", oracle="""
WITH n AS (SELECT o_orderstatus AS s, o_orderkey // 100 AS page FROM orders
           UNION ALL SELECT 'O', o_orderkey // 100 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 = 0)
SELECT 'unreadable page' AS message, count(DISTINCT (s, page)) AS n FROM n WHERE page % 5 = 0
UNION ALL SELECT 'Throttled', count(DISTINCT s) FROM n
UNION ALL SELECT 'node', count(*) FROM n WHERE page % 5 <> 0""")
def src11_truncated_pages(spark, sf_dir):
    """SRC11: pages cut off in transit are failed pages; their nodes are not used."""
    pages = D.m_pages(spark, sf_dir).withColumn("value", F.when(F.col("page") % 5 == 0, F.substring("value", 1, 60)).otherwise(F.col("value")))
    nodes, failed = m_nodes_from_pages(pages)
    rows = failed.select("message").unionByName(nodes.select(F.lit("node").alias("message")))
    return rows.groupBy("message").agg(F.count(F.lit(1)).alias("n"))


@query("src3_page_gaps", oracle="""
WITH b AS (SELECT DISTINCT strftime(o_orderdate, '%Y') AS chain, o_orderkey // 100 AS block FROM orders),
p AS (SELECT chain, row_number() OVER (PARTITION BY chain ORDER BY block) AS page, count(*) OVER (PARTITION BY chain) AS total FROM b),
f AS (SELECT *, page % 7 = 3 AS gone, page % 11 = 6 AS cut, CASE WHEN page % 5 = 0 THEN 2 ELSE 1 END AS copies FROM p),
m AS (SELECT *, page - row_number() OVER (PARTITION BY chain ORDER BY page) AS island FROM f WHERE gone OR cut)
SELECT chain, 'missing' AS kind, min(page) AS first_page, max(page) AS last_page, count(*) AS n FROM m GROUP BY chain, island
UNION ALL SELECT chain, 'repeated', page, page, 2 FROM f WHERE copies = 2 AND NOT gone AND NOT cut
UNION ALL SELECT NULL, 'unreadable', NULL, NULL, coalesce(sum(copies), 0) FROM f WHERE cut AND NOT gone""")
def src3_page_gaps(spark, sf_dir):
    """SRC3: search pages of every year with lost, repeated and cut-off ones: gaps, repeats, quarantine."""
    def build():
        o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
        pages = (o.groupBy(F.date_format("o_orderdate", "yyyy").alias("chain"), F.expr("o_orderkey div 100").alias("block"))
                 .agg(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))).alias("orderNumberList")))
        year = Window.partitionBy("chain")
        pages = pages.withColumn("page", F.row_number().over(year.orderBy("block"))).withColumn("total", F.count("*").over(year))
        n = F.col("page")
        text = F.to_json(F.struct("chain", "page", "orderNumberList", F.struct(F.col("total").alias("totalPages")).alias("PaginationResponseModel")))
        copies = F.sequence(F.lit(1), F.when(n % 5 == 0, 2).otherwise(1))
        return pages.filter(n % 7 != 3).select(F.explode(copies), F.when(n % 11 == 6, F.substring(text, 1, 60)).otherwise(text).alias("value")).select("value")
    path = land(spark, sf_dir, "r_search_chains", build, lambda df, p: df.write.mode("overwrite").text(p))
    pages, bad = R.read_search_pages_checked(spark, path)
    gaps = R.page_gaps(pages.select("chain", "page", F.col("PaginationResponseModel.totalPages").alias("total_pages")))
    none = lambda t: F.lit(None).cast(t)
    return gaps.unionByName(bad.agg(F.count("*").alias("n")).select(
        none("string").alias("chain"), F.lit("unreadable").alias("kind"), none("long").alias("first_page"), none("long").alias("last_page"), "n"))


# ------------------------------------------------------------------ text that CSV must carry
_QUOTED = """'"' || item_name || '", x' || chr(10) || ' y '"""


@query("src13_quoted_fields", oracle=f"""
SELECT order_number, {_QUOTED} AS item_name, quantity, unit_price, total_price
FROM ({star_lines_sql(drop_cancelled=False)})""")
def src13_quoted_fields(spark, sf_dir):
    """SRC13: names with quotes, commas, line breaks and blanks in a cp932 export of all lines."""
    path = land(spark, sf_dir, "csv_quoted", lambda: _quoted_export(spark, sf_dir), lambda df, p: C.write_export(df, p))
    return C.parse_order_csv(spark, path).select("order_number", "item_name", "quantity", "unit_price", "total_price")


def _quoted_export(spark, sf_dir, ordered=None) -> DataFrame:
    lines = export_lines(spark, sf_dir)
    return D.csv_export(lines.withColumn("item_name", F.concat(F.lit('"'), "item_name", F.lit('", x\n y '))), 0, ordered=ordered)


@query("src13_split_quoted", oracle=f"""
SELECT order_number, {_QUOTED} AS item_name, quantity, unit_price, total_price
FROM ({star_lines_sql(drop_cancelled=False)})""")
def src13_split_quoted(spark, sf_dir):
    """SRC13: all lines in large files with line breaks inside fields, each read in byte ranges by many tasks.

    One file up to ``FILE_ROWS`` lines, else one for each such number: a file is written by one task.
    """
    def ordered(lines, columns):
        return in_large_files(lines, columns, lines.count())
    path = land(spark, sf_dir, "csv_one_file", lambda: _quoted_export(spark, sf_dir, ordered), lambda df, p: C.write_export(df, p))
    return C.parse_order_csv(spark, path).select("order_number", "item_name", "quantity", "unit_price", "total_price")


@query("src13_mixed_headers", oracle=f"""
SELECT order_number, item_name, quantity, unit_price, total_price FROM ({star_lines_sql(drop_cancelled=False)})""")
def src13_mixed_headers(spark, sf_dir):
    """SRC13 + PRJ10: one folder whose files order and name their columns differently, in two charsets."""
    def save(lines, path):
        for i, (layout, turned) in enumerate(((0, False), (0, True), (1, True))):
            df = D.csv_export(lines.filter(F.col("ingest_seq") % 3 == i), layout)
            if turned:
                df = df.select(*[F.col(c).alias(c.lstrip(C.BOM)) for c in reversed(df.columns)])
                df = df.withColumnRenamed(df.columns[0], C.BOM + df.columns[0]) if layout == 1 else df
            C.write_export(df, path, D.CSV_LAYOUTS[layout][0], "append" if i else "overwrite")
    path = land(spark, sf_dir, "csv_mixed_headers", lambda: export_lines(spark, sf_dir), save)
    return C.parse_order_csv(spark, path).select("order_number", "item_name", "quantity", "unit_price", "total_price")


@query("prj14_required_columns", oracle=f"""
WITH l AS ({star_lines_sql(drop_cancelled=False)})
SELECT CASE ingest_seq % 3 WHEN 0 THEN '' WHEN 1 THEN 'order_number' ELSE 'order_date' END AS missing,
       count(*) AS n_records, CAST(sum(CASE WHEN ingest_seq % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_parsed,
       CAST(sum(CASE WHEN ingest_seq % 3 = 0 THEN quantity END) AS BIGINT) AS quantity
FROM l GROUP BY 1""")
def prj14_required_columns(spark, sf_dir):
    """PRJ14: one folder, files without an order number or an order date beside whole ones; the whole ones parse."""
    def save(lines, path):
        for i, gone in enumerate((None, "order_number", "order_date")):
            df = D.csv_export(lines.filter(F.col("ingest_seq") % 3 == i), 0)
            kept = [c for c in df.columns if gone is None or c.lstrip(C.BOM) not in C.HEADER_ALIASES[gone]]
            C.write_export(df.select(*kept), path, D.CSV_LAYOUTS[0][0], "append" if i else "overwrite")
    path = land(spark, sf_dir, "csv_short_headers", lambda: export_lines(spark, sf_dir), save)
    files = (C.required_columns(spark, path).groupBy(F.array_join("missing", ",").alias("missing"))
             .agg(F.sum("n_records").alias("n_records")))
    parsed = C.parse_order_csv(spark, path, skip_incomplete=True).agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))
    whole = F.col("missing") == ""
    return files.crossJoin(F.broadcast(parsed)).select(  # one row of totals
        "missing", "n_records", F.when(whole, F.col("n")).otherwise(0).cast("bigint").alias("n_parsed"), F.when(whole, F.col("quantity")).alias("quantity"))


DOCS_A_FILE = 150_000


@query("src1_json_array_file", oracle=f"""
SELECT {", ".join(_CMP_COLS)} FROM ({_BASE})""")
def src1_json_array_file(spark, sf_dir):
    """SRC1: all order documents as indented JSON arrays in large files, each read in byte ranges by many tasks.

    One array up to ``DOCS_A_FILE`` documents, else one for each such number: a file is written by one task.
    """
    from ..sources.split_records import read_json_objects

    def save(docs, path):
        n = max(1, -(-read_table(spark, sf_dir, "orders").count() // DOCS_A_FILE))
        file = F.pmod(F.coalesce("_ingest_seq", F.lit(0)), F.lit(n)).cast("int")
        rows = docs.select(file.alias("file"), F.col("_ingest_seq").alias("at"), F.lit(0).alias("end"), F.struct(*docs.columns).alias("doc"))
        ends = spark.range(n).select(F.col("id").cast("int").alias("file"), F.explode(F.array(F.lit(-1), F.lit(1))).alias("end"))
        # a file's rows are in one task, which writes their text; the comma stands before every document but the first
        rows = rows.unionByName(ends, allowMissingColumns=True).repartition(n, "file").sortWithinPartitions("file", "end", "at")
        before = F.lag("end").over(Window.partitionBy("file").orderBy("file", "end", "at"))
        # indented by one blank a level: half of what the writer puts there
        value = F.regexp_replace(F.to_json("doc", {"pretty": "true"}), r"\n( +)\1", "\n$1")
        text = (F.when(F.col("end") < 0, "[").when(F.col("end") > 0, "]")
                .when(before == 0, F.concat(F.lit(","), value)).otherwise(value))
        (rows.select("file", text.alias("value")).write.mode("overwrite").partitionBy("file").text(path))
    path = land(spark, sf_dir, "r_array", lambda: D.r_documents(spark, sf_dir), save)
    return flatten_r(read_json_objects(spark, path, R.R_ORDER_LANDED)[0]).select(*_CMP_COLS)


@query("snk6_file_roundtrip", oracle=f"""{_CSV_KEEP_LAST}
SELECT {_CSV_COLS} FROM last""")
def snk6_file_roundtrip(spark, sf_dir):
    """SNK6 + SRC14 in file form: parsed exports saved as CSV imports, all loaded, last row kept."""
    root = landed_path(spark, sf_dir, "saved_csv_imports")

    def save(_df, _path):
        for import_id, (layout, *_rest) in _IMPORTS.items():
            parsed = C.parse_order_csv(spark, landed_csv_export(spark, sf_dir, import_id), D.CSV_LAYOUTS[layout][0])
            C.save_import_csv(parsed.orderBy("_file", "_pos"), root, import_id)
    land(spark, sf_dir, "saved_csv_imports", lambda: None, save)
    return C.load_saved_csv(spark, root)


@query("snk1_text_roundtrip", oracle="""
SELECT CAST(p_partkey AS VARCHAR) AS id, '  ' || p_name || ' "q", ' || chr(92) || ' ' AS name FROM part""")
def snk1_text_roundtrip(spark, sf_dir):
    """SNK1: indents, quotes, commas and backslashes come back as written."""
    from ..sinks import write_csv
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    path = landed_path(spark, sf_dir, "csv_text")
    write_csv(part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("  "), "p_name", F.lit(' "q", \\ ')).alias("name")), path)
    return C.read_raw_export(spark, path, "UTF-8")


@query("snk7_exports", oracle=f"""
SELECT 'daily' AS export, count(*) AS rows, CAST(sum(total_sales) AS BIGINT) AS total FROM ({ORACLE['agg2_daily_sales']})
UNION ALL SELECT 'products', count(*), CAST(sum(total_sales) AS BIGINT) FROM ({ORACLE['agg4_product_sales']})
UNION ALL SELECT 'lines', count(*), CAST(sum(subtotal) AS BIGINT) FROM ({star_lines_sql(store=False)})""")
def snk7_exports(spark, sf_dir):
    """SNK7: the three CSV exports, read back."""
    from ..sinks import export_csvs
    lines = star_lines(spark, sf_dir, store=False)
    paths = export_csvs(A.daily_sales(lines), A.product_sales_sorted(lines), lines, landed_path(spark, sf_dir, "exports"))
    parts = [C.read_raw_export(spark, p, "UTF-8").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(c).cast("bigint")).alias("total"))
             .select(F.lit(name).alias("export"), "rows", "total")
             for p, name, c in zip(paths, ("daily", "products", "lines"), ("total_sales", "total_sales", "subtotal"))]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ every output of the jobs
# output -> (key columns, metric columns)
_OUTPUTS = {
    "daily": (["date"], ["order_count", "total_sales", "gross_sales", "coupon_total", "item_count"]),
    "monthly": (["month"], ["order_count", "total_sales", "item_count"]),
    "hourly": (["hour"], ["order_count", "total_sales"]),
    "products": (["item_number", "item_id"], ["quantity", "total_sales", "order_count"]),
    "stats": ([], ["total_orders", "total_sales", "gross_sales", "total_items", "avg_order_value"]),
    "lines": (["order_number", "line_seq", "item_id", "quantity", "unit_price", "shipping_charge"], ["subtotal"]),
}


def _tidy(output: str, df: DataFrame) -> DataFrame:
    keys, metrics = _OUTPUTS[output]
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys]) if keys else F.lit("")
    return df.select(F.lit(output).alias("output"), key.alias("key"),
                     *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(["output", "key"], metrics, "metric", "value")


def _tidy_sql(output: str, sql: str) -> str:
    keys, metrics = _OUTPUTS[output]
    key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys) or "''"
    return " UNION ALL ".join(f"SELECT '{output}' AS output, {key} AS key, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({sql})"
                              for m in metrics)


def _windowed(name: str, where: str, **lines) -> str:
    body = star_lines_sql(**lines)
    return _over(name, f"SELECT * FROM ({body}) WHERE {where}")


def _job_sql(where: str, outputs: dict[str, str]) -> str:
    parts = [_tidy_sql(o, f"SELECT * FROM ({star_lines_sql()}) WHERE {where}" if o == "lines" else _windowed(q, where))
             for o, q in outputs.items()]
    return " UNION ALL ".join(parts)


@query("rpt10_all_tables", oracle=_job_sql(_window_where(_WK_S, _WK_E), {"daily": "agg2_daily_sales", "monthly": "agg3_monthly_sales"})
       + " UNION ALL " + _tidy_sql("products", f"SELECT * FROM ({_windowed('agg4_product_sales', _window_where(_WK_S, _WK_E))}) LIMIT 50"))
def rpt10_all_tables(spark, sf_dir):
    """RPT10: daily, monthly and top-50 product tables of the weekly job (the summary is snk5)."""
    from .reports import weekly_job
    t = weekly_job(star_lines(spark, sf_dir), STAR_AS_OF, _UPDATED)
    return reduce(DataFrame.unionByName, [_tidy(o, t[o]) for o in ("daily", "monthly", "products")])


@query("rpt11_all_outputs", oracle=_job_sql(_window_where(_MJ_S, _MJ_E), {
    "lines": "", "monthly": "agg3_monthly_sales", "products": "agg4_product_sales", "stats": "agg9_summary_stats"}))
def rpt11_all_outputs(spark, sf_dir):
    """RPT11: lines, monthly, product and summary outputs of the monthly job."""
    from .reports import monthly_job
    t = monthly_job(star_lines(spark, sf_dir), STAR_AS_OF)
    return reduce(DataFrame.unionByName, [_tidy(o, t[o]) for o in ("lines", "monthly", "products", "stats")])


_HOURLY = f"""WITH lines AS (SELECT * FROM ({star_lines_sql()}) WHERE {_window_where(_CLI_S, _CLI_E)}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number ORDER BY ingest_seq, line_seq, item_id) AS rn FROM lines) WHERE rn = 1)
SELECT order_hour AS hour, count(*) AS order_count, sum(order_net_sales) AS total_sales FROM f GROUP BY 1"""


@query("rpt12_all_outputs", oracle=_job_sql(_window_where(_CLI_S, _CLI_E), {
    "lines": "", "daily": "agg2_daily_sales", "monthly": "agg3_monthly_sales", "products": "agg4_product_sales",
    "stats": "agg9_summary_stats"}) + " UNION ALL " + _tidy_sql("hourly", _HOURLY))
def rpt12_all_outputs(spark, sf_dir):
    """RPT12: every table of the full run."""
    from .reports import full_run
    t = full_run(star_lines(spark, sf_dir), _CLI_START, _CLI_END, STAR_AS_OF)
    return reduce(DataFrame.unionByName, [_tidy(o, t[o]) for o in ("lines", "daily", "monthly", "products", "hourly", "stats")])


@query("rpt9_raw_documents", oracle=f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_number FROM orders
WHERE CAST(o_orderdate AS DATE) = DATE '{STAR_AS_OF - dt.timedelta(days=1)}'""")
def rpt9_raw_documents(spark, sf_dir):
    """RPT9: the raw documents that the daily job writes beside its table."""
    from ..session import unique_dir
    from ..sinks import stamp
    from .jobs import run_daily_job
    root = unique_dir(spark, "daily_job")
    run_daily_job(star_lines(spark, sf_dir, product=False, store=False), STAR_AS_OF, f"{root}/table",
                  raw_docs=D.r_documents(spark, sf_dir), raw_dir=f"{root}/raw")
    name = stamp("orders", dt.datetime.combine(STAR_AS_OF, dt.time()))
    return R.read_order_json(spark, f"{root}/raw/{name}").select(F.col("orderNumber").alias("order_number"))


@query("flt12_empty_input_guards", oracle=f"""
SELECT strftime(date, '%Y-%m-%d') AS date, order_count, total_sales, false AS overwritten, false AS appended
FROM ({ORACLE['agg2_daily_sales']})""")
def flt12_empty_input_guards(spark, sf_dir):
    """FLT12: an empty result neither replaces a table nor adds to it."""
    from ..session import unique_dir
    from ..sinks import append_table, overwrite_table
    target = unique_dir(spark, "guarded")
    daily = A.daily_sales(star_lines(spark, sf_dir, product=False, store=False))
    overwrite_table(daily, target)
    none = daily.filter("order_count < 0")
    overwritten, appended = overwrite_table(none, target), append_table(none, target)
    return spark.read.parquet(target).select("date", "order_count", "total_sales", F.lit(overwritten).alias("overwritten"),
                                             F.lit(appended).alias("appended"))


@query("fn5_strict_dates", oracle="""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
t AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_number, CASE o_orderkey % 7
  WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y/%m/%d')
  WHEN 2 THEN year(d) || '-' || month(d) || '-' || day(d) WHEN 3 THEN strftime(d, '%Y') || '-13-' || strftime(d, '%d')
  WHEN 4 THEN strftime(d, '%Y-%m-%d') || ' 00:00:00' WHEN 5 THEN strftime(d, '%Y') || '-02-' || strftime(d, '%d')
  ELSE '' END AS text FROM d)
SELECT order_number, text,
  CASE WHEN regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_cast(text AS DATE) END AS date FROM t""")
def fn5_strict_dates(spark, sf_dir):
    """FN5: every order's date as text in seven spellings; only real dates written yyyy-MM-dd are read."""
    from ..functions.time import parse_iso_date
    d, kind = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 7
    spelled = (F.when(kind == 0, F.date_format(d, "yyyy-MM-dd")).when(kind == 1, F.date_format(d, "yyyy/MM/dd"))
               .when(kind == 2, F.concat_ws("-", F.year(d), F.month(d), F.day(d)))
               .when(kind == 3, F.concat(F.date_format(d, "yyyy"), F.lit("-13-"), F.date_format(d, "dd")))
               .when(kind == 4, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00")))
               .when(kind == 5, F.concat(F.date_format(d, "yyyy"), F.lit("-02-"), F.date_format(d, "dd"))).otherwise(""))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    return orders.select(F.col("o_orderkey").cast("string").alias("order_number"), spelled.alias("text"),
                         parse_iso_date(spelled).alias("date"))


@query("fn19_report_message", oracle=f"""
SELECT string_agg(text, chr(10) ORDER BY line_no) AS message FROM ({ORACLE['rpt5_daily_report_text']})""")
def fn19_report_message(spark, sf_dir):
    """FN19: the daily report as the one message that is sent."""
    from .reports import report_text
    return report_text(QUERIES["rpt5_daily_report_text"](spark, sf_dir))
