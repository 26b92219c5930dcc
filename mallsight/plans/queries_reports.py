"""Registered report queries (RPT1-RPT12, FLT13-FLT15, JON3, JON5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..sources.adapters import star_lines, star_lines_sql
from . import reports as RP
from . import windows as W
from .catalog import query
from .params import STAR_AS_OF, STAR_MALLS, STAR_STORES

_TARGET = STAR_AS_OF - dt.timedelta(days=1)
_UPDATED = dt.datetime(1998, 6, 16, 6, 0, 0)


def _d(d):
    return f"DATE '{d.isoformat()}'"


def _tagged_sql(periods, lines_where="TRUE"):
    """per: (period, line) rows for each named inclusive date range."""
    parts = [f"SELECT '{n}' AS period, * FROM lines WHERE {lines_where} AND order_date BETWEEN {_d(a)} AND {_d(b)}"
             for n, a, b in periods]
    return "per AS (" + "\n  UNION ALL ".join(parts) + ")"


def _kpi_sql(group):
    g = ", ".join(group)
    return f"""
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {g}, order_number
      ORDER BY ingest_seq, line_seq, item_id) AS rn FROM per) WHERE rn = 1),
s AS (SELECT {g}, sum(order_net_sales) AS sales, count(*) AS orders FROM f GROUP BY {g}),
i AS (SELECT {g}, sum(quantity) AS items FROM per GROUP BY {g})"""


def _rate_sql(cur, prev):
    return (f"CASE WHEN coalesce({prev}, 0) = 0 THEN 0 ELSE {cur} - {prev} END",
            f"CASE WHEN coalesce({prev}, 0) = 0 THEN 0.0 ELSE ({cur} - {prev}) * 100.0 / {prev} END")


_Y, _M = W.yesterday(STAR_AS_OF), W.month_to_date(STAR_AS_OF)
_LY, _LM = W.year_ago_period(_Y), W.year_ago_period(_M)
_PERIODS = [(p.name, p.start, p.end) for p in (_Y, _M, _LY, _LM)]

_RPT1_DIFF, _RPT1_RATE = _rate_sql("coalesce(c.sales, 0)", "p.sales")


@query("rpt1_yoy_panel", oracle=f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}), {_tagged_sql(_PERIODS)}, {_kpi_sql(['period'])},
k AS (SELECT coalesce(s.period, i.period) AS period, s.sales, s.orders, i.items
      FROM s FULL JOIN i ON s.period = i.period),
frame AS (SELECT * FROM (VALUES ('{_Y.name}', {_d(_Y.start)}, {_d(_Y.end)}, {_Y.days}, '{_LY.name}'),
                                ('{_M.name}', {_d(_M.start)}, {_d(_M.end)}, {_M.days}, '{_LM.name}'))
          AS t(period, start, "end", days, ly_period))
SELECT fr.period, fr.start, fr."end",
       CAST(coalesce(c.sales, 0) AS BIGINT) AS sales, CAST(coalesce(c.orders, 0) AS BIGINT) AS orders,
       CAST(coalesce(c.items, 0) AS BIGINT) AS items,
       CAST(coalesce(p.sales, 0) AS BIGINT) AS ly_sales, CAST(coalesce(p.orders, 0) AS BIGINT) AS ly_orders,
       CAST(coalesce(p.items, 0) AS BIGINT) AS ly_items,
       CAST({_RPT1_DIFF} AS BIGINT) AS diff, {_RPT1_RATE} AS rate,
       coalesce(c.sales, 0) / greatest(fr.days, 1) AS daily_average
FROM frame fr LEFT JOIN k c ON fr.period = c.period LEFT JOIN k p ON fr.ly_period = p.period""")
def rpt1_yoy_panel(spark, sf_dir):
    return RP.yoy_panel(star_lines(spark, sf_dir, product=False, store=False), STAR_AS_OF)


_STORE_IN = ", ".join(f"'{s}'" for s in STAR_STORES)
_STORE_FRAME = ",\n ".join(
    f"('{s}', {i}, '{p.name}', {p.days}, '{lp.name}')" for i, s in enumerate(STAR_STORES)
    for p, lp in ((_Y, _LY), (_M, _LM)))
_RPT2_DIFF, _RPT2_RATE = _rate_sql("coalesce(c.sales, 0)", "p.sales")


@query("rpt2_store_yoy_panel", oracle=f"""
WITH lines AS ({star_lines_sql(product=False)}), {_tagged_sql(_PERIODS, f"source IN ({_STORE_IN})")},
{_kpi_sql(['source', 'period'])},
frame AS (SELECT * FROM (VALUES {_STORE_FRAME}) AS t(source, store_seq, period, days, ly_period))
SELECT fr.source, fr.store_seq, fr.period,
       CAST(coalesce(c.sales, 0) AS BIGINT) AS sales, CAST(coalesce(c.orders, 0) AS BIGINT) AS orders,
       CAST(coalesce(p.sales, 0) AS BIGINT) AS ly_sales, CAST(coalesce(p.orders, 0) AS BIGINT) AS ly_orders,
       CAST({_RPT2_DIFF} AS BIGINT) AS diff, {_RPT2_RATE} AS rate,
       coalesce(c.sales, 0) / greatest(fr.days, 1) AS daily_average
FROM frame fr LEFT JOIN s c ON fr.source = c.source AND fr.period = c.period
LEFT JOIN s p ON fr.source = p.source AND fr.ly_period = p.period""")
def rpt2_store_yoy_panel(spark, sf_dir):
    return RP.store_yoy_panel(star_lines(spark, sf_dir, product=False), STAR_AS_OF, STAR_STORES)


_MALL_FRAME = ", ".join(f"('{m}', '{p.name}')" for m in STAR_MALLS for p in (_Y, _M))


@query("rpt3_mall_kpi", oracle=f"""
WITH lines AS ({star_lines_sql(product=False)}),
{_tagged_sql([(p.name, p.start, p.end) for p in (_Y, _M)])},
{_kpi_sql(['mall', 'period'])},
frame AS (SELECT * FROM (VALUES {_MALL_FRAME}) AS t(mall, period))
SELECT fr.mall, fr.period, CAST(coalesce(s.sales, 0) AS BIGINT) AS sales,
       CAST(coalesce(s.orders, 0) AS BIGINT) AS orders
FROM frame fr LEFT JOIN s ON fr.mall = s.mall AND fr.period = s.period""")
def rpt3_mall_kpi(spark, sf_dir):
    return RP.mall_kpi(star_lines(spark, sf_dir, product=False), STAR_AS_OF, STAR_MALLS)


_RP = RP.report_periods(_TARGET)
_RP_PERIODS = [(p.name, p.start, p.end) for p in _RP if p]

_RPT4_SQL = f"""
WITH lines AS ({star_lines_sql(product=False)}), {_tagged_sql(_RP_PERIODS)},
tf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY period, order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM per) WHERE rn = 1),
sf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY period, source, order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM per) WHERE rn = 1),
t_o AS (SELECT period, count(DISTINCT order_number) AS total_orders, sum(order_net_sales) AS total_sales,
        avg(order_net_sales) AS avg_order_value FROM tf GROUP BY 1),
t_i AS (SELECT period, sum(quantity) AS total_items FROM per GROUP BY 1),
s_o AS (SELECT period, source, count(DISTINCT order_number) AS total_orders,
        sum(order_net_sales) AS total_sales, avg(order_net_sales) AS avg_order_value FROM sf GROUP BY 1, 2),
s_i AS (SELECT period, source, sum(quantity) AS total_items, min(ingest_seq) AS first_seq FROM per GROUP BY 1, 2),
frame AS (SELECT * FROM (VALUES {", ".join(f"('{n}')" for n, _, _ in _RP_PERIODS)}) AS t(section)),
ds AS (
SELECT fr.section, 'total' AS scope, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS INTEGER) AS store_rank,
       CAST(coalesce(t_o.total_orders, 0) AS BIGINT) AS total_orders,
       CAST(coalesce(t_o.total_sales, 0) AS BIGINT) AS total_sales,
       coalesce(t_o.avg_order_value, 0.0) AS avg_order_value,
       CAST(coalesce(t_i.total_items, 0) AS BIGINT) AS total_items
FROM frame fr LEFT JOIN t_o ON fr.section = t_o.period LEFT JOIN t_i ON fr.section = t_i.period
UNION ALL
SELECT s_o.period, 'store', s_o.source,
       CAST(row_number() OVER (PARTITION BY s_o.period ORDER BY s_i.first_seq, s_o.source) AS INTEGER),
       CAST(s_o.total_orders AS BIGINT), CAST(s_o.total_sales AS BIGINT), s_o.avg_order_value,
       CAST(s_i.total_items AS BIGINT)
FROM s_o JOIN s_i ON s_o.period = s_i.period AND s_o.source IS NOT DISTINCT FROM s_i.source
WHERE s_o.period IN ('day', 'month'))"""


@query("rpt4_daily_report_dataset", oracle=_RPT4_SQL + "\nSELECT * FROM ds")
def rpt4_daily_report_dataset(spark, sf_dir):
    return RP.daily_report_dataset(star_lines(spark, sf_dir, product=False), _TARGET)


def _yen(x):
    return f"('¥' || format('{{:,.0f}}', CAST({x} AS DOUBLE)))"


def _yoy_sql(cur, prev):
    pct = f"(({cur} - {prev}) * 100.0 / {prev})"
    return (f"CASE WHEN coalesce({prev}, 0) = 0 THEN '前年データなし' ELSE {_yen(prev)} || ' → ' || {_yen(cur)} "
            f"|| '（' || CASE WHEN {cur} - {prev} >= 0 THEN '+' ELSE '' END || format('{{:.1f}}', {pct}) || '%）' END")


_WD = "月火水木金土日"[_TARGET.weekday()]
_M_, _D_ = _TARGET.month, _TARGET.day


@query("rpt5_daily_report_text", oracle=_RPT4_SQL + f""",
dt AS (SELECT * FROM ds WHERE scope = 'total' AND section = 'day'),
mt AS (SELECT * FROM ds WHERE scope = 'total' AND section = 'month'),
ldt AS (SELECT * FROM ds WHERE scope = 'total' AND section = 'ly_day'),
lmt AS (SELECT * FROM ds WHERE scope = 'total' AND section = 'ly_month')
SELECT 0 AS line_no, '[info][title]売上レポート {_TARGET.strftime("%Y/%m/%d")}({_WD})[/title]' AS text
UNION ALL SELECT 1, '■ {_M_}/{_D_}({_WD}) の売上'
UNION ALL SELECT 2, '━━━━━━━━━━━━━━━'
UNION ALL SELECT 3, '【全店舗合計】'
UNION ALL SELECT 4, '  注文件数: ' || total_orders || '件' FROM dt
UNION ALL SELECT 5, '  売上合計: ' || {_yen('total_sales')} FROM dt
UNION ALL SELECT 6, '  客単価:   ' || {_yen('avg_order_value')} FROM dt WHERE total_orders > 0
UNION ALL SELECT 7, '  商品数:   ' || total_items || '個' FROM dt
UNION ALL SELECT 8, '  前年同日比: ' || {_yoy_sql('dt.total_sales', 'ldt.total_sales')} FROM dt, ldt
UNION ALL SELECT 100 + store_rank, '  - ' || source || ': ' || total_orders || '件 / ' || {_yen('total_sales')}
      || CASE WHEN total_orders > 0 THEN ' / 客単価 ' || {_yen('avg_order_value')} ELSE '' END
      FROM ds WHERE scope = 'store' AND section = 'day'
UNION ALL SELECT 10000, ''
UNION ALL SELECT 10001, '■ {_M_}月累計（{_M_}/1〜{_M_}/{_D_}）'
UNION ALL SELECT 10002, '━━━━━━━━━━━━━━━'
UNION ALL SELECT 10003, '【全店舗合計】'
UNION ALL SELECT 10004, '  注文件数: ' || total_orders || '件' FROM mt
UNION ALL SELECT 10005, '  売上合計: ' || {_yen('total_sales')} FROM mt
UNION ALL SELECT 10006, '  前年同期比: ' || {_yoy_sql('mt.total_sales', 'lmt.total_sales')} FROM mt, lmt
UNION ALL SELECT 10100 + store_rank, '  - ' || source || ': ' || total_orders || '件 / ' || {_yen('total_sales')}
      FROM ds WHERE scope = 'store' AND section = 'month'
UNION ALL SELECT 1000000, '[/info]'""")
def rpt5_daily_report_text(spark, sf_dir):
    ds = RP.daily_report_dataset(star_lines(spark, sf_dir, product=False), _TARGET)
    return RP.daily_report_lines(ds, _TARGET)


def _summary_cte(where):
    return f"""
flt AS (SELECT * FROM lines WHERE {where}),
fr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM flt) WHERE rn = 1),
st AS (SELECT (SELECT count(DISTINCT order_number) FROM flt) AS total_orders,
       CAST(coalesce((SELECT sum(order_net_sales) FROM fr), 0) AS BIGINT) AS total_sales,
       CAST(coalesce((SELECT sum(total_price) FROM fr), 0) AS BIGINT) AS gross_sales,
       CAST(coalesce((SELECT sum(quantity) FROM flt), 0) AS BIGINT) AS total_items,
       coalesce((SELECT avg(order_net_sales) FROM fr), 0.0) AS avg_order_value,
       (SELECT min(order_date) FROM flt) AS period_start,
       (SELECT max(order_date) FROM flt) AS period_end)"""


def _ts(d):
    return f"TIMESTAMP '{d.isoformat(sep=' ')}'"


def _window_where(s, e):
    return f"order_datetime >= {_ts(s)} AND order_datetime < {_ts(e)}"


_CLI_START, _CLI_END = "1998-01-01", "1998-12-31"
_CLI_S, _CLI_E = W.cli_range(STAR_AS_OF, start=_CLI_START, end=_CLI_END)


@query("rpt6_cli_summary", oracle=f"""
WITH lines AS ({star_lines_sql(store=False)}), {_summary_cte(_window_where(_CLI_S, _CLI_E))},
g AS (SELECT *, coalesce(nullif(item_number, ''), item_id) AS gk FROM flt),
p AS (SELECT gk, arg_min(item_name, (ingest_seq, line_seq, item_id)) FILTER (WHERE item_name IS NOT NULL) AS item_name,
             sum(quantity) AS quantity, sum(subtotal) AS total_sales
      FROM g WHERE gk IS NOT NULL GROUP BY gk),
top AS (SELECT *, row_number() OVER (ORDER BY total_sales DESC, gk) AS rn FROM p QUALIFY rn <= 5)
SELECT 1 AS line_no, '期間: ' || coalesce(CAST(period_start AS VARCHAR) || ' 00:00:00', 'None') || ' 〜 '
       || coalesce(CAST(period_end AS VARCHAR) || ' 00:00:00', 'None') AS text FROM st
UNION ALL SELECT 2, '総注文数: ' || format('{{:,}}', total_orders) || '件' FROM st
UNION ALL SELECT 3, '総売上: ' || {_yen('total_sales')} FROM st
UNION ALL SELECT 4, '総商品数: ' || format('{{:,}}', total_items) || '個' FROM st
UNION ALL SELECT 5, '平均注文単価: ' || {_yen('avg_order_value')} FROM st
UNION ALL SELECT CAST(10 + rn AS INTEGER), '  ' || item_name || ': ' || {_yen('total_sales')} || ' (' || quantity || '個)'
      FROM top""")
def rpt6_cli_summary(spark, sf_dir):
    from ..operators.filters import time_range
    lines = time_range(star_lines(spark, sf_dir, store=False), _CLI_S, _CLI_E)
    return RP.cli_summary(lines, _CLI_S.date(), _CLI_E.date())


_WK_S, _WK_E = W.last_week(STAR_AS_OF)


@query("rpt7_summary_table", oracle=f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}), {_summary_cte(_window_where(_WK_S, _WK_E))}
SELECT 1 AS row_no, '集計期間' AS "項目", coalesce(CAST(period_start AS VARCHAR) || ' 00:00:00', '-') || ' 〜 '
       || coalesce(CAST(period_end AS VARCHAR) || ' 00:00:00', '-') AS "値" FROM st
UNION ALL SELECT 2, '総注文数', CAST(total_orders AS VARCHAR) FROM st
UNION ALL SELECT 3, '総売上', {_yen('total_sales')} FROM st
UNION ALL SELECT 4, '総商品数', CAST(total_items AS VARCHAR) FROM st
UNION ALL SELECT 5, '平均注文単価', {_yen('avg_order_value')} FROM st
UNION ALL SELECT 6, '更新日時', '{_UPDATED.strftime("%Y-%m-%d %H:%M:%S")}'""")
def rpt7_summary_table(spark, sf_dir):
    """RPT7 / RPT10: the weekly job's key/value summary (last 7 days)."""
    jobs = RP.weekly_job(star_lines(spark, sf_dir, product=False, store=False), STAR_AS_OF, _UPDATED)
    return jobs["summary"]


_EXPIRY_AS_OF = dt.date(2001, 10, 20)


@query("rpt8_expiry_status", oracle=f"""
WITH lines AS ({star_lines_sql(product=False)}),
e AS (SELECT source, max(order_date) AS issued_at FROM lines GROUP BY source)
SELECT source, issued_at,
       CAST(datediff('day', {_d(_EXPIRY_AS_OF)}, issued_at + INTERVAL 90 DAY) AS INTEGER) AS days_left,
       CASE WHEN datediff('day', {_d(_EXPIRY_AS_OF)}, issued_at + INTERVAL 90 DAY) <= 0 THEN 'expired'
            WHEN datediff('day', {_d(_EXPIRY_AS_OF)}, issued_at + INTERVAL 90 DAY) <= 14 THEN 'warning'
            ELSE 'ok' END AS status
FROM e""")
def rpt8_expiry_status(spark, sf_dir):
    """RPT8 re-aimed: each store's last order date as the issue date of a 90-day key."""
    lines = star_lines(spark, sf_dir, product=False)
    issued = lines.groupBy("source").agg(F.max("order_date").alias("issued_at"))
    return RP.expiry_status(issued, "issued_at", _EXPIRY_AS_OF)


_DJ_S, _DJ_E = W.previous_day(STAR_AS_OF)


def _daily_sql(where):
    return f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}),
flt AS (SELECT * FROM lines WHERE {where}),
fr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number
       ORDER BY ingest_seq, line_seq, item_id) AS rn FROM flt) WHERE rn = 1),
d AS (SELECT order_date AS date, count(order_number) AS order_count,
      CAST(sum(order_net_sales) AS BIGINT) AS total_sales, CAST(sum(total_price) AS BIGINT) AS gross_sales,
      CAST(sum(coupon_used) AS BIGINT) AS coupon_total FROM fr WHERE order_date IS NOT NULL GROUP BY 1),
i AS (SELECT order_date AS date, CAST(sum(quantity) AS BIGINT) AS item_count FROM flt
      WHERE order_date IS NOT NULL GROUP BY 1)
SELECT d.date, order_count, total_sales, gross_sales, coupon_total, item_count
FROM d LEFT JOIN i ON d.date = i.date"""


@query("rpt9_daily_job", oracle=_daily_sql(_window_where(_DJ_S, _DJ_E)))
def rpt9_daily_job(spark, sf_dir):
    return RP.daily_job(star_lines(spark, sf_dir, product=False, store=False), STAR_AS_OF)


@query("rpt10_weekly_daily", oracle=_daily_sql(_window_where(_WK_S, _WK_E)))
def rpt10_weekly_daily(spark, sf_dir):
    jobs = RP.weekly_job(star_lines(spark, sf_dir, product=False, store=False), STAR_AS_OF, _UPDATED)
    return jobs["daily"]


_MJ_S, _MJ_E = W.previous_month(STAR_AS_OF)


@query("rpt11_monthly_job_stats", oracle=f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}), {_summary_cte(_window_where(_MJ_S, _MJ_E))}
SELECT * FROM st""")
def rpt11_monthly_job_stats(spark, sf_dir):
    return RP.monthly_job(star_lines(spark, sf_dir, product=False, store=False), STAR_AS_OF)["stats"]


@query("rpt12_full_run_stats", oracle=f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}), {_summary_cte(_window_where(_CLI_S, _CLI_E))}
SELECT * FROM st""")
def rpt12_full_run_stats(spark, sf_dir):
    run = RP.full_run(star_lines(spark, sf_dir, product=False, store=False), _CLI_START, _CLI_END, STAR_AS_OF)
    return run["stats"]


# ------------------------------------------------------------------ FLT13-15
_PRESETS = [W.preset(n, STAR_AS_OF) for n in ("this_month", "last_7_days", "last_30_days")]


@query("flt13_period_presets", oracle=f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}),
{_tagged_sql([(p.name, p.start, p.end) for p in _PRESETS])}, {_kpi_sql(['period'])}
SELECT s.period, CAST(s.sales AS BIGINT) AS sales, CAST(s.orders AS BIGINT) AS orders,
       CAST(i.items AS BIGINT) AS items
FROM s JOIN i ON s.period = i.period""")
def flt13_period_presets(spark, sf_dir):
    """FLT13: this month / last 7 / last 30 days KPIs from one scan."""
    t = RP.tag_periods(star_lines(spark, sf_dir, product=False, store=False), _PRESETS)
    k = RP.kpi_by(t, ("period",))
    return k.select("period", F.col("sales").cast("bigint"), F.col("orders").cast("bigint"),
                    F.col("items").cast("bigint"))


_LEAP = dt.date(2000, 3, 1)   # yesterday = 29 February 2000: no year-ago day (D5)


@query("flt15_leap_day_yoy", oracle=f"""
WITH lines AS ({star_lines_sql(product=False, store=False)}),
{_tagged_sql([('yesterday', dt.date(2000, 2, 29), dt.date(2000, 2, 29))])}, {_kpi_sql(['period'])}
SELECT 'yesterday' AS period, DATE '2000-02-29' AS start, DATE '2000-02-29' AS "end",
       CAST(coalesce(s.sales, 0) AS BIGINT) AS sales, CAST(coalesce(s.orders, 0) AS BIGINT) AS orders,
       CAST(coalesce(i.items, 0) AS BIGINT) AS items, CAST(0 AS BIGINT) AS ly_sales,
       CAST(0 AS BIGINT) AS ly_orders, CAST(0 AS BIGINT) AS ly_items, CAST(0 AS BIGINT) AS diff,
       CAST(0.0 AS DOUBLE) AS rate, CAST(coalesce(s.sales, 0) AS DOUBLE) AS daily_average
FROM (SELECT 1) x LEFT JOIN s ON TRUE LEFT JOIN i ON TRUE""")
def flt15_leap_day_yoy(spark, sf_dir):
    """FLT15/D5: the panel for 29 February has no year-ago comparison (zeros, no error)."""
    return RP.yoy_panel(star_lines(spark, sf_dir, product=False, store=False), _LEAP).filter(
        F.col("period") == "yesterday")
