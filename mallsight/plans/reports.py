"""Composite reports (RPT1-RPT12) built from the aggregate operators.

Period comparisons use one scan: every line is tagged with the periods it
falls in (an array of at most four labels, exploded), and one aggregation
groups by (period, ...).  Deduplication runs inside each period, exactly as
filtering each period separately would, without re-reading the input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import delta, yen, yoy_text
from ..functions.time import WEEKDAY_NAMES, ntz
from ..operators import aggregates as A
from ..operators.filters import time_range
from ..operators.grain import DEFAULT_KEY
from . import windows as W


def within_periods(lines: DataFrame, periods) -> DataFrame:
    """Keep lines whose order time falls in any of the periods.

    Written on ``order_datetime`` as half-open day ranges so the predicate is
    pushed into the scan (row-group skipping; partition pruning on
    date-partitioned tables) before any tagging happens.
    """
    t = F.col("order_datetime")
    cond = None
    for p in periods:
        if p is None:
            continue
        c = (t >= ntz(p.start)) & (t < ntz(p.end + dt.timedelta(days=1)))
        cond = c if cond is None else (cond | c)
    return lines.filter(cond) if cond is not None else lines


def tag_periods(lines: DataFrame, periods: list[W.Period], date_col: str = "order_date") -> DataFrame:
    """Lines -> (period, line) for every period whose inclusive date range holds the line."""
    d = F.col(date_col)
    labels = [F.when(d.between(F.lit(p.start), F.lit(p.end)), F.lit(p.name)) for p in periods if p]
    return (within_periods(lines, periods)
            .withColumn("period", F.explode(F.filter(F.array(*labels), lambda x: x.isNotNull()))))


def kpi_by(tagged: DataFrame, group, key=DEFAULT_KEY) -> DataFrame:
    """sales / orders (deduplicated inside each group) and items per group."""
    k = tuple(dict.fromkeys((*group, *key)))
    per = A.orders_with_lines(tagged, k, money=("order_net_sales",))
    return per.groupBy(*group).agg(F.sum("order_net_sales").alias("sales"),
                                   F.count(F.lit(1)).alias("orders"),
                                   F.sum("_items").alias("items"))


def _periods(as_of: dt.date):
    y, m = W.yesterday(as_of), W.month_to_date(as_of)
    return y, m, W.year_ago_period(y), W.year_ago_period(m)


def _fill(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def tag_yoy(lines: DataFrame, pairs, date_col: str = "order_date") -> DataFrame:
    """Lines -> (period, ly, line): each current period and its year-ago twin share a name.

    ``pairs`` is [(current Period, year-ago Period or None)]; a line can fall in
    several periods (yesterday lies inside month-to-date), hence the explode.
    """
    d = F.col(date_col)
    tags = []
    for cur, ly in pairs:
        for p, flag in ((cur, False), (ly, True)):
            if p is not None:
                tags.append(F.when(d.between(F.lit(p.start), F.lit(p.end)),
                                   F.struct(F.lit(cur.name).alias("period"), F.lit(flag).alias("ly"))))
    t = within_periods(lines, [p for pair in pairs for p in pair]).withColumn(
        "_tag", F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())))
    return t.withColumn("period", F.col("_tag.period")).withColumn("ly", F.col("_tag.ly")).drop("_tag")


def _side_by_side(stats: DataFrame, group) -> DataFrame:
    """(group, period, ly) KPIs -> one row per (group, period) with this year and last year."""
    def pick(c, ly):
        return F.max(F.when(F.col("ly") == ly, F.col(c)))
    return stats.groupBy(*group, "period").agg(
        pick("sales", False).alias("sales"), pick("orders", False).alias("orders"),
        pick("items", False).alias("items"), pick("sales", True).alias("ly_sales"),
        pick("orders", True).alias("ly_orders"), pick("items", True).alias("ly_items"))


def yoy_panel(lines: DataFrame, as_of: dt.date, key=DEFAULT_KEY) -> DataFrame:
    """RPT1: yesterday and month-to-date vs the same periods a year earlier (total).

    One scan, one aggregation by (period, ly), a conditional pivot of ``ly``.
    Columns: period, start, end, sales, orders, items, ly_sales, ly_orders,
    ly_items, diff, rate (0 when last year is 0 or absent), daily_average.
    """
    y, m, ly, lm = _periods(as_of)
    stats = _side_by_side(kpi_by(tag_yoy(lines, [(y, ly), (m, lm)]), ("period", "ly"), key), ())
    frame = lines.sparkSession.createDataFrame(
        [(p.name, p.start, p.end, p.days) for p in (y, m)],
        "period string, start date, end date, days int")
    out = _fill(frame.join(stats, "period", "left"),
                {"sales", "orders", "items", "ly_sales", "ly_orders", "ly_items"})
    diff, rate = delta("sales", "ly_sales")
    return out.select("period", "start", "end", "sales", "orders", "items", "ly_sales", "ly_orders",
                      "ly_items", diff.cast("bigint").alias("diff"), rate.alias("rate"),
                      A.average_over(F.col("sales"), F.col("days")).alias("daily_average"))


def store_yoy_panel(lines: DataFrame, as_of: dt.date, stores, key=DEFAULT_KEY) -> DataFrame:
    """RPT2 (+JON3, JON5): per configured store: yesterday / month-to-date vs a year earlier.

    Every configured store appears (zeros when it has no rows); deduplication is
    inside each store.
    """
    y, m, ly, lm = _periods(as_of)
    tagged = tag_yoy(lines.filter(F.col("source").isin(list(stores))), [(y, ly), (m, lm)])
    stats = _side_by_side(kpi_by(tagged, ("source", "period", "ly"), key), ("source",))
    frame = lines.sparkSession.createDataFrame(
        [(s, i, p.name, p.days) for i, s in enumerate(stores) for p in (y, m)],
        "source string, store_seq int, period string, days int")
    out = _fill(frame.join(stats, ["source", "period"], "left"),
                {"sales", "orders", "items", "ly_sales", "ly_orders"})
    diff, rate = delta("sales", "ly_sales")
    return out.select("source", "store_seq", "period", "sales", "orders", "ly_sales", "ly_orders",
                      diff.cast("bigint").alias("diff"), rate.alias("rate"),
                      A.average_over(F.col("sales"), F.col("days")).alias("daily_average"))


def mall_kpi(lines: DataFrame, as_of: dt.date, malls, key=DEFAULT_KEY) -> DataFrame:
    """RPT3 (D11): yesterday and month-to-date sales / orders per mall (zeros for absent malls)."""
    y, m, _, _ = _periods(as_of)
    tagged = tag_periods(lines.filter(F.col("mall").isin(list(malls))), [y, m])
    stats = kpi_by(tagged, ("mall", "period"), key)
    frame = lines.sparkSession.createDataFrame(
        [(mall, p.name) for mall in malls for p in (y, m)], "mall string, period string")
    out = frame.join(stats, ["mall", "period"], "left")
    return _fill(out.select("mall", "period", "sales", "orders"), {"sales", "orders"})


# ---------------------------------------------------------------------------
# RPT4 / RPT5: daily report
# ---------------------------------------------------------------------------
def report_periods(target: dt.date):
    """Windows of the daily report: day, month-to-day, and year-ago twins (None on 29 Feb)."""
    day = W.Period("day", target, target)
    month = W.Period("month", target.replace(day=1), target)
    ly = W.year_ago(target)
    ly_day = W.Period("ly_day", ly, ly) if ly else None
    ly_month = W.Period("ly_month", ly.replace(day=1), ly) if ly else None
    return day, month, ly_day, ly_month


def daily_report_dataset(lines: DataFrame, target: dt.date, key=DEFAULT_KEY) -> DataFrame:
    """RPT4 (AGG14 x 4 periods): one row per (section, scope, source).

    scope 'total' deduplicates across stores, scope 'store' inside each store.
    Year-ago sections carry totals only.  Store rows list the stores seen in the
    period, ordered by first appearance (store_rank).
    """
    day, month, ly_day, ly_month = report_periods(target)
    periods = [p for p in (day, month, ly_day, ly_month) if p]
    tagged = tag_periods(lines, periods).withColumnRenamed("period", "section")

    # one state for each order, store and section; both scopes roll up from it in one pass
    numbers = tuple(k for k in dict.fromkeys((*key, "order_number")) if k != "source")
    cells = tagged.groupBy("section", "source", *numbers).agg(
        F.min("ingest_seq").alias("seq"), F.min_by("order_net_sales", "ingest_seq").alias("net"), F.sum("quantity").alias("items"))

    def first_of(columns):
        return F.row_number().over(Window.partitionBy("section", *columns).orderBy("seq", "source")) == 1
    cells = cells.withColumn("_paid", first_of(key)).withColumn("_counted", first_of(("order_number",)))

    def state(scope, source, paid, counted):
        net = F.when(paid, F.col("net"))
        return F.struct(F.lit(scope).alias("scope"), source.alias("source"), F.when(counted & F.col("order_number").isNotNull(), 1).otherwise(0).alias("orders"),
                        net.alias("net"), net.isNotNull().cast("int").alias("paid"), F.col("items").alias("items"), F.col("seq").alias("seq"))
    none = F.lit(None).cast("string")
    states = cells.select("section", F.explode(F.array(state("total", none, F.col("_paid"), F.col("_counted")),
                                                       state("store", F.col("source"), F.lit(True), F.lit(True)))).alias("s")).select("section", "s.*")
    # every section appears in the total scope, zero-filled (missing year-ago -> zeros)
    frame = lines.sparkSession.createDataFrame([(p.name,) for p in periods], "section string")
    rows = (states.filter((F.col("scope") == "total") | F.col("section").isin("day", "month"))
            .unionByName(frame.select("section", F.lit("total").alias("scope")), allowMissingColumns=True)
            .groupBy("section", "scope", "source").agg(
                F.sum("orders").alias("total_orders"), F.sum("net").alias("total_sales"), F.sum("items").alias("total_items"),
                F.try_divide(F.sum("net").cast("double"), F.sum("paid")).alias("avg_order_value"), F.min("seq").alias("first_seq")))
    rank = F.when(F.col("scope") == "store", F.row_number().over(
        Window.partitionBy("section", "scope").orderBy("first_seq", "source")))
    return rows.select(
        "section", "scope", "source", rank.alias("store_rank"),
        F.coalesce("total_orders", F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce("total_sales", F.lit(0)).cast("bigint").alias("total_sales"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        F.coalesce("total_items", F.lit(0)).cast("bigint").alias("total_items"))


# Daily report wording.
RPT_TITLE = "[info][title]売上レポート {date}[/title]"
RPT_RULE = "━━━━━━━━━━━━━━━"
RPT_ALL = "【全店舗合計】"
RPT_END = "[/info]"


def _yoy_line(dataset: DataFrame, cur: str, prev: str, line_no: int, label: str) -> DataFrame:
    """One comparison line from the two total rows of the dataset (no join)."""
    totals = dataset.filter((F.col("scope") == "total") & F.col("section").isin(cur, prev))
    pair = totals.agg(F.max(F.when(F.col("section") == cur, F.col("total_sales"))).alias("cur"),
                      F.max(F.when(F.col("section") == prev, F.col("total_sales"))).alias("prev"))
    return pair.select(F.lit(line_no).alias("line_no"), F.concat(F.lit(label), yoy_text("cur", "prev")).alias("text"))


def daily_report_lines(dataset: DataFrame, target: dt.date) -> DataFrame:
    """RPT5: the report as ordered text lines (line_no, text).

    Built from the RPT4 dataset; store lines follow first appearance.  One
    string for posting is ``array_join`` over the sorted lines (small).
    """
    from ..sinks import materialize
    # every line below reads the dataset: write it once (a few dozen rows)
    dataset = materialize(dataset, "report_dataset")
    wd = WEEKDAY_NAMES[target.weekday()]
    m, d = target.month, target.day
    day, month, ly_day, ly_month = report_periods(target)
    t = {r: dataset.filter((F.col("scope") == "total") & (F.col("section") == r)) for r in
         ("day", "month", "ly_day", "ly_month")}

    def fixed(no, text):
        return dataset.sparkSession.createDataFrame([(no, text)], "line_no int, text string")

    parts = [
        fixed(0, RPT_TITLE.format(date=target.strftime("%Y/%m/%d") + f"({wd})")),
        fixed(1, f"■ {m}/{d}({wd}) の売上"), fixed(2, RPT_RULE), fixed(3, RPT_ALL),
        t["day"].select(F.lit(4).alias("line_no"), F.format_string("  注文件数: %d件", "total_orders").alias("text")),
        t["day"].select(F.lit(5).alias("line_no"), F.concat(F.lit("  売上合計: "), yen("total_sales")).alias("text")),
        t["day"].filter(F.col("total_orders") > 0).select(
            F.lit(6).alias("line_no"), F.concat(F.lit("  客単価:   "), yen("avg_order_value")).alias("text")),
        t["day"].select(F.lit(7).alias("line_no"), F.format_string("  商品数:   %d個", "total_items").alias("text")),
    ]
    if ly_day:
        parts.append(_yoy_line(dataset, "day", "ly_day", 8, "  前年同日比: "))
    stores_day = dataset.filter((F.col("scope") == "store") & (F.col("section") == "day"))
    parts.append(stores_day.select(
        (F.lit(100) + F.col("store_rank")).cast("int").alias("line_no"),
        F.concat(F.lit("  - "), F.col("source"), F.lit(": "), F.col("total_orders").cast("string"),
                 F.lit("件 / "), yen("total_sales"),
                 F.when(F.col("total_orders") > 0, F.concat(F.lit(" / 客単価 "), yen("avg_order_value")))
                  .otherwise(F.lit(""))).alias("text")))
    parts += [
        fixed(10_000, ""), fixed(10_001, f"■ {m}月累計（{m}/1〜{m}/{d}）"), fixed(10_002, RPT_RULE),
        fixed(10_003, RPT_ALL),
        t["month"].select(F.lit(10_004).alias("line_no"),
                          F.format_string("  注文件数: %d件", "total_orders").alias("text")),
        t["month"].select(F.lit(10_005).alias("line_no"),
                          F.concat(F.lit("  売上合計: "), yen("total_sales")).alias("text")),
    ]
    if ly_month:
        parts.append(_yoy_line(dataset, "month", "ly_month", 10_006, "  前年同期比: "))
    stores_month = dataset.filter((F.col("scope") == "store") & (F.col("section") == "month"))
    parts.append(stores_month.select(
        (F.lit(10_100) + F.col("store_rank")).cast("int").alias("line_no"),
        F.concat(F.lit("  - "), F.col("source"), F.lit(": "), F.col("total_orders").cast("string"),
                 F.lit("件 / "), yen("total_sales")).alias("text")))
    parts.append(fixed(1_000_000, RPT_END))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_text(lines_df: DataFrame) -> DataFrame:
    """FN19: the report lines joined into one message (bounded: a few dozen lines)."""
    return lines_df.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))),
                                                 lambda x: x.getField("text")), "\n").alias("message"))


# ---------------------------------------------------------------------------
# RPT6 / RPT7: CLI summary and key/value summary table
# ---------------------------------------------------------------------------
def _stamp_text(c: str):
    # dates print as midnight timestamps in the summary texts ('2024-01-15 00:00:00')
    return F.concat(F.col(c).cast("string"), F.lit(" 00:00:00"))


def summary_kv(stats: DataFrame, updated_at: dt.datetime) -> DataFrame:
    """RPT7: six (項目, 値) rows from a one-row AGG9 result; the update time is a parameter."""
    s = stats.select(
        F.concat(F.coalesce(_stamp_text("period_start"), F.lit("None")), F.lit(" 〜 "),
                 F.coalesce(_stamp_text("period_end"), F.lit("None"))).alias("v1"),
        F.col("total_orders").cast("string").alias("v2"), yen("total_sales").alias("v3"),
        F.col("total_items").cast("string").alias("v4"), yen("avg_order_value").alias("v5"),
        F.lit(updated_at.strftime("%Y-%m-%d %H:%M:%S")).alias("v6"))
    return s.select(F.expr("stack(6, 1, '集計期間', v1, 2, '総注文数', v2, 3, '総売上', v3, "
                           "4, '総商品数', v4, 5, '平均注文単価', v5, 6, '更新日時', v6) "
                           "AS (row_no, `項目`, `値`)"))


def cli_summary(lines: DataFrame, start: dt.date, end: dt.date, top_n: int = 5) -> DataFrame:
    """RPT6: the console summary as (line_no, text): period, totals, top products."""
    stats = A.summary_stats(lines)
    head = stats.select(F.expr(
        "stack(5, 1, concat('期間: ', coalesce(concat(cast(period_start as string), ' 00:00:00'), 'None'), "
        "' 〜 ', coalesce(concat(cast(period_end as string), ' 00:00:00'), 'None')), "
        "2, concat('総注文数: ', format_number(total_orders, 0), '件'), "
        "3, concat('総売上: ¥', format_number(cast(total_sales as double), 0)), "
        "4, concat('総商品数: ', format_number(total_items, 0), '個'), "
        "5, concat('平均注文単価: ¥', format_number(avg_order_value, 0))) AS (line_no, text)"))
    top = A.top_products(lines, top_n).withColumn(
        "rn", F.row_number().over(Window.orderBy(F.desc("total_sales"), F.asc(A.product_key()))))
    tops = top.select((F.col("rn") + 10).cast("int").alias("line_no"),
                      F.concat(F.lit("  "), F.col("item_name"), F.lit(": "), yen("total_sales"),
                               F.lit(" ("), F.col("quantity").cast("string"), F.lit("個)")).alias("text"))
    return head.select(F.col("line_no").cast("int"), "text").unionByName(tops)


# ---------------------------------------------------------------------------
# RPT8: expiry classification
# ---------------------------------------------------------------------------
EXPIRY_DAYS = 90      # fixed values: validity after issue and warning horizon (days)
WARN_DAYS = 14


def expiry_status(df: DataFrame, issued_col: str, as_of: dt.date) -> DataFrame:
    """RPT8: days left = issued + 90 - as_of; <= 0 expired, <= 14 warning, else ok."""
    left = F.datediff(F.date_add(F.col(issued_col), EXPIRY_DAYS), F.lit(as_of))
    return df.withColumn("days_left", left).withColumn(
        "status", F.when(left <= 0, F.lit("expired")).when(left <= WARN_DAYS, F.lit("warning"))
                   .otherwise(F.lit("ok")))


# ---------------------------------------------------------------------------
# RPT9-RPT12: scheduled jobs (compute part; sinks in mallsight.sinks)
# ---------------------------------------------------------------------------
def daily_job(lines: DataFrame, as_of: dt.date) -> DataFrame:
    """RPT9: daily totals of the previous day (half-open window)."""
    s, e = W.previous_day(as_of)
    return A.daily_sales(time_range(lines, s, e))


def weekly_job(lines: DataFrame, as_of: dt.date, updated_at: dt.datetime):
    """RPT10: last 7 days -> daily, monthly, top-50 products, key/value summary."""
    s, e = W.last_week(as_of)
    w = time_range(lines, s, e)
    return {"daily": A.daily_sales(w), "monthly": A.monthly_sales(w),
            "products": A.top_products(w, 50), "summary": summary_kv(A.summary_stats(w), updated_at)}


def monthly_job(lines: DataFrame, as_of: dt.date) -> dict:
    """RPT11: previous calendar month -> monthly, products, summary stats."""
    s, e = W.previous_month(as_of)
    w = time_range(lines, s, e)
    return {"lines": w, "monthly": A.monthly_sales(w), "products": A.product_sales_sorted(w),
            "stats": A.summary_stats(w)}


def full_run(lines: DataFrame, start: str, end: str, as_of: dt.date) -> dict:
    """RPT12: CLI range -> daily, monthly, products, hourly, summary."""
    s, e = W.cli_range(as_of, start=start, end=end)
    w = time_range(lines, s, e)
    return {"lines": w, "daily": A.daily_sales(w), "monthly": A.monthly_sales(w),
            "products": A.product_sales_sorted(w), "hourly": A.hourly_sales(w),
            "stats": A.summary_stats(w)}
