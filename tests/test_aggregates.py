"""Aggregates on hand-written order lines (F5) and the semantics ledger rows."""

import datetime as dt

from order_lines import lines_df
from mallsight.operators import aggregates as A
from mallsight.operators.grain import STORE_KEY
from mallsight.plans import reports as RP

T = dt.datetime


def _line(num, when, qty=1, net=1000, total=1100, coupon=100, seq=0, line=0, store="S1", **kw):
    d = dict(order_number=num, order_datetime=when, quantity=qty, order_net_sales=net, total_price=total,
             coupon_used=coupon, ingest_seq=seq, line_seq=line, source=store, mall="R", item_id=kw.pop("item_id", "i"),
             item_name=kw.pop("item_name", "n"), item_number=kw.pop("item_number", ""), subtotal=kw.pop("subtotal", 10),
             unit_price=10)
    d.update(kw)
    return d


def test_money_once_quantity_per_line(spark):
    df = lines_df(spark, [_line("A", T(2024, 1, 15, 10), qty=2, line=0), _line("A", T(2024, 1, 15, 10), qty=3, line=1),
                          _line("B", T(2024, 1, 16, 9), qty=1, seq=1)])
    rows = {r.date: r for r in A.daily_sales(df).collect()}
    a = rows[dt.date(2024, 1, 15)]
    assert (a.order_count, a.total_sales, a.gross_sales, a.coupon_total, a.item_count) == (1, 1000, 1100, 100, 5)
    s = A.summary_stats(df).first()
    assert (s.total_orders, s.total_sales, s.total_items, s.avg_order_value) == (2, 2000, 6, 1000.0)


def test_empty_input_full_schema(spark):
    df = lines_df(spark, [])
    assert A.daily_sales(df).columns == ["date", "order_count", "total_sales", "gross_sales", "coupon_total",
                                         "item_count"]
    assert A.daily_sales(df).count() == 0
    s = A.summary_stats(df).first()
    assert (s.total_orders, s.total_sales, s.total_items, s.avg_order_value, s.period_start) == (0, 0, 0, 0.0, None)
    assert A.hour_weekday_heatmap(df).columns == ["order_hour", "月", "火", "水", "木", "金", "土", "日"]


def test_null_date_dropped_from_daily_kept_in_summary(spark):
    df = lines_df(spark, [_line("A", None, net=500), _line("B", T(2024, 1, 15, 10), seq=1)])
    assert [r.order_count for r in A.daily_sales(df).collect()] == [1]
    s = A.summary_stats(df).first()
    assert s.total_orders == 2 and s.total_sales == 1500


def test_dedup_first_document_and_store_key(spark):
    # same number in two stores (D1): the default key merges them, the store key keeps both
    df = lines_df(spark, [_line("X", T(2024, 1, 15, 10), net=100, seq=0, store="S1"),
                          _line("X", T(2024, 1, 15, 11), net=900, seq=1, store="S2")])
    assert A.daily_sales(df).first().total_sales == 100
    assert A.daily_sales(df, key=STORE_KEY).first().total_sales == 1000
    per = {r.source: r for r in A.total_and_store_stats(df).collect() if r.scope == "store"}
    assert per["S1"].total_sales == 100 and per["S2"].total_sales == 900


def test_product_first_name_and_key(spark):
    df = lines_df(spark, [
        _line("A", T(2024, 1, 15), item_number="SKU1", item_name="Old", item_id="1", subtotal=50, seq=0),
        _line("B", T(2024, 1, 16), item_number="SKU1", item_name="New", item_id="2", subtotal=70, seq=1),
        _line("C", T(2024, 1, 16), item_number="", item_name="Z", item_id="9", subtotal=10, seq=2),
        _line("D", T(2024, 1, 16), item_number=None, item_name=None, item_id="9", subtotal=5, seq=3)])
    rows = A.product_sales_sorted(df).collect()
    assert rows[0].item_name == "Old" and rows[0].total_sales == 120 and rows[0].order_count == 2
    assert rows[0].item_id == "1"
    assert rows[1].item_name == "Z" and rows[1].total_sales == 15 and rows[1].item_number == ""


def test_heatmap_zero_fill(spark):
    df = lines_df(spark, [_line("A", T(2024, 1, 15, 10), net=7)])   # a Monday
    r = A.hour_weekday_heatmap(df).collect()
    assert len(r) == 1 and r[0].order_hour == 10 and r[0]["月"] == 7 and r[0]["日"] == 0


def test_store_panel_zero_rows_and_year_ago(spark):
    df = lines_df(spark, [_line("A", T(2024, 1, 15, 10), net=1200, store="S1"),
                          _line("B", T(2023, 1, 15, 10), net=1000, store="S1", seq=1)])
    out = {(r.source, r.period): r for r in RP.store_yoy_panel(df, dt.date(2024, 1, 16), ["S1", "S9"]).collect()}
    y = out[("S1", "yesterday")]
    assert y.sales == 1200 and y.ly_sales == 1000 and y.diff == 200 and abs(y.rate - 20.0) < 1e-9
    z = out[("S9", "month_to_date")]
    assert z.sales == 0 and z.orders == 0 and z.rate == 0.0


def test_leap_day_has_no_year_ago(spark):
    df = lines_df(spark, [_line("A", T(2024, 2, 29, 10))])
    r = [x for x in RP.yoy_panel(df, dt.date(2024, 3, 1)).collect() if x.period == "yesterday"][0]
    assert r.sales == 1000 and r.ly_sales == 0 and r.rate == 0.0


def test_day_store_pivot_total_configured_only(spark):
    df = lines_df(spark, [_line("A", T(2024, 1, 15), net=10, store="S1"),
                          _line("B", T(2024, 1, 15), net=20, store="S2", seq=1),
                          _line("C", T(2024, 1, 16), net=40, store="S3", seq=2)])
    rows = {r.date: r for r in A.day_store_pivot(df, ["S1", "S2"]).collect()}
    assert rows[dt.date(2024, 1, 15)]["合計 売上"] == 30 and rows[dt.date(2024, 1, 16)]["合計 売上"] == 0
