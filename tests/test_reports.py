"""Report helpers: message assembly, mall zero fill, expiry thresholds, period presets."""

import datetime as dt

from order_lines import SF_SMALL, lines_df
from mallsight.plans import reports as RP
from mallsight.plans import windows as W
from mallsight.sources.adapters import star_lines


def test_report_message_in_line_order(spark):
    target = dt.date(1998, 6, 15)
    lines = star_lines(spark, SF_SMALL, product=False)
    msg = RP.report_text(RP.daily_report_lines(RP.daily_report_dataset(lines, target), target)).first().message
    rows = msg.split("\n")
    assert rows[0] == "[info][title]売上レポート 1998/06/15(月)[/title]" and rows[-1] == "[/info]"
    assert rows[1] == "■ 6/15(月) の売上" and "■ 6月累計（6/1〜6/15）" in rows


def test_mall_kpi_zero_fill(spark):
    T = dt.datetime
    df = lines_df(spark, [dict(order_number="a", order_datetime=T(2024, 1, 15, 9), order_net_sales=5, quantity=1,
                               ingest_seq=0, line_seq=0, mall="R", source="S")])
    got = {(r.mall, r.period): (r.sales, r.orders) for r in RP.mall_kpi(df, dt.date(2024, 1, 16), ["R", "Y"]).collect()}
    assert got[("R", "yesterday")] == (5, 1) and got[("Y", "month_to_date")] == (0, 0)


def test_expiry_thresholds(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 3, 20),), (dt.date(2024, 6, 1),)], "d date")
    got = [r.status for r in RP.expiry_status(df, "d", dt.date(2024, 6, 10)).orderBy("d").collect()]
    assert got == ["expired", "warning", "ok"]


def test_period_helpers():
    as_of = dt.date(2024, 3, 1)
    assert W.month_to_date(as_of) == W.Period("month_to_date", dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert W.year_ago_period(W.yesterday(as_of)) is None                      # 29 Feb
    assert W.preset("last_7_days", as_of).start == dt.date(2024, 2, 23)
    assert W.cli_range(as_of, start="2024-01-01", end="2024-01-31") == \
        (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
    assert W.previous_month(as_of) == (dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))
