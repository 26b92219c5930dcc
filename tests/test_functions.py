"""Scalar functions FN1-FN19 on hand-written values."""

import datetime as dt

from pyspark.sql import functions as F

from mallsight.functions import (clean_int, compact_yen, delta, parse_compact_time, parse_lenient_time,
                                 parse_offset_time, short_name, signed_pct, weekday_name, year_ago, yen,
                                 yoy_text)
from mallsight.functions.time import ntz, with_time_parts


def one(spark, expr, rows, schema="s string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_offset_times_to_jst(spark):
    got = one(spark, parse_offset_time("s"), [("2024-01-15T10:30:00+0900",), ("2024-01-15T10:30:00+09:00",),
                                               ("2024-01-15T01:30:00Z",), ("2024-01-15T23:30:00Z",),
                                               ("2024-01-15T10:30:00",), ("bad",), ("",), (None,)])
    assert got[:5] == [dt.datetime(2024, 1, 15, 10, 30)] * 3 + [dt.datetime(2024, 1, 16, 8, 30),
                                                                  dt.datetime(2024, 1, 15, 10, 30)]
    assert got[5:] == [None, None, None]


def test_offset_times_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert one(spark, parse_offset_time("s"), [("2024-03-10T02:30:00Z",)]) == \
                [dt.datetime(2024, 3, 10, 11, 30)]
            assert one(spark, parse_compact_time("s"), [("20240310023000",)]) == [dt.datetime(2024, 3, 10, 2, 30)]
            df = spark.createDataFrame([("2024-03-10T02:30:00",)], "s string").select(
                parse_offset_time("s").alias("order_datetime"))
            r = with_time_parts(df).first()
            assert (r.order_date, r.order_hour, r.order_month, r.order_weekday) == \
                (dt.date(2024, 3, 10), 2, "2024-03", 6)
            assert one(spark, ntz(dt.datetime(2024, 3, 10, 2, 30)), [("x",)]) == [dt.datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_compact_and_lenient(spark):
    assert one(spark, parse_compact_time("s"), [("20240115103000123",), ("2024011",), ("abc",)]) == \
        [dt.datetime(2024, 1, 15, 10, 30), None, None]
    assert one(spark, parse_lenient_time("s"), [("2024/01/15 10:30:00",), ("2024-01-15",), ("15 Jan",)]) == \
        [dt.datetime(2024, 1, 15, 10, 30), dt.datetime(2024, 1, 15), None]


def test_weekday_and_year_ago(spark):
    assert one(spark, weekday_name("w"), [(0,), (6,), (None,), (7,)], "w int") == ["月", "日", None, None]
    assert one(spark, year_ago("d"), [(dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),)], "d date") == \
        [None, dt.date(2023, 3, 1)]


def test_clean_int(spark):
    got = one(spark, clean_int("s"), [("1,200",), ("12.7",), ("-12.7",), ("nan",), ("",), (None,), ("inf",),
                                      ("abc",)])
    assert got == [1200, 12, -12, 0, 0, 0, 0, 0]


def test_money_text(spark):
    assert one(spark, yen("x"), [(1234567,), (0,), (-5,)], "x bigint") == ["¥1,234,567", "¥0", "¥-5"]
    assert one(spark, yen("x"), [(2.5,), (3.5,)], "x double") == ["¥2", "¥4"]   # half-even
    assert one(spark, compact_yen("x"), [(1_500_000,), (12_345,), (999,)], "x bigint") == \
        ["¥1.5M", "¥12K", "¥999"]
    assert one(spark, signed_pct("x"), [(12.34,), (-5.0,), (0.0,)], "x double") == ["+12.3%", "-5.0%", "+0.0%"]
    assert one(spark, short_name("s"), [("a" * 40,), ("ab",)]) == ["a" * 30 + "...", "ab..."]


def test_yoy_and_delta(spark):
    df = spark.createDataFrame([(1200, 1000), (900, 1000), (5, 0), (5, None)], "c bigint, p bigint")
    got = df.select(yoy_text("c", "p").alias("t"), *[x.alias(n) for x, n in zip(delta("c", "p"), "dr")]).collect()
    assert got[0].t == "¥1,000 → ¥1,200（+20.0%）" and got[0].d == 200 and abs(got[0].r - 20.0) < 1e-9
    assert got[1].t == "¥1,000 → ¥900（-10.0%）"
    assert got[2].t == got[3].t == "前年データなし" and got[2].d == 0 and got[2].r == 0.0


def test_no_python_udfs_in_functions(spark):
    df = spark.createDataFrame([("2024-01-15T10:30:00+0900", "1,200")], "s string, n string")
    plan = df.select(parse_offset_time("s"), clean_int("n"), yen(clean_int("n")))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None


def test_strict_iso_date(spark):
    from mallsight.functions.time import parse_iso_date
    assert one(spark, parse_iso_date("s"), [("2024-01-31",), ("2024-02-30",), ("2024/01/31",), ("",)]) == \
        [dt.date(2024, 1, 31), None, None, None]
