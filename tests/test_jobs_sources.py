"""Job runners (RPT9-RPT12), encoding fallback (SRC13), saved CSV imports (SRC14), named tables (SRC16)."""

import datetime as dt
import json

from order_lines import lines_df
from mallsight import sinks as S
from mallsight.plans import jobs as J
from mallsight.sinks.published import read_published
from mallsight.sources import csv_export as C
from mallsight.sources.readers import R_ORDER_LANDED, read_table_or_empty

T = dt.datetime


def _lines(spark):
    rows = []
    for i, day in enumerate([14, 15, 15, 20]):
        rows.append(dict(order_number=f"o{i}", order_datetime=T(2024, 5, day, 10), quantity=2, order_net_sales=100,
                         total_price=110, coupon_used=10, ingest_seq=i, line_seq=0, source="S1", mall="R",
                         item_id=f"i{i}", item_name=f"n{i}", item_number="", subtotal=50, unit_price=25))
    return lines_df(spark, rows)


def _docs(spark):
    docs = [{"orderNumber": f"o{i}", "orderDatetime": f"2024-05-{d:02d}T10:00:00+0900", "_ingest_seq": i}
            for i, d in enumerate([14, 15, 15, 20])]
    return spark.read.schema(R_ORDER_LANDED).json(spark.sparkContext.parallelize([json.dumps(x) for x in docs]))


def test_daily_job_appends_and_saves_raw(spark, tmp_path):
    table = str(tmp_path / "daily")
    assert J.run_daily_job(_lines(spark), dt.date(2024, 5, 16), table, _docs(spark), str(tmp_path / "raw"))
    assert not J.run_daily_job(_lines(spark), dt.date(2024, 5, 2), table)          # empty day: no-op
    assert J.run_daily_job(_lines(spark), dt.date(2024, 5, 16), table)             # again: the day's row is replaced
    rows = read_published(spark, table, S.ROWS).collect()
    assert [(r.date, r.order_count, r.item_count) for r in rows] == [("2024-05-15", 2, 4)]
    raw = spark.read.json(str(tmp_path / "raw" / "orders_20240516_000000"))
    assert sorted(r.orderNumber for r in raw.collect()) == ["o1", "o2"]


def test_weekly_monthly_full(spark, tmp_path):
    lines = _lines(spark)
    written = J.run_weekly_job(lines, dt.date(2024, 5, 21), str(tmp_path / "tables"), T(2024, 5, 21, 7))
    assert all(written.values())
    stats = J.run_monthly_job(lines, dt.date(2024, 6, 3), str(tmp_path / "monthly"), _docs(spark)).first()
    assert stats.total_orders == 4 and stats.total_sales == 400
    assert spark.read.option("header", True).csv(str(tmp_path / "monthly" / "sales_202405")).count() == 4
    text = [r.text for r in J.run_full(lines, "2024-05-01", "2024-05-31", dt.date(2024, 6, 1),
                                       str(tmp_path / "full"), str(tmp_path / "full_tables")).collect()]
    assert text[0] == "期間: 2024-05-14 00:00:00 〜 2024-05-20 00:00:00" and text[2] == "総売上: ¥400"


def test_encoding_fallback_to_utf8(spark, tmp_path):
    p = tmp_path / "u.csv"
    p.write_bytes("注文ID,注文日,商品名\nA,2024-01-15,ペン\n".encode("utf-8") + b"B,2024-01-16,x\xff\n")
    rows = {r.order_number: r for r in C.parse_order_csv(spark, str(p), "windows-31j").collect()}
    assert rows["A"].item_name == "ペン" and rows["B"].item_name == "x"


def test_saved_csv_imports_glob_and_keep_last(spark, tmp_path):
    root = str(tmp_path / "saved")
    a = tmp_path / "a.csv"
    a.write_text("注文ID,注文日,商品名,数量\nO1,2024-01-10,x,1\nO2,2024-01-11,y,1\n", "utf-8")
    b = tmp_path / "b.csv"
    b.write_text("注文ID,注文日,商品名,数量\nO1,2024-01-10,x,7\n", "utf-8")
    C.save_import_csv(C.parse_order_csv(spark, str(a), "UTF-8"), root, "20240110_090000")
    C.save_import_csv(C.parse_order_csv(spark, str(b), "UTF-8"), root, "20240111_090000")
    (tmp_path / "saved" / "notes.txt").write_text("not an import")
    rows = {r.order_number: r for r in C.load_saved_csv(spark, root).collect()}
    assert rows["O1"].quantity == 7 and rows["O2"].quantity == 1
    assert C.load_saved_csv(spark, str(tmp_path / "missing")).count() == 0


def test_named_table_or_empty(spark):
    from mallsight.schema import STORE
    df = read_table_or_empty(spark, "no_such_table_here", STORE)
    assert df.count() == 0 and df.columns == ["name", "store_seq"]
    spark.createDataFrame([("S1", 0)], STORE).write.mode("overwrite").saveAsTable("stores_t")
    assert read_table_or_empty(spark, "stores_t", STORE).count() == 1
