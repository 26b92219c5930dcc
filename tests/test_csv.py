"""CSV exports (F4): encodings, header aliases, number cleaning, import dataset keep-last."""

import datetime as dt

import pytest

from mallsight.sources import csv_export as C


def _write(path, text, encoding):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_cp932_japanese_headers(spark, tmp_path):
    text = ("注文ID,注文日時,商品名,数量,単価,小計,合計金額,ポイント利用,クーポン割引\n"
            'A1,2024/01/15 10:30:00,商品①,2,"1,200","2,400","3,000",100,200\n'
            "A2,bad date,x,nan,12.7,,,,\n")
    p = _write(tmp_path / "e.csv", text, "cp932")
    rows = {r.order_number: r for r in C.parse_order_csv(spark, p, "windows-31j").collect()}
    a = rows["A1"]
    assert a.item_name == "商品①" and a.unit_price == 1200 and a.subtotal == 2400
    assert a.order_net_sales == 3000 - 100 - 200 and a.order_date == dt.datetime(2024, 1, 15, 10, 30)
    b = rows["A2"]
    assert b.order_date is None and b.quantity == 0 and b.unit_price == 12 and b.subtotal == 0


def test_utf8_bom_english_and_absent_columns(spark, tmp_path):
    text = "﻿OrderId,OrderTime,UnitPrice,Quantity\nB1,2024-01-15,500,3\n"
    p = _write(tmp_path / "e.csv", text, "utf-8")
    r = C.parse_order_csv(spark, p, "UTF-8").first()
    assert r.order_number == "B1" and r.item_name == "不明"
    assert r.subtotal == 1500 and r.total_price is None and r.order_net_sales == 1500


def test_absent_quantity_is_one(spark, tmp_path):
    p = _write(tmp_path / "e.csv", "注文ID,注文日,単価\nC1,2024-01-15,700\n", "utf-8")
    r = C.parse_order_csv(spark, p, "UTF-8").first()
    assert r.quantity == 1 and r.subtotal == 700


def test_two_aliases_first_present_wins(spark, tmp_path):
    p = _write(tmp_path / "e.csv", "注文ID,OrderId,注文日\n,X9,2024-01-15\nY1,Y2,2024-01-15\n", "utf-8")
    got = sorted(r.order_number for r in C.parse_order_csv(spark, p, "UTF-8").collect())
    assert got == ["X9", "Y1"]


def test_missing_required_column(spark, tmp_path):
    p = _write(tmp_path / "e.csv", "商品名,数量\na,1\n", "utf-8")
    with pytest.raises(ValueError):
        C.parse_order_csv(spark, p, "UTF-8")


def test_incomplete_files_are_reported_and_skipped(spark, tmp_path):
    for name, text in (("a", "注文ID,注文日,商品名\nO1,2024-01-10,x\n"), ("b", "商品名,注文ID\ny,O2\nz,O3\n"), ("c", "商品名\n"), ("d", "")):
        _write(tmp_path / f"{name}.csv", text, "utf-8")
    rows = {r.file.rsplit("/", 1)[1]: (r.missing, r.n_records) for r in C.required_columns(spark, str(tmp_path), "UTF-8").collect()}
    assert rows["a.csv"] == ([], 1) and rows["b.csv"] == (["order_date"], 2)
    assert rows["c.csv"] == (["order_number", "order_date"], 0)
    assert [r.order_number for r in C.parse_order_csv(spark, str(tmp_path), "UTF-8", skip_incomplete=True).collect()] == ["O1"]


def test_import_dataset_keep_last(spark, tmp_path):
    root = str(tmp_path / "imports")
    first = _write(tmp_path / "a.csv", "注文ID,注文日,商品名,数量\nO1,2024-01-10,x,1\nO1,2024-01-10,x,2\n"
                                       "O2,2024-01-11,y,1\n", "utf-8")
    second = _write(tmp_path / "b.csv", "注文ID,注文日,商品名,数量\nO1,2024-01-10,x,5\n", "utf-8")
    C.save_imports(C.as_import(C.parse_order_csv(spark, first, "UTF-8"), "20240110_000000"), root)
    C.save_imports(C.as_import(C.parse_order_csv(spark, second, "UTF-8"), "20240111_000000"), root)
    rows = {r.order_number: r for r in C.load_saved_imports(spark, root).collect()}
    assert rows["O1"].quantity == 5 and rows["O2"].quantity == 1
    only = C.load_saved_imports(spark, root, start=dt.datetime(2024, 1, 11))
    assert [r.order_number for r in only.collect()] == ["O2"]
    assert C.load_saved_imports(spark, str(tmp_path / "none")).count() == 0
