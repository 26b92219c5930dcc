"""Streaming daily totals vs batch, and sink round trips."""

import datetime as dt
import json
import os

import pytest
from order_lines import lines_df
from mallsight import sinks as S
from mallsight.operators import aggregates as A
from mallsight.operators.flatten import flatten_r
from mallsight.sources.readers import read_order_json, read_snapshot
from mallsight.streaming import run_daily_totals
from mallsight.streaming.daily import LateRowsError


def _doc(num, day, units=(1,), seq=0, status=100):
    return {"orderNumber": num, "orderDatetime": f"2024-01-{day:02d}T10:00:00+0900", "orderProgress": status,
            "goodsPrice": 1000, "couponAllTotalPrice": 100, "_ingest_seq": seq,
            "PackageModelList": [{"ItemModelList": [{"itemId": "i", "price": 1, "units": u} for u in units]}]}


def test_stream_matches_batch_on_closed_days(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    docs = [_doc("a", 1, (2, 3)), _doc("b", 1, seq=1), _doc("c", 2, seq=2), _doc("x", 2, status=900, seq=3),
            _doc("d", 5, seq=4), _doc("e", 9, seq=5)]
    (src / "part1.json").write_text("\n".join(json.dumps(d) for d in docs))
    (src / "part2.json").write_text(json.dumps(_doc("a", 1, (2, 3))))       # re-fetched duplicate
    out = run_daily_totals(spark, str(src), str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    got = {r.date: r for r in out.collect()}
    # watermark = 9 Jan 10:00 - 1 day: days up to 7 Jan are closed
    assert sorted(got) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5)]
    d1 = got[dt.date(2024, 1, 1)]
    assert (d1.order_count, d1.total_sales, d1.item_count) == (2, 1800, 6)
    batch = {r.date: r for r in A.daily_sales(flatten_r(read_order_json(spark, str(tmp_path / "landing" / "part1.json"))))
             .collect()}
    for day, r in got.items():
        b = batch[day]
        assert (r.order_count, r.total_sales, r.gross_sales, r.item_count) == \
            (b.order_count, b.total_sales, b.gross_sales, b.item_count)
    # a rerun with the same checkpoint sees no new files and adds nothing
    again = run_daily_totals(spark, str(src), str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    assert again.count() == 3


def test_csv_bom_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "name string, n bigint")
    p = S.write_csv(df, str(tmp_path / "out"))
    raw = "".join(f.read_text("utf-8") for f in (tmp_path / "out").glob("part-*.csv"))
    assert raw.startswith("﻿name,n")
    back = spark.read.option("header", True).csv(p)
    assert [c.lstrip("﻿") for c in back.columns] == ["name", "n"]


def test_overwrite_skips_empty_and_append(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 5)], "date date, v bigint")
    assert S.overwrite_table(df, target)
    assert not S.overwrite_table(df.limit(0), target)
    assert spark.read.parquet(target).first().date == "2024-01-01"
    assert S.append_table(df, target) and spark.read.parquet(target).count() == 2


def test_snapshot_dynamic_overwrite(spark, tmp_path):
    p = str(tmp_path / "snap")
    T = dt.datetime
    rows = [dict(order_number="a", order_datetime=T(2024, 1, 1), quantity=1, order_net_sales=1, ingest_seq=0,
                 line_seq=0),
            dict(order_number="b", order_datetime=T(2024, 1, 2), quantity=1, order_net_sales=2, ingest_seq=1,
                 line_seq=0)]
    S.write_snapshot(lines_df(spark, rows), p)
    S.write_snapshot(lines_df(spark, [dict(rows[1], order_net_sales=5)]), p)
    snap = read_snapshot(spark, p)
    assert sorted((r.order_number, r.order_net_sales) for r in snap.collect()) == [("a", 1), ("b", 5)]
    assert read_snapshot(spark, p, start=dt.date(2024, 1, 2)).count() == 1


def test_stream_appends_newly_closed_days_on_rerun(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "b1.json").write_text("\n".join(json.dumps(d) for d in [_doc("a", 1), _doc("b", 2, seq=1)]))
    (src / "b2.json").write_text("\n".join(json.dumps(d) for d in [_doc("c", 5, seq=2), _doc("d", 9, seq=3)]))
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    first = run_daily_totals(spark, str(src), sink, ckpt, max_files_per_trigger=1)
    assert sorted(r.date.day for r in first.collect()) == [1, 2, 5]
    (src / "b3.json").write_text(json.dumps(_doc("e", 12, seq=4)))            # a later landing
    again = run_daily_totals(spark, str(src), sink, ckpt, max_files_per_trigger=1)
    assert sorted(r.date.day for r in again.collect()) == [1, 2, 5, 9]        # day 9 now closed, once


def test_stream_counts_late_rows_of_batches_no_longer_retained(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    days = [1, 9, 10, 1, 11, 12]  # the fourth batch is late; its progress is gone at the end
    for n, day in enumerate(days):
        f = src / f"b{n}.json"
        f.write_text(json.dumps(_doc(f"o{n}", day, seq=n)))
        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    keep = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(keep, "1")
    try:
        with pytest.raises(LateRowsError):
            run_daily_totals(spark, str(src), str(tmp_path / "sink"), str(tmp_path / "ckpt"), max_files_per_trigger=1)
    finally:
        spark.conf.unset(keep)
