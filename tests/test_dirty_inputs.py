"""Inputs that real tools produce: quoted CSV, mixed encodings, broken JSON and XML, odd numbers and times."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from order_lines import lines_df
from mallsight import sinks as S
from mallsight.functions.money import clean_int
from mallsight.functions.time import parse_offset_time
from mallsight.operators import aggregates as A
from mallsight.operators.flatten import flatten_r, flatten_y, m_nodes_from_pages
from mallsight.operators.grain import keep_first
from mallsight.plans.reports import summary_kv
from mallsight.sources import csv_export as C
from mallsight.sources import readers as R
from mallsight.streaming import run_daily_totals
from mallsight.streaming.daily import LateRowsError
from test_streaming_sinks import _doc

HEAD = "注文ID,注文日時,商品名,数量\n"


def test_quoted_fields_line_breaks_and_short_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes((HEAD + 'A,2024-01-15,"ペン ""B"", 12本",3\nB,2024-01-16,"二行\nの名",2\n'
                                      "C,2024-01-17\nD,2024-01-18,x,1,extra\nE,2024-01-19,  空白 ,4\n").encode("cp932"))
    rows = {r.order_number: (r.item_name, r.quantity) for r in C.parse_order_csv(spark, str(tmp_path), "windows-31j").collect()}
    assert rows == {"A": ('ペン "B", 12本', 3), "B": ("二行\nの名", 2), "E": ("  空白 ", 4)}
    bad = C.quarantined_rows(spark, str(tmp_path), "windows-31j").collect()
    assert sorted(r.value[0] for r in bad) == ["C", "D"]


def test_encoding_is_decided_by_the_content_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("OrderId,OrderTime,Title\n1,2024-01-15,鉛筆\n".encode("cp932"))
    (tmp_path / "b.csv").write_bytes("OrderId,OrderTime,Title\n2,2024-01-15,鉛筆と消しゴム\n".encode("utf-8"))
    rows = {r.order_number: r.item_name for r in C.parse_order_csv(spark, str(tmp_path), "windows-31j").collect()}
    assert rows == {"1": "鉛筆", "2": "鉛筆と消しゴム"}


def test_plain_saved_files_and_folders(spark, tmp_path):
    (tmp_path / "yahoo_orders_20240101_000000.csv").write_text(
        "\ufefforder_number,order_date,item_name,quantity\n1,2024-01-01 10:00:00,a,1\n2,2024-01-01 10:00:00,b,1\n", "utf-8")
    (tmp_path / "yahoo_orders_20240102_000000.csv").write_text(
        "\ufeffquantity,item_name,order_number,order_date\n5,a,1,2024-01-01 10:00:00\n", "utf-8")
    (tmp_path / "other.csv").write_text("x\n1\n")
    rows = {r.order_number: r.quantity for r in C.load_saved_csv(spark, str(tmp_path)).collect()}
    assert rows == {"1": 5, "2": 1}
    assert C.load_saved_csv(spark, str(tmp_path / "none")).count() == 0


def test_csv_text_round_trip(spark, tmp_path):
    rows = [("  注文件数", 'say "hi", ok'), ("a\\b", "x ")]
    path = S.write_csv(spark.createDataFrame(rows, "a string, b string"), str(tmp_path / "t"))
    assert sorted(tuple(r) for r in C.read_raw_export(spark, path, "UTF-8").collect()) == sorted(rows)


def test_json_decimals_and_broken_documents(spark, tmp_path):
    doc = {"orderNumber": "1", "orderDatetime": "2024-01-15T10:30:00+0900", "orderProgress": 100, "goodsPrice": 1000.0,
           "couponAllTotalPrice": 100, "PackageModelList": [{"ItemModelList": [{"itemId": "i", "price": 12.5, "units": 2}]}]}
    (tmp_path / "d.json").write_text(json.dumps(doc) + '\n{"orderNumber": "2", "goods\n')
    good, bad = R.read_order_json_checked(spark, str(tmp_path))
    row = flatten_r(good).first()
    assert (row.total_price, row.order_net_sales, row.unit_price, row.subtotal) == (1000, 900, 12, 24)
    assert [r.value for r in bad.collect()] == ['{"orderNumber": "2", "goods'] and good.count() == 1
    assert R.read_order_json(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="(?i)parquet|schema|footer"):
        R.read_parquet_or_empty(spark, str(tmp_path), R.R_ORDER_LANDED).count()


def _y(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, ingest_seq long")


ORDER = ("<OrderInfo><OrderId>{}</OrderId><OrderTime>20240115103000</OrderTime><Pay><TotalPrice>500</TotalPrice></Pay>{}</OrderInfo>")


def test_xml_errors_at_any_depth_and_any_root(spark):
    lines, bad = flatten_y(_y(
        spark,
        "<ResultSet><Error><Code>1</Code><Message>bad &amp; worse</Message></Error></ResultSet>",
        '<ns:Error xmlns:ns="u"><ns:Message>named</ns:Message></ns:Error>',
        "<Answer><Result><Error/></Result></Answer>",
        "<Answer><ResultSet><Result>" + ORDER.format("a", "") + "</Result></ResultSet></Answer>",
        "<!-- hello -->\n<ResultSet><Result>" + ORDER.format("b", "<!-- <Error/> -->") + "</Result></ResultSet>",
        "<ResultSet><Result><OrderInfo><OrderId>c</Ord",
        ORDER.format("d", "<Item/>"),
        ORDER.format("e", "<Item/><Item><ItemId>i</ItemId><UnitPrice>500</UnitPrice></Item>")))
    assert sorted((r.ingest_seq, r.reason, r.error) for r in bad.collect()) == [
        (0, "error_response", "bad & worse"), (1, "error_response", "named"), (2, "error_response", "Unknown error"),
        (5, "unparsed", None)]
    assert sorted((r.order_number, r.item_id, r.quantity, r.subtotal) for r in lines.collect()) == [
        ("a", None, 1, 500), ("b", None, 1, 500), ("d", None, 1, 500), ("e", "i", 1, 500)]


def test_truncated_and_failed_pages(spark):
    ok = {"data": {"orders": {"edges": [{"node": {"id": "1", "createdAt": "2024-01-01T00:00:00Z"}}]}}}
    pages = spark.createDataFrame([(0, 1, json.dumps(ok)), (0, 2, json.dumps(ok)[:30]), (0, 3, "<html>"),
                                   (0, 4, json.dumps({"errors": [{"message": "Throttled"}]}))], "set_seq int, page long, value string")
    nodes, failed = m_nodes_from_pages(pages)
    assert nodes.count() == 1
    assert {r.page: r.message for r in failed.collect()} == {2: "unreadable page", 3: "unreadable page", 4: "Throttled"}


def test_numbers_and_times(spark):
    texts = {"1,200": 1200, "12.7": 12, "12d": 0, "0x1p3": 0, "9007199254740993": 9007199254740993, " 7 ": 7, "1e3": 1000,
             "-5": -5, "nan": 0, "": 0, ".5": 0, "99999999999999999999": 0, None: 0}
    got = {r.t: r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", clean_int("t").alias("n")).collect()}
    assert got == texts
    day = dt.datetime(2024, 1, 15, 10, 30)
    times = {"2024-01-15 10:30:00+09:00": day, "2024-01-15T10:30+09:00": day, "2024-01-15": dt.datetime(2024, 1, 15),
             "2024-01-15T10:30:00+0900": day, "2024-01-15T01:30:00Z": day, "2024-01-15 10:30": day, "15/01/2024": None,
             "2024-01-15T10:30:00.500": day.replace(microsecond=500_000), "": None}
    got = {r.t: r.v for r in spark.createDataFrame([(t,) for t in times], "t string")
           .select("t", parse_offset_time("t").alias("v")).collect()}
    assert got == times


def test_share_of_a_zero_total_and_tied_lines(spark):
    lines = lines_df(spark, [{"order_number": "1", "item_number": "a", "item_name": "x", "quantity": q, "subtotal": 0, "unit_price": 0,
                              "ingest_seq": 1, "line_seq": 0, "item_id": "i"} for q in (3, 2)])
    assert [r.share for r in A.top_product_share(lines).collect()] == [None]
    assert keep_first(lines, ("order_number",)).first().quantity == 2
    assert A.period_filter(lines.selectExpr("*"), None, None).count() == 2


def test_empty_period_prints_none(spark):
    stats = A.summary_stats(lines_df(spark, []))
    assert summary_kv(stats, dt.datetime(2024, 1, 1)).filter("row_no = 1").first()["値"] == "None 〜 None"


def test_sinks_run_their_plan_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r
    df = spark.createDataFrame(spark.sparkContext.parallelize([(i, dt.date(2024, 1, 1 + i % 3)) for i in range(30)], 3)
                               .mapPartitions(count), "v long, order_date date").withColumn("order_number", F.col("v"))
    for write in (lambda: S.overwrite_table(df, str(tmp_path / "a")), lambda: S.overwrite_table(df, str(tmp_path / "a")),
                  lambda: S.append_table(df, str(tmp_path / "b")), lambda: S.write_snapshot(df, str(tmp_path / "c"))):
        before = seen.value
        assert write() is True and seen.value - before == 30
    assert spark.read.parquet(str(tmp_path / "a")).count() == 30 and spark.read.parquet(str(tmp_path / "c")).count() == 30
    assert S.write_snapshot(df.limit(0), str(tmp_path / "c")) is False
    assert S.append_table(df.limit(0), str(tmp_path / "b")) is False
    assert spark.read.parquet(str(tmp_path / "b")).count() == spark.read.parquet(str(tmp_path / "c")).count() == 30
    assert not list(tmp_path.glob("*staging*"))


def test_stream_ignores_copies_without_lines_and_reports_late_rows(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    empty = _doc("a", 1, ())
    (src / "p0.json").write_text("\n".join(json.dumps(d) for d in (empty, _doc("a", 1, (2,), seq=1), _doc("b", 1, (2,), seq=2), _doc("z", 9, seq=3))))
    got = {r.date: (r.order_count, r.item_count) for r in run_daily_totals(spark, str(src), str(tmp_path / "s"), str(tmp_path / "c")).collect()}
    assert got == {dt.date(2024, 1, 1): (2, 4)}
    (src / "p1.json").write_text(json.dumps(_doc("late", 1, seq=9)))
    with pytest.raises(LateRowsError, match="1 rows"):
        run_daily_totals(spark, str(src), str(tmp_path / "s"), str(tmp_path / "c"))


def test_shared_folder_is_required_on_a_cluster():
    from mallsight import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
