"""Document flatteners on the fixture cases of FIXTURES.md (F1-F3)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from mallsight.operators.flatten import LINE_STRIDE, flatten_m, flatten_r, flatten_y, m_nodes_from_pages
from mallsight.sources.readers import R_ORDER_LANDED, read_order_json


def _r(spark, docs):
    rdd = spark.sparkContext.parallelize([json.dumps(d) for d in docs], 1)
    return spark.read.schema(R_ORDER_LANDED).json(rdd)


def _order(num, pkgs, **kw):
    d = {"orderNumber": num, "orderDatetime": "2024-01-15T10:30:00+0900", "orderProgress": 100,
         "goodsPrice": 5000, "couponAllTotalPrice": 500, "pointAmount": 100, "settlementMethodName": "card",
         "PackageModelList": pkgs, "_ingest_seq": kw.pop("seq", 0)}
    d.update(kw)
    return d


def test_r_two_packages_two_items(spark):
    items = [{"itemId": "a", "itemName": "A", "itemNumber": "N1", "price": 100, "units": 2},
             {"itemId": "b", "itemName": "B", "itemNumber": None, "price": 50, "units": 1}]
    docs = [_order("1", [{"postagePrice": 500, "ItemModelList": items},
                         {"postagePrice": 0, "ItemModelList": items}])]
    rows = flatten_r(_r(spark, docs)).orderBy("line_seq").collect()
    assert len(rows) == 4
    assert [r.line_seq for r in rows] == [0, 1, LINE_STRIDE, LINE_STRIDE + 1]
    assert rows[0].subtotal == 200 and rows[0].order_net_sales == 4500 and rows[0].shipping_charge == 500
    assert rows[1].item_number == "" and rows[0].source == "楽天"
    assert rows[0].order_datetime == dt.datetime(2024, 1, 15, 10, 30) and rows[0].order_weekday == 0


def test_r_cancel_empty_missing(spark):
    docs = [_order("c", [{"ItemModelList": [{"itemId": "x"}]}], orderProgress=900),
            _order("n", []), _order("e", [{"postagePrice": 1, "ItemModelList": []}]),
            _order("m", [{"ItemModelList": [{"itemId": "x"}]}], orderDatetime="bad")]
    rows = flatten_r(_r(spark, docs)).collect()
    assert [r.order_number for r in rows] == ["m"]
    assert rows[0].unit_price == 0 and rows[0].quantity == 1 and rows[0].order_datetime is None


def test_r_lower_case_keys_give_no_rows(spark):
    doc = {"orderNumber": "12345", "orderDatetime": "2024-01-15T10:30:00+0900", "goodsPrice": 5000,
           "packageModelList": [{"itemModelList": [{"itemId": "i", "price": 2500, "units": 2}]}]}
    assert flatten_r(_r(spark, [doc])).count() == 0


def test_read_order_json_missing_path_is_empty(spark, tmp_path):
    df = read_order_json(spark, str(tmp_path / "nothing"))
    assert df.count() == 0 and "PackageModelList" in df.columns


def test_read_pretty_printed_array(spark, tmp_path):
    p = tmp_path / "orders.json"
    p.write_text(json.dumps([_order("1", [{"ItemModelList": [{"itemId": "a", "price": 1, "units": 1}]}]),
                             _order("2", [])], indent=2))
    assert flatten_r(read_order_json(spark, str(p), multi_line=True)).count() == 1


def _y(spark, docs):
    return spark.createDataFrame([(d, i) for i, d in enumerate(docs)], "value string, ingest_seq bigint")


def test_y_wrappers_items_and_totals(spark):
    item = "<Item><Title>t{n}</Title><UnitPrice>100</UnitPrice><Quantity>{q}</Quantity>{s}</Item>"
    docs = [
        "<ResultSet><Result><OrderInfo><OrderId>A</OrderId><OrderTime>20240115103000</OrderTime>"
        "<Pay><TotalPrice>300</TotalPrice><UsePoint>10</UsePoint><GiftCardDiscount>5</GiftCardDiscount></Pay>"
        + item.format(n=1, q=2, s="<SubTotal/>") + item.format(n=2, q="", s="") + "</OrderInfo></Result></ResultSet>",
        "<Result><OrderInfo><OrderId>B</OrderId><OrderTime>20240115103000</OrderTime><Pay><TotalPrice>0</TotalPrice>"
        "</Pay><Detail><TotalPrice>700</TotalPrice></Detail>" + item.format(n=3, q=1, s="<SubTotal>90</SubTotal>")
        + "</OrderInfo></Result>",
        "<OrderInfo><OrderId>C</OrderId><OrderTime>20240115103000</OrderTime><TotalPrice>800</TotalPrice></OrderInfo>",
        '<y:OrderInfo xmlns:y="urn:y"><y:OrderId>D</y:OrderId><y:OrderTime>20240115</y:OrderTime></y:OrderInfo>',
        "<Error><Code>1</Code><Message>denied</Message></Error>",
        "<OrderInfo><OrderId>E</OrderId><OrderTime>20240115103000</OrderTime><Pay><TotalPrice>1,0</TotalPrice>"
        "</Pay></OrderInfo>",
        "<broken",
    ]
    lines, q = flatten_y(_y(spark, docs))
    rows = {(r.order_number, r.item_name): r for r in lines.collect()}
    a1, a2 = rows[("A", "t1")], rows[("A", "t2")]
    assert a1.subtotal == 0 and a1.quantity == 2            # empty <SubTotal/> -> 0
    assert a2.quantity == 1 and a2.subtotal == 100           # empty quantity -> 1, absent subtotal -> price x qty
    assert a1.order_net_sales == 285 and a1.total_price == 300
    assert rows[("B", "t3")].total_price == 700 and rows[("B", "t3")].subtotal == 90
    c = rows[("C", "")]
    assert c.quantity == 1 and c.unit_price == 800 and c.subtotal == 800   # synthetic line
    assert ("D", "") not in rows                              # short time -> quarantined
    reasons = {r.order_number or r.reason: r.reason for r in q.collect()}
    assert reasons["D"] == "bad_time" and reasons["E"] == "bad_amount"
    assert sorted(r.reason for r in q.collect()) == ["bad_amount", "bad_time", "error_response", "unparsed"]


def test_y_fallback_time(spark):
    docs = ["<OrderInfo><OrderId>D</OrderId><OrderTime>x</OrderTime><TotalPrice>5</TotalPrice></OrderInfo>"]
    lines, q = flatten_y(_y(spark, docs), fallback_ts=dt.datetime(2024, 2, 1, 9, 0))
    assert lines.first().order_datetime == dt.datetime(2024, 2, 1, 9, 0) and q.count() == 0


def _page(set_seq, page, nodes=None, errors=None):
    body = {"data": None if nodes is None else {"orders": {"edges": [{"cursor": n["id"], "node": n} for n in nodes],
                                                              "pageInfo": {"hasNextPage": False}}}}
    if errors:
        body["errors"] = [{"message": errors}]
    return (set_seq, page, json.dumps(body))


def _node(i, status, created=None, paid=None, price=100):
    return {"id": i, "orderNumber": i, "status": status, "createdAt": created, "paidAt": paid,
            "product": {"id": "p", "name": "P", "price": price}, "payment": {"totalPrice": price + 10}}


def test_m_pages(spark):
    pages = spark.createDataFrame([
        _page(0, 0, [_node("a", "COMPLETED", "2024-01-15T23:30:00Z"), _node("", "COMPLETED", "2024-01-15T00:00:00Z")]),
        _page(1, 0, [_node("a", "SHIPPED", "2024-01-15T23:30:00Z", price=1),
                     _node("b", "SHIPPED", None, "2024-01-10T00:00:00Z"),
                     _node("c", "SHIPPED"), _node("d", "SHIPPED", "garbage", "2024-01-10T00:00:00Z"),
                     _node("e", "SHIPPED", "2023-01-01T00:00:00Z")]),
        _page(2, 0, errors="Throttled"),
    ], "set_seq int, page bigint, value string")
    nodes, failed = m_nodes_from_pages(pages)
    assert failed.count() == 1
    lines = flatten_m(nodes, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31, 23, 59, 59))
    rows = {r.order_number: r for r in lines.collect()}
    assert set(rows) == {"a", "b", "c", "d"}                 # '' dropped, 'e' outside, c/d undated kept
    assert rows["a"].unit_price == 100 and rows["a"].order_date == dt.date(2024, 1, 16)   # COMPLETED wins; JST
    assert rows["b"].order_datetime == dt.datetime(2024, 1, 10, 9, 0)
    assert rows["d"].order_datetime is None and rows["a"].total_price == 110
    assert F is not None


def test_r_numeric_item_id_reads_as_text(spark):
    docs = [_order("1", [{"ItemModelList": [{"itemId": 12345, "itemName": "A", "price": 10, "units": 1}]}])]
    assert flatten_r(_r(spark, docs)).first().item_id == "12345"


def test_y_zero_quantity_text_stays_zero(spark):
    doc = ("<OrderInfo><OrderId>Z</OrderId><OrderTime>20240115103000</OrderTime><TotalPrice>5</TotalPrice>"
           "<Item><Title>a</Title><UnitPrice>10</UnitPrice><Quantity>0</Quantity></Item>"
           "<Item><Title>b</Title><UnitPrice>10</UnitPrice></Item></OrderInfo>")
    lines, _ = flatten_y(_y(spark, [doc]))
    got = {r.item_name: (r.quantity, r.subtotal) for r in lines.collect()}
    assert got == {"a": (0, 0), "b": (1, 10)}


def test_r_documents_without_landed_sequence(spark, tmp_path):
    p = tmp_path / "plain.json"
    docs = [{"orderNumber": "1", "orderDatetime": "2024-06-15T10:00:00+0900", "goodsPrice": 1000,
             "couponAllTotalPrice": 100,
             "PackageModelList": [{"ItemModelList": [{"itemId": "a", "price": 450, "units": 2}]}]}]
    p.write_text("\n".join(json.dumps(d) for d in docs))
    from mallsight.operators import aggregates as A
    r = A.daily_sales(flatten_r(read_order_json(spark, str(p)))).first()
    assert (r.order_count, r.total_sales, r.item_count) == (1, 900, 2)
