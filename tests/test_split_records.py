"""Records of single files read in byte ranges, against Python's csv and json (SRC1, SRC13, SRC15)."""

import csv
import io
import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from mallsight.sources import csv_export as C
from mallsight.sources import split_records as S


@contextmanager
def ranges_of(spark, n):
    """Files are cut into ranges of ``n`` bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": str(n), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


BITS = ["a", "商品", ",", '"', "\n", "\n\n", "\r\n", " ", "x y", "}", "{", "\\", "é", "1,200"]


def words(r, n=6):
    return "".join(r.choice(BITS) for _ in range(r.randint(0, n)))


@pytest.mark.parametrize("size", [300, 10**6])
def test_csv_ranges_equal_python(spark, tmp_path, size):
    r = random.Random(size)
    rows = [(f"o{i}", words(r), words(r)) for i in range(70)] + [("long", "line\n" * 300, "")]
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(["id", "名", "note"])
    w.writerows(rows)
    (tmp_path / "one.csv").write_bytes(out.getvalue().replace("é", "e").encode("cp932"))
    (tmp_path / "two.csv").write_text("note,id\n\"b\nc\",p1\n\n  ,p2\n")
    with ranges_of(spark, size):
        lines = S.pieces(spark, str(tmp_path), "\n")
        assert lines.rdd.getNumPartitions() > (2 if size < 10**5 else 0)
        got = {x["id"]: (x["名"], x.note) for x in C.read_raw_export(spark, str(tmp_path)).collect()}
    clean = lambda t: t.replace("é", "e") or None  # an empty field reads as NULL
    want = {i: (clean(a), clean(b)) for i, a, b in rows} | {"p1": (None, "b\nc"), "p2": (None, "  ")}
    assert got == want


def test_positions_rise_through_a_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("注文ID,注文日,商品名\n" + "".join(f"{i},2024-01-01,\"a\n{i}\"\n" for i in range(300)), "utf-8")
    with ranges_of(spark, 1500):
        got = C.parse_order_csv(spark, str(tmp_path / "e.csv"), "UTF-8").orderBy("_pos").collect()
    assert [r.order_number for r in got] == [str(i) for i in range(300)] and len({r._pos for r in got}) == 300
    assert {r._file for r in got} == {"e.csv"}


def test_every_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("注文ID,注文日,商品名,数量,単価\nA,2024-01-15,ペン,2,100\n".encode("cp932"))
    (tmp_path / "b.csv").write_bytes("注文ID,注文日,単価,数量,商品名\nB,2024-01-15,300,4,紙\n".encode("cp932"))
    (tmp_path / "c.csv").write_text("﻿UnitPrice,OrderTime,OrderId\n500,2024-01-15,C\n", "utf-8")
    got = {r.order_number: (r.item_name, r.quantity, r.unit_price) for r in C.parse_order_csv(spark, str(tmp_path)).collect()}
    assert got == {"A": ("ペン", 2, 100), "B": ("紙", 4, 300), "C": ("不明", 1, 500)}
    assert C.read_raw_export(spark, str(tmp_path)).columns[:5] == ["注文ID", "注文日", "商品名", "数量", "単価"]
    (tmp_path / "d.csv").write_text("商品名\nx\n", "utf-8")
    with pytest.raises(ValueError, match=r"missing in .*d\.csv: \['order_number', 'order_date'\]"):
        C.parse_order_csv(spark, str(tmp_path))


def test_a_stray_quote_costs_its_line_only(spark, tmp_path):
    (tmp_path / "e.csv").write_text('注文ID,注文日,商品名\nA,2024-01-15,"x\nB,2024-01-15,y\nC,2024-01-15\n', "utf-8")
    rows = {r.order_number: r.item_name for r in C.parse_order_csv(spark, str(tmp_path), "UTF-8").collect()}
    assert rows["B"] == "y" and "C" not in rows
    assert [r.value for r in C.quarantined_rows(spark, str(tmp_path), "UTF-8").collect()] == ["C,2024-01-15"]


def test_the_session_keeps_its_flags(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes("注文ID,注文日\nA,2024-01-15\n".encode("cp932"))
    flags = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = [spark.conf.get(f) for f in flags]
    spark.conf.set(flags[0], "false")
    try:
        assert C.parse_order_csv(spark, str(tmp_path)).count() == 1
        assert spark.conf.get(flags[0]) == "false" and spark.conf.get(flags[1]) == before[1]
    finally:
        spark.conf.set(flags[0], before[0])


def random_json(r, depth=0):
    kind = r.randint(0, 3 if depth < 3 else 1)
    if kind == 0:
        return words(r)
    if kind == 1:
        return r.choice([1, 2.5, None, True, '"', '\\"', "}", "{[", "\\"])
    return {words(r): random_json(r, depth + 1) for _ in range(r.randint(0, 3))} if kind == 2 else [random_json(r, depth + 1) for _ in range(r.randint(0, 3))]


@pytest.mark.parametrize("size", [200, 10**6])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_ranges_equal_python(spark, tmp_path, size, indent):
    r = random.Random(size)
    objects = [{"k": i, "v": random_json(r)} for i in range(40)]
    (tmp_path / "a.json").write_text(json.dumps(objects[:30], indent=indent, ensure_ascii=False), "utf-8")
    (tmp_path / "b.json").write_text("\n".join(json.dumps(o) for o in objects[30:]))
    (tmp_path / "empty.json").write_text("[]\n")
    with ranges_of(spark, size):
        texts = [x.text for x in S.json_records(spark, str(tmp_path)).collect()]
    assert sorted((json.loads(t) for t in texts), key=lambda o: o["k"]) == objects


def test_json_objects_and_quarantine(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    (tmp_path / "a.json").write_text('[{"k": 1, "v": "a}"}, {"k": oops}, {"k": 2, "v": null}, {"k": 3')
    good, bad = S.read_json_objects(spark, str(tmp_path), schema)
    assert sorted(tuple(x) for x in good.collect()) == [(1, "a}"), (2, None)]
    assert sorted(x.value for x in bad.collect()) == ['{"k": 3', '{"k": oops}']


def test_splitting_shuffles_no_text_without_open_fields(spark, tmp_path):
    (tmp_path / "e.csv").write_text("注文ID,注文日\n" + "".join(f"{i},\"2024-01-01\"\n" for i in range(50)), "utf-8")
    plan = S.csv_records(S.pieces(spark, str(tmp_path), "\n"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert S.csv_records(S.pieces(spark, str(tmp_path), "\n")).filter(F.col("text").contains("2024")).count() == 50
