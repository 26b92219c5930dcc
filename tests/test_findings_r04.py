"""Tests of the findings of round 4: small rows of their own."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from mallsight.plans import catalog
from mallsight.sources import csv_export as C
from mallsight.sources import documents as D
from mallsight.sources import split_records as S
from mallsight.streaming import current_totals, run_with_corrections

catalog.load_all()
from mallsight.plans import queries_sources as Q  # noqa: E402


def _doc(num, day, seq, goods):
    return {"orderNumber": num, "orderDatetime": f"2024-01-{day:02d}T10:00:00+0900", "orderProgress": 100, "goodsPrice": goods,
            "couponAllTotalPrice": 0, "_ingest_seq": seq, "PackageModelList": [{"ItemModelList": [{"itemId": "i", "price": 1, "units": 1}]}]}


def _land(folder, files):
    folder.mkdir(exist_ok=True)
    at = len(list(folder.iterdir()))
    for i, docs in enumerate(files, at):
        p = folder / f"f{i}.json"
        p.write_text("\n".join(json.dumps(d) for d in docs))
        os.utime(p, (1e9 + i, 1e9 + i))


def test_corrected_stream_keeps_one_row_an_order_and_batch(spark, tmp_path):
    """no state store and no Python worker; a hot number leaves one row a batch, a lost day-change folder comes back."""
    src, sink, ck = tmp_path / "in", tmp_path / "sink", tmp_path / "ck"
    _land(src, [[_doc("hot", 1, s, s) for s in range(90, 50, -1)] + [_doc("a", 1, 7, 70)], [_doc("hot", 2, s, s) for s in range(40, 20, -1)],
                [_doc("hot", 3, 99, 5), _doc("b", 3, 1, 10)]])
    out = run_with_corrections(spark, str(src), str(sink), str(ck), 1)
    kept = [tuple(r) for r in spark.read.parquet(str(ck / "lowest")).select("batch_id", "orderNumber", "seq").orderBy("batch_id", "orderNumber").collect()]
    assert kept == [(0, "a", 7), (0, "hot", 51), (1, "hot", 21), (2, "b", 1), (2, "hot", 99)]
    assert not (ck / "state").exists()
    rows = lambda df: sorted((r.batch_id, r.date.day, r.order_count, r.gross_sales) for r in df.collect())
    want = [(0, 1, 2, 121), (1, 1, -1, -51), (1, 2, 1, 21), (2, 3, 1, 10)]
    assert rows(out) == want
    os.rename(sink / "batch_id=1", tmp_path / "lost")
    _land(src, [[_doc("a", 5, 3, 30)]])
    out = run_with_corrections(spark, str(src), str(sink), str(ck), 1)
    assert rows(out) == want + [(3, 1, -1, -70), (3, 5, 1, 30)]
    assert {r.date.day: (r.order_count, r.gross_sales) for r in current_totals(out).collect()} == {2: (1, 21), 3: (1, 10), 5: (1, 30)}


def test_checkpoint_with_a_state_store_is_refused(spark, tmp_path):
    """a checkpoint of the versions before holds its orders elsewhere; going on from it would lose them."""
    (tmp_path / "ck" / "state").mkdir(parents=True)
    with pytest.raises(ValueError, match="new checkpoint"):
        run_with_corrections(spark, str(tmp_path), str(tmp_path / "sink"), str(tmp_path / "ck"))


def _written(path):
    return [f.name for f in path.rglob("part-*")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Twenty orders with two lines each, one order without lines, and the tables beside them."""
    d = tmp_path_factory.mktemp("r04") / "tables"
    rows = {"orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                       [(k, k % 3, "FOP"[k % 3], 100.0 + k, dt.datetime(1998, 6, 1 + k), f"{1 + k % 5}-X") for k in range(21)]),
            "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string",
                         [(k, (k + n) % 4, n, n, 2.0, 10.0, "RAN"[n]) for k in range(20) for n in (1, 2)]),
            "part": ("p_partkey long, p_name string, p_size int", [(p, f'part "{p}" {{x}}', p * 2) for p in range(4)]),
            "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(c, f"c{c}", c, "card") for c in range(3)]),
            "nation": ("n_nationkey int, n_name string, n_regionkey int", [(n, f"N{n}", 0) for n in range(3)]),
            "region": ("r_regionkey int, r_name string", [(0, "R0")])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(str(d / f"{name}.parquet"))
    return str(d)


def test_landed_responses_pages_and_exports_are_compressed(spark, tables):
    """their text is many times the size of the tables."""
    from pathlib import Path
    for path in (Q.landed_y_xml(spark, tables), Q.landed_m_pages(spark, tables), Q.landed_csv_export(spark, tables, "0")):
        names = _written(Path(path.removeprefix("file:")))
        assert names and all(n.endswith(".gz") for n in names)
    assert Q.prj6_flatten_xml_orders(spark, tables).count() == 41
    got = {r.mall: (r.lines, r.quantity) for r in Q.set3_union_marketplaces(spark, tables).collect()}
    assert got["Y"] == (41, 81) and got["M"] == (21, 21)


def test_arrival_ranks_files_not_rows(spark, tmp_path):
    """the numbers of imported rows rise with import, file and position, without a sort of the rows."""
    rows = [(f"o{i % 7}", f"i{i}", 1, "1" if i % 2 else "10" if i % 3 else "2", f"f{i % 4}", 90 - i) for i in range(90)]
    df = spark.createDataFrame(rows, "order_number string, item_name string, quantity long, import_id string, file_name string, row_seq long").selectExpr(
        "*", "timestamp_ntz'2024-01-01 00:00:00' order_date", "1L unit_price", "1L subtotal", "1L total_price", "0L use_point", "0L coupon_discount",
        "1L order_net_sales", "'Yahoo' source")
    C.save_imports(df, str(tmp_path / "imports"))
    kept = C.load_saved_imports(spark, str(tmp_path / "imports"), keep_order=True)
    lines = C.imports_as_order_lines(kept)
    assert [r.item_name for r in lines.orderBy("ingest_seq").collect()] == [r[1] for r in sorted(rows, key=lambda r: r[3:])]
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_stale_copies_come_from_one_scan(spark, tables):
    """the nodes of an order and its stale copy leave one row, and the error pages need no join."""
    nodes = D.m_nodes(spark, tables)
    assert "Union" not in nodes._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.key, r.status_set, r.node.status) for r in nodes.collect())
    name = ("COMPLETED", "SHIPPED", "WAITING_FOR_SHIPMENT")
    assert got == sorted([(k, name[k % 3], name[k % 3]) for k in range(21)] + [(k, "SHIPPED", "SHIPPED") for k in (0, 15)])
    errors = D.m_pages(spark, tables).filter("page = -1").collect()
    assert sorted(r.status_set for r in errors) == sorted(name)


def test_texts_of_json_objects_are_not_shuffled(spark, tmp_path):
    """only objects that a byte range cuts are joined; strings with braces and quotes, a cut file and bytes of any place."""
    docs = [{"a": i, "t": "}{\"[," * (i % 5) + "\\", "in": [{"x": "é{", "y": {"z": i}}] * (i % 3)} for i in range(200)]
    (tmp_path / "a.json").write_text(json.dumps(docs, indent=1, ensure_ascii=False), "utf-8")
    (tmp_path / "b.json").write_text("\n".join(map(json.dumps, docs[:20])) + '\n{"a": 7, "t": "cut', "utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("173", "4000", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            rows = S.json_records(spark, str(tmp_path)).collect()
            whole = sorted((json.loads(r.text) for r in rows if "cut" not in r.text), key=lambda d: d["a"])
            assert whole == sorted(docs + docs[:20], key=lambda d: d["a"])
            assert [r.text for r in rows if "cut" in r.text] == ['{"a": 7, "t": "cut']
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    plan = S.json_records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "kind" in plan


def test_a_landing_leaves_no_shuffle_files(spark, tmp_path):
    """F2 to F7: what a landing has shuffled is not needed once it is written."""
    from mallsight.sources.landing import land

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}
    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    path = land(spark, str(tmp_path), "r04", lambda: spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), lambda df, p: df.write.parquet(p))
    for _ in range(50):  # files go in the background
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before and spark.conf.get(key, None) == was
    assert spark.read.parquet(path).count() == 7
