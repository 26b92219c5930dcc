"""Inputs of the large queries: charsets without session settings, bounded files, one scan for all copies."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mallsight.functions.time import CSV_DATE_FORMATS, parse_lenient_time, parse_offset_time, parse_wall_clock
from mallsight.operators.flatten import flatten_y
from mallsight.plans.catalog import load_all
from mallsight.sources import documents as D
from mallsight.sources.landing import in_large_files

N_ORDERS = 30


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Star tables of 30 orders with 0 to 4 lines."""
    root = str(tmp_path_factory.mktemp("tables"))

    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    save("region", [(0, "ASIA")], "r_regionkey int, r_name string")
    save("nation", [(0, "JAPAN", 0), (1, "CHINA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    save("customer", [(i, f"Customer {i}", i % 2, 1.0, "BUILDING") for i in range(5)],
         "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    save("part", [(i, f"part {i}", "b", "t", i, 1.0) for i in range(1, 8)],
         "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    t = dt.datetime(1998, 5, 1)
    save("orders", [(k, k % 5, "FOP"[k % 3], 100.0 + k, t + dt.timedelta(days=k), f"{k % 5 + 1}-HIGH") for k in range(1, N_ORDERS + 1)],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    save("lineitem", [(k, k % 7 + 1, (k * 3 + i) % 6, i, float(i), 10.0 * i, 0.0, 0.0, "RAN"[i % 3], "O", t)
                      for k in range(1, N_ORDERS + 1) for i in range(1, k % 5 + 1)],
         "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    return root


@pytest.mark.parametrize("name", ["prj14_required_columns", "src13_mixed_headers"])
def test_exports_need_no_charset_setting_of_the_session(spark, tables, name):
    flag = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(flag, None)
    spark.conf.set(flag, "false")
    try:
        rows = load_all()[0][name](spark, tables).collect()
    finally:
        spark.conf.set(flag, before) if before is not None else spark.conf.unset(flag)
    lines = spark.read.parquet(f"{tables}/lineitem.parquet").count()
    assert (sum(r.n_records for r in rows) if name.startswith("prj14") else len(rows)) == lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_refetched_copies_come_from_one_scan(spark, tables):
    from mallsight.plans.queries_more import refetched_documents
    df = refetched_documents(spark, tables)
    assert _plan(df).count("lineitem") <= 2 and "Union" not in _plan(df)
    keys = range(1, N_ORDERS + 1)
    assert df.count() == N_ORDERS + sum((k % 7 == 0) + (k % 11 == 0) + (k % 13 == 0) for k in keys)


def test_documents_group_lines_once_and_in_bounded_tasks(spark, tables):
    docs = D.r_documents(spark, tables)
    assert _plan(docs).count("collect_list") == 2                     # one grouping: partial and final
    got = {r.orderNumber: [(p.postagePrice, [(i.itemId, i.price, i.units) for i in p.ItemModelList]) for p in r.PackageModelList]
           for r in docs.collect()}
    packages = {}
    for i in range(1, 5):
        packages.setdefault((4 * 3 + i) % 6 % 5, []).append(("5", 1000, i))
    assert got["4"] == [(100 * p, packages[p]) for p in sorted(packages)] and got["5"] == []
    # many lines a task asks for: more partitions than the session's, by the line count
    items = spark.range(10).select(F.col("id").alias("l_orderkey"))
    assert D._by_order(spark, tables, items, lines_a_task=1).rdd.getNumPartitions() == 60


def test_large_files_hold_a_bounded_number_of_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k")).repartition(7)
    sizes = in_large_files(df, ["k"], 1000, file_rows=100).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 250
    assert in_large_files(df, ["k"], 1000).rdd.getNumPartitions() == 1


def test_json_arrays_in_several_files(spark, tables, monkeypatch):
    from mallsight.plans import queries_more as Q
    columns = ["order_number", "item_id", "quantity", "source"]
    whole = sorted(map(tuple, Q.src1_json_array_file(spark, tables).select(*columns).collect()))
    monkeypatch.setattr(Q, "DOCS_A_FILE", 4)
    monkeypatch.setattr("mallsight.sources.landing._LANDED", set())
    split = Q.src1_json_array_file(spark, tables)
    assert sorted(map(tuple, split.select(*columns).collect())) == whole
    from mallsight.sources.landing import landed_path
    assert len(set(spark.read.text(landed_path(spark, tables, "r_array")).inputFiles())) > 2


def test_guarded_parsers_read_what_the_formats_read(spark):
    texts = ["2024-01-02 03:04:05", "2024/01/02 03:04:05", "2024-01-02 03:04", "2024/01/02 03:04", "2024-01-02T03:04:05", "2024-01-02t03:04:05",
             "20240102030405", "2024-01-02", "2024/01/02", "20240102", "+12024-01-02", "2024-13-02", "2024-1-2", "", " 2024-01-02 ", "x", None, "2024-01-02 3:04"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    s = F.nullif(F.trim("t"), F.lit(""))
    plain = F.coalesce(*[parse_wall_clock(s, f) for f in CSV_DATE_FORMATS])
    for r in df.select("t", parse_lenient_time("t").alias("got"), plain.alias("want")).selectExpr("t", "string(got)", "string(want)").collect():
        assert r.got == r.want, r.t
    zones = ["2024-01-01T00:00:00" + z for z in ("Z", "z", "+0900", "+09:00", "+09", "", "+9", "-0330", "x")]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zones], "t string").select(parse_offset_time("t").cast("string")).collect()]
    nine = "2024-01-01 09:00:00"
    assert got == [nine, nine, *["2024-01-01 00:00:00"] * 4, got[6], "2024-01-01 12:30:00", None]


def test_an_xml_response_is_parsed_once(spark):
    text = "<Result><OrderInfo><OrderId>7</OrderId><OrderTime>20240101000000</OrderTime><TotalPrice>5</TotalPrice></OrderInfo></Result>"
    lines, _ = flatten_y(spark.createDataFrame([(text, 1)], "value string, ingest_seq long"))
    assert [(r.order_number, r.total_price, r.quantity) for r in lines.collect()] == [("7", 5, 1)]
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ResultSet") <= 3 and plan.count("XmlToStructsEvaluator") <= 2


def test_landed_order_documents_are_compressed(spark, tables):
    from mallsight.plans.queries_more import landed_refetched
    from mallsight.plans.queries_sources import landed_r_orders
    for path in (landed_r_orders(spark, tables), landed_refetched(spark, tables)):
        files = spark.read.text(path).inputFiles()
        assert files and all(f.endswith(".json.gz") for f in files)
    assert load_all()[0]["src1_read_order_json"](spark, tables).count() > 0


def test_export_ranges_sample_two_numbers_and_keep_the_order(spark):
    from pyspark.sql import types as T
    rows = [(f"{k}", dt.datetime(2024, 1, 1), f"i{i}", "n" * 50, 10, i, 0, 0, 0, 5, i, k) for k in range(40, 0, -1) for i in (3, 1, 2)]
    lines = spark.createDataFrame(rows, "order_number string, order_datetime timestamp_ntz, item_id string, item_name string, unit_price long, quantity long, "
                                  "point_used long, coupon_used long, shipping_charge long, total_price long, line_seq long, ingest_seq long")
    out = D.csv_export(lines, 1)
    got = [(int(r[0]), int(r["Quantity"])) for r in out.collect()]
    assert got == [(k, i) for k in range(1, 41) for i in (1, 2, 3)]
    keys = [line for line in _plan(out).splitlines() if "rangepartitioning" in line]
    assert keys and all("item_id" not in k and "shipping_charge" not in k for k in keys)
    assert isinstance(out.schema[0].dataType, T.StringType)


def test_header_places_are_found_once_a_file(spark, tmp_path):
    from mallsight.sources import csv_export as C
    (tmp_path / "a.csv").write_text("OrderId,OrderTime,注文ID,Title\nE,2024-01-02,,t\nE,2024/01/02 03:04:05,J,\n", "utf-8")
    parsed = C.parse_order_csv(spark, str(tmp_path), "UTF-8")
    got = [(r.order_number, str(r.order_date), r.item_name, r.quantity) for r in parsed.orderBy("_pos").collect()]
    assert got == [("E", "2024-01-02 00:00:00", "t", 1), ("J", "2024-01-02 03:04:05", None, 1)]   # an accepted name that is empty gives way to the next
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "array_position" not in plan and "exists(" not in plan


def test_digits_and_plain_times_skip_patterns(spark):
    from mallsight.functions.money import clean_int
    texts = ["1,200", "12", "007", "99999999999999999999", "", ",", " 12 ", "12.7", "1e3", "-5", "12d", "\x0112", "١٢", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(clean_int("t").alias("n")).collect()
    assert [r.n for r in rows] == [1200, 12, 7, 0, 0, 0, 12, 12, 1000, -5, 0, 0, 0, 0]
    times = ["2024-01-02 03:04:05", "2024/01/02", "2024-01/02", "2024-02-30", "0000-01-01", "2024-01-02 24:00:00", "٢٠٢٤-01-02"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    plain = F.coalesce(*[parse_wall_clock(F.col("t"), f) for f in CSV_DATE_FORMATS])
    assert [r[0] for r in df.select(parse_lenient_time("t").cast("string")).collect()] == [r[0] for r in df.select(plain.cast("string")).collect()]


def test_xml_reasons_parse_each_response_once(spark, tables):
    df = load_all()[0]["src9_xml_reasons"](spark, tables)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("orders.parquet") <= 1 and plan.count("Relation [") == 1 and "Union" not in plan
    assert {r.reason: r.n for r in df.groupBy("reason").agg(F.sum("documents").alias("n")).collect()} == {
        "error_response": 9, "unparsed": 5, "bad_time": 4, "bad_amount": 4, "line": 8}


def test_open_fields_join_texts_only_at_the_ends_of_ranges(spark, tmp_path):
    from mallsight.sources import split_records as S
    rows = [f'{i},"a{i}\n\nb ""{i}"""' for i in range(400)] + ['x,"' + "y\n" * 800 + '"']
    (tmp_path / "e.csv").write_text("id,note\n" + "\n".join(rows) + "\n")
    (tmp_path / "stray.csv").write_text('id,note\n1,"x\n2,y\n')
    conf = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        records = S.csv_records(S.pieces(spark, str(tmp_path), "\n"))
        got = sorted(r.text for r in records.collect())
        plan = _plan(records)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(["id,note", *rows, "id,note", '1,"x', "2,y"])
    assert "MapInArrow" in plan and plan.count("SortMergeJoin") == 0
