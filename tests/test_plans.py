"""Plan shape: no Python UDFs, hash aggregation on the order grain, pushed filters, narrow scans."""

import pytest

from order_lines import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def registry():
    from mallsight.plans.catalog import load_all
    return load_all()[0]


def test_no_python_in_any_registered_plan(spark, registry):
    for name, fn in registry.items():
        if name.startswith(("str1", "snk")):
            continue            # these run writes while building
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


def test_order_grain_is_hash_aggregated(spark, registry):
    df = registry["agg2_daily_sales"](spark, SF_SMALL)
    df.collect()
    p = _plan(df)
    assert "SortAggregate" not in p and "HashAggregate" in p
    # the window runs above the aggregate, on one row per (order, day)
    assert p.index("Window") < p.index("partial_min_by")


def test_cancel_filter_and_columns_reach_the_scan(spark, registry):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")       # else the filters are cut off
    df = registry["agg2_daily_sales"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [Not(EqualNullSafe(o_orderstatus,P))" in text
    # lineitem scan reads only the columns the plan needs
    scan = [line for line in text.split("\n") if "lineitem" in line and "ReadSchema" in line]
    assert scan and "l_returnflag" not in scan[0] and "l_shipdate" not in scan[0]


def test_no_dimension_is_broadcast_by_hand(spark, registry):
    import inspect
    from mallsight.sources import adapters
    src = inspect.getsource(adapters)
    assert "F.broadcast(" not in src      # the size threshold decides for every dimension


def test_top_products_carry_no_text_through_the_aggregate(spark, registry):
    for name in ("lim1_top5_products", "lim3_top10_per_store", "agg18_top_product_share"):
        df = registry[name](spark, SF_SMALL)
        df.collect()
        p = _plan(df)
        assert "SortAggregate" not in p, name
        assert p.count("lineitem") == 2 or "ReusedExchange" in p, "numbers, then the winners' texts"


def test_report_reads_each_fact_once(spark, registry):
    import re
    p = _plan(registry["rpt4_daily_report_dataset"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", p)
    assert scans.count("lineitem") == 1 and scans.count("orders") == 1, scans
