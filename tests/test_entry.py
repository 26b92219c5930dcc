"""Driver contract and the Spark-vs-DuckDB oracle for every registered query (sf0.001)."""

import os
import sys

import pytest

from order_lines import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["date", "order_count", "total_sales", "gross_sales", "coupon_total", "item_count"]
    assert df.count() > 0


def test_registry_names():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    import re
    for name in q:
        assert name == "pipeline" or re.match(
            r"^(agg|lim|win|flt|src|prj|jon|set|rpt|str|snk|fn|srt|op)\d+_[a-z0-9_]+$", name), name


def _names():
    from mallsight.plans.catalog import load_all
    return sorted(load_all()[1])


@pytest.mark.parametrize("name", _names())
def test_oracle(spark, name):
    import duckdb  # noqa: F401
    import __spark_entry__ as E
    from oracle_check import duck, rows_of
    df = E.queries()[name](spark, SF_SMALL)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = duck(SF_SMALL).execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, drows)
