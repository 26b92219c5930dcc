"""Property test: Spark aggregates vs a brute-force pandas statement of the same rules.

Random lines include one order number on several documents with different
dates, NULL dates and names, empty item numbers, so the first-document and
line-date rules are exercised beyond the star data.
"""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from order_lines import lines_df
from mallsight.operators import aggregates as A

DAYS = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (0, 13)] + [None]

line = st.fixed_dictionaries({
    "order_number": st.sampled_from(["a", "b", "c", "", None]),
    "doc": st.integers(0, 5),
    "when": st.sampled_from(DAYS),
    "net": st.integers(0, 1000),
    "qty": st.integers(1, 5),
    "item_number": st.sampled_from(["", "N1", "N2", None]),
    "item_id": st.sampled_from(["i1", "i2", "i3"]),
    "item_name": st.sampled_from(["x", "y", None]),
    "subtotal": st.integers(0, 100),
})


def _rows(draw_lines):
    # lines of one document share the order attributes (number, time, money)
    docs = {}
    rows = []
    for pos, l in enumerate(draw_lines):
        d = docs.setdefault(l["doc"], l)
        rows.append(dict(order_number=d["order_number"], order_datetime=d["when"], order_net_sales=d["net"],
                         total_price=d["net"] + 1, coupon_used=1, quantity=l["qty"], ingest_seq=l["doc"],
                         line_seq=pos, item_number=l["item_number"], item_id=l["item_id"],
                         item_name=l["item_name"], subtotal=l["subtotal"], source="S", mall="R"))
    return rows


def _reference_daily(rows):
    df = pd.DataFrame(rows).sort_values(["ingest_seq", "line_seq", "item_id"], kind="stable")
    df["order_date"] = df["order_datetime"].map(lambda t: t.date() if t is not None else None)
    first = df.drop_duplicates(subset=["order_number"])
    out = {}
    for d, g in first.groupby("order_date", dropna=True):
        out[d] = [g["order_number"].nunique(), int(g["order_net_sales"].sum())]
    for d, g in df.groupby("order_date", dropna=True):
        if d in out:
            out[d].append(int(g["quantity"].sum()))
    return out


def _reference_products(rows):
    df = pd.DataFrame(rows).sort_values(["ingest_seq", "line_seq", "item_id"], kind="stable")
    key = df["item_number"].fillna("").replace("", pd.NA).fillna(df["item_id"])
    df = df.assign(_k=key)
    out = {}
    for k, g in df.groupby("_k"):
        names = g["item_name"].dropna()
        out[k] = (names.iloc[0] if len(names) else None, int(g["quantity"].sum()), int(g["subtotal"].sum()),
                  g["order_number"].nunique())
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line, min_size=1, max_size=14))
def test_daily_and_products_match_brute_force(spark, drawn):
    rows = _rows(drawn)
    df = lines_df(spark, rows)
    got = {r.date: [r.order_count, r.total_sales, r.item_count] for r in A.daily_sales(df).collect()}
    assert got == _reference_daily(rows)
    prods = {r["_group_key"]: (r.item_name, r.quantity, r.total_sales, r.order_count)
             for r in A.product_sales(df).collect()}
    assert prods == _reference_products(rows)
