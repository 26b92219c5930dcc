"""Period results from published day states (AGG9-AGG11) and completeness of paged reads (SRC3)."""

import datetime as dt
import random

from order_lines import lines_df

from mallsight.operators import aggregates as A
from mallsight.operators import day_states as S
from mallsight.sources import readers as R

DAY = dt.datetime(2024, 1, 1)


def many_lines(r, n):
    rows = []
    for seq in range(n):
        number, store = r.choice([f"o{i}" for i in range(60)] + [None]), r.choice(("S1", "S2", None))
        day, net = DAY + dt.timedelta(days=r.randint(0, 9), hours=r.randint(0, 23)), r.choice((None, 100, 250, -50))
        rows += [dict(order_number=number, source=store, order_datetime=day, order_net_sales=net, total_price=r.randint(0, 500),
                      quantity=r.choice((None, 1, 3)), ingest_seq=seq, line_seq=k, item_id=f"i{k}") for k in range(r.randint(1, 3))]
    return rows


def test_any_period_equals_the_lines(spark, tmp_path):
    r = random.Random(2)
    lines = lines_df(spark, many_lines(r, 250)).cache()
    root = str(tmp_path / "states")
    assert all(S.write_day_states(lines, root).values())
    days = [DAY.date() + dt.timedelta(days=i) for i in range(-1, 11)]
    periods = [(None, None), (days[3], None), (None, days[4]), (days[0], days[0])] + [tuple(sorted(r.sample(days, 2))) for _ in range(5)]
    for start, end in periods:
        got, want = S.period_kpi(spark, root, start, end).first(), A.period_kpi(lines, start, end).first()
        assert (got.sales, got.orders, got.items) == (want.sales, want.orders, want.items), (start, end)
        got = {x.source: tuple(x)[1:] for x in S.period_kpi(spark, root, start, end, ("source",)).collect()}
        want = {x.source: tuple(x)[1:] for x in A.period_kpi(lines, start, end, group=("source",)).collect()}
        assert got == want, (start, end)
    got, want = S.summary_stats(spark, root).first(), A.summary_stats(lines).first()
    assert (got.total_sales, got.gross_sales, got.total_items) == (want.total_sales, want.gross_sales, want.total_items)
    lines.unpersist()


def test_states_of_nothing(spark, tmp_path):
    root = str(tmp_path / "none")
    assert not any(S.write_day_states(lines_df(spark, []), root).values())
    assert tuple(S.period_kpi(spark, root, None, None).first()) == (0, 0, 0)
    assert S.period_kpi(spark, root, None, None, ("source",)).collect() == []


def test_repeats_hold_only_orders_of_several_days_or_stores(spark):
    rows = [dict(order_number=n, source=s, order_datetime=DAY + dt.timedelta(days=d), order_net_sales=10, total_price=10, quantity=1, ingest_seq=i, line_seq=0)
            for i, (n, s, d) in enumerate([("a", "S1", 0), ("a", "S1", 0), ("b", "S1", 0), ("b", "S2", 0), ("c", "S1", 1), ("c", "S1", 2)])]
    states = S.day_states(lines_df(spark, rows))
    assert states["repeats"].count() == 4 and states["marks"].count() == 4
    assert {(x.date.day, x.source): (x.order_net_sales, x["items"]) for x in states["days"].collect()} == \
        {(1, "S1"): (10, 3), (1, "S2"): (None, 1), (2, "S1"): (None, 1), (3, "S1"): (None, 1)}


def gaps(spark, rows):
    return sorted(tuple(x) for x in R.page_gaps(spark.createDataFrame(rows, "chain string, page long, total_pages long")).collect())


def test_page_gaps(spark):
    rows = [("a", 2, 9), ("a", 3, 9), ("a", 3, 9), ("a", 6, None), ("b", 1, 1), ("c", 1, None), ("c", 4, None), ("d", 5, 3), ("d", None, 3)]
    assert gaps(spark, rows) == [("a", "missing", 1, 1, 1), ("a", "missing", 4, 5, 2), ("a", "missing", 7, 9, 3), ("a", "repeated", 3, 3, 2),
                                 ("c", "missing", 2, 3, 2), ("d", "beyond", 5, 5, 1), ("d", "missing", 1, 3, 3)]
    assert gaps(spark, []) == []


def test_unreadable_pages_are_set_aside(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"chain": "x", "page": 1, "orderNumberList": ["1", "2"], "PaginationResponseModel": {"totalPages": 3}}\n'
                                     '{"chain": "x", "page": 2, "orderNumb\n{"chain": "x", "page": 3, "orderNumberList": null}\n')
    pages, bad = R.read_search_pages_checked(spark, str(tmp_path))
    assert pages.count() == 2 and [b.file_name for b in bad.collect()] == ["p.json"]
    assert sorted(x.order_number for x in R.read_search_pages(spark, str(tmp_path)).collect()) == ["1", "2"]
    assert R.read_search_pages_checked(spark, str(tmp_path / "none"))[1].count() == 0
