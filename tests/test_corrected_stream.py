"""Streaming totals with late copies: any order of files gives what a batch over all documents gives."""

import datetime as dt
import json
import os
import random

import pytest

from mallsight.streaming import closed_totals, corrections, current_totals, run_with_corrections
from mallsight.streaming.corrected import SUMS


def _doc(num, day, units=(1,), seq=0, status=100, goods=1000, coupon=100):
    return {"orderNumber": num, "orderDatetime": day and f"2024-01-{day:02d}T10:00:00+0900", "orderProgress": status,
            "goodsPrice": goods, "couponAllTotalPrice": coupon, "_ingest_seq": seq,
            "PackageModelList": [{"ItemModelList": [{"itemId": "i", "price": 1, "units": u} for u in units]}]}


def _land(folder, files):
    """One file a list, in this order of arrival."""
    folder.mkdir(exist_ok=True)
    at = len(list(folder.iterdir()))
    for i, docs in enumerate(files, at):
        p = folder / f"f{i}.json"
        p.write_text("\n".join(json.dumps(d) for d in docs))
        os.utime(p, (1e9 + i, 1e9 + i))


def _batch(docs):
    """Totals by day of the lowest document of each number, by plain Python."""
    best = {}
    for d in docs:
        items = [x["units"] for x in d["PackageModelList"][0]["ItemModelList"]]
        if d["orderProgress"] == 900 or not d["orderDatetime"] or not items:
            continue
        seq = d["_ingest_seq"] if d["_ingest_seq"] is not None else 1 << 63
        doc = (seq, d["orderDatetime"], d["goodsPrice"] or 0, d["couponAllTotalPrice"] or 0, sum(items))
        num = d["orderNumber"] or ""
        best[num] = min(best.get(num, doc), doc)
    days = {}
    for _, at, goods, coupon, units in best.values():
        t = days.setdefault(dt.date.fromisoformat(at[:10]), [0] * 5)
        for i, v in enumerate((1, goods - coupon, goods, coupon, units)):
            t[i] += v
    return {k: tuple(v) for k, v in days.items()}


def _by_day(df):
    return {r.date: tuple(r[c] for c in SUMS) for r in df.collect()}


def _random_docs(rng):
    docs = [_doc(rng.choice(["a", "b", "c", "d", "", None, "hot", "hot", "hot"]), rng.choice([1, 2, 3, 9, 20, None]),
                 rng.choice([(1,), (2, 3), ()]), rng.choice([*range(50), None]), rng.choice([100, 100, 100, 900]),
                 rng.choice([500, 1000, None]), rng.choice([0, 100, None])) for _ in range(60)]
    return docs + docs[:10] + [_doc(f"n{i}", 1 + i % 20, seq=i) for i in range(30)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_file_order_equals_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    docs = _random_docs(rng)
    rng.shuffle(docs)
    _land(tmp_path / "in", [docs[i::4] for i in range(4)])
    out = run_with_corrections(spark, str(tmp_path / "in"), str(tmp_path / "sink"), str(tmp_path / "ck"), 1)
    assert _by_day(current_totals(out)) == _batch(docs)
    # closed totals and corrections together are the current totals of the closed days
    closed = _by_day(closed_totals(out))
    for r in corrections(out).collect():
        closed[r.date] = tuple(a + r[c] for a, c in zip(closed.get(r.date, (0,) * 5), SUMS))
    whole = _batch(docs)
    assert closed and all(whole.get(d, (0,) * 5) == t for d, t in closed.items())


def test_closed_day_keeps_its_total_and_a_rerun_adds_only_new_files(spark, tmp_path):
    src, sink, ck = str(tmp_path / "in"), str(tmp_path / "sink"), str(tmp_path / "ck")
    _land(tmp_path / "in", [[_doc("a", 1, seq=5), _doc("b", 1, seq=6)], [_doc("c", 9, seq=7)]])
    out = run_with_corrections(spark, src, sink, ck, 1)
    first = [tuple(r) for r in closed_totals(out).collect()]
    assert first == [(dt.date(2024, 1, 1), 1, 2, 1800, 2000, 200, 2)] and corrections(out).count() == 0
    assert run_with_corrections(spark, src, sink, ck, 1).count() == out.count()          # nothing new
    # an older copy that moves order a, and a new order of the closed day
    _land(tmp_path / "in", [[_doc("a", 2, (2,), seq=1, goods=500)], [_doc("z", 1, seq=9), _doc("a", 1, seq=5)]])
    out = run_with_corrections(spark, src, sink, ck, 1)
    assert [tuple(r) for r in closed_totals(out).collect()] == first
    got = sorted((r.date.day, r.batch_id, r.order_count, r.total_sales, r.item_count) for r in corrections(out).collect())
    assert got == [(1, 2, -1, -900, -1), (1, 3, 1, 900, 1), (2, 2, 1, 400, 2)]
    assert _by_day(current_totals(out)) == {dt.date(2024, 1, 1): (2, 1800, 2000, 200, 2), dt.date(2024, 1, 2): (1, 400, 500, 100, 2),
                                            dt.date(2024, 1, 9): (1, 900, 1000, 100, 1)}


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = run_with_corrections(spark, str(tmp_path / "in"), str(tmp_path / "sink"), str(tmp_path / "ck"))
    assert out.count() == closed_totals(out).count() == corrections(out).count() == 0
