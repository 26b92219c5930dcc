"""Cross-aggregate invariants: the same money seen through every grouping."""

from pyspark.sql import functions as F

from order_lines import SF_MID
from mallsight.operators import aggregates as A
from mallsight.sources.adapters import event_lines, star_lines


def _sum(df, c):
    return df.agg(F.sum(c)).first()[0]


def test_totals_agree_across_groupings(spark):
    for lines in (star_lines(spark, SF_MID, product=False, store=False), event_lines(spark, SF_MID)):
        total = A.summary_stats(lines).first()
        assert _sum(A.daily_sales(lines), "total_sales") == total.total_sales
        assert _sum(A.monthly_sales(lines), "total_sales") == total.total_sales
        assert _sum(A.hourly_sales(lines), "total_sales") == total.total_sales
        assert _sum(A.weekday_sales(lines), "total_sales") == total.total_sales
        heat = A.hour_weekday_heatmap(lines)
        assert sum(_sum(heat, c) for c in heat.columns[1:]) == total.total_sales
        assert _sum(A.daily_sales(lines), "item_count") == total.total_items
        assert _sum(A.monthly_sales(lines), "order_count") == total.total_orders


def test_store_sums_equal_total_when_numbers_are_store_unique(spark):
    lines = star_lines(spark, SF_MID, product=False)
    stats = A.total_and_store_stats(lines)
    total = stats.filter("scope = 'total'").first()
    per = stats.filter("scope = 'store'")
    assert _sum(per, "total_sales") == total.total_sales and _sum(per, "total_orders") == total.total_orders


def test_order_number_exchanges_in_daily(spark):
    """Lines by (order, day), then the reduced rows by order; the facts are joined once."""
    df = A.daily_sales(star_lines(spark, SF_MID, product=False, store=False))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(order_number") <= 2
    assert plan.count("Join") == 1
