"""Paths of the small tables and canonical order lines from partial rows, for the test modules."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def lines_df(spark, rows):
    """Canonical order lines from partial dicts (missing columns -> NULL)."""
    from mallsight.functions.time import with_time_parts
    from mallsight.schema import ORDER_LINE, ORDER_LINE_COLUMNS
    full = [tuple(r.get(c) for c in ORDER_LINE_COLUMNS) for r in rows]
    df = spark.createDataFrame(full, ORDER_LINE)
    return with_time_parts(df).select(*ORDER_LINE_COLUMNS)
