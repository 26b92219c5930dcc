"""Removal of lines that many distinct sites share (boilerplate), by distinct-site spread.

A line is boilerplate when it occurs on at least ``sites`` distinct sites.  HyperLogLog
sketches of the sites, one per line hash, merge by aggregation; they decide the lines whose
estimate is clear of the threshold, and lines near it get an exact distinct count.  Only
DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import landed

#: log2 of the sketch's registers; relative standard error 1.04 / sqrt(2^12) = 1.6 %.
LG_K = 12
#: Half-width of the band that is counted exactly, in standard errors.
BAND = 6


def lines_of(text: Column) -> Column:
    """Lines of a text (separated by LF), without blanks, tabs and CR at their ends."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))


def spread_lines(lines: DataFrame, sites: int) -> DataFrame:
    """Hashes ``(h1, h2)`` of the lines of ``lines(h1, h2, site)`` found on ``sites`` sites or more."""
    error = 1.04 / 2 ** (LG_K / 2)
    low, high = sites * (1 - BAND * error) - 0.5, sites * (1 + BAND * error) + 0.5
    # a line on enough sites occurs at least as often: single lines need no sketch
    often = landed(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= sites)
                   .select("h1", "h2"), "frequent-lines")
    seen = lines.join(often, ["h1", "h2"])
    # sketches ignore empty texts, so they take a hash of the site; '' is a site, NULL is none
    site = F.when(F.col("site").isNotNull(), F.xxhash64("site"))
    sketches = landed(seen.groupBy("h1", "h2").agg(F.hll_sketch_agg(site, LG_K).alias("sketch"))
                      .select("h1", "h2", F.hll_sketch_estimate("sketch").alias("estimate")), "site-spread")
    near = sketches.filter(F.col("estimate").between(low, high)).select("h1", "h2")
    exact = (lines.join(near, ["h1", "h2"]).filter(F.col("site").isNotNull()).select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("h1", "h2"))
    return sketches.filter(F.col("estimate") > high).select("h1", "h2").unionByName(exact)


def drop_boilerplate(docs: DataFrame, sites: int = 4, id_col: str = "doc_id", text_col: str = "text",
                     site_col: str = "source") -> DataFrame:
    """``(doc_id, n_lines, n_removed, text)`` for every row of ``docs``: its lines without boilerplate.

    Lines are compared without blanks, tabs and CR at their ends and kept as they are; empty
    lines are never removed.  Rows without a site lend no site to a line but lose boilerplate
    too.  NULL texts have no lines and stay NULL.  Rows that repeat an id are each judged by
    their own text (and removed lines depend on the text alone).  Empty input gives an empty
    result; other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(site_col).alias("site"))
    one = F.explode(F.array_distinct(lines_of(F.col("text")))).alias("line")
    hashed = (F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))
    lines = base.select("site", one).filter("line <> ''").select(*hashed, "site")
    bad = landed(spread_lines(lines, sites), "boilerplate")
    # which texts hold which boilerplate lines: joined by line hash, gathered by text digest
    text_key = F.md5(F.col("text"))
    # landed, so that the join below has plain exchanges and a large group of copies can be split
    held = landed(base.filter("text is not null").select(text_key.alias("text_key"), one).filter("line <> ''")
                  .select("text_key", *hashed, "line").join(bad, ["h1", "h2"])
                  .groupBy("text_key").agg(F.collect_set("line").alias("bad")), "held-lines")
    raw = F.split(F.col("text"), "\n")
    keep = F.filter(raw, lambda x: F.col("bad").isNull() | ~F.array_contains("bad", F.btrim(x, F.lit(" \t\r"))))
    return (base.select("doc_id", "text", text_key.alias("text_key")).join(held, "text_key", "left")
            .select("doc_id", F.coalesce(F.size(raw), F.lit(0)).cast("long").alias("n_lines"), "text", keep.alias("kept"))
            .select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
                    F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"),
                    F.when(F.col("text").isNotNull(), F.array_join("kept", "\n")).alias("text")))
