"""Divergence of sources: which sources of a language differ, and by which terms.

Smoothed term probabilities of every (language, source) group are compared with those of the
language (part ``term``) and of the language's other sources (part ``pair``) in whole numbers.

Part ``term`` ranks count cells, not terms: terms of a group that share (group count, language
count) share their value, so the value is computed once a cell; cells of equal value merge into
classes, classes are ranked by the cumulative number of terms before them, and only classes that
reach the first ``top`` ranks are expanded into terms, in UTF-8 order.

Part ``pair`` adds the values of all kept terms for every pair of sources.  Terms meet in chunks:
a task holds one chunk of terms for at most two blocks of sources, merges terms with the same
probabilities into one cell with its multiplicity, and passes on one sum for each pair of sources.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed
from .term_counts import term_counts

#: Probabilities are whole parts of this many.
UNIT = 1_000_000_000
#: Terms in a chunk (on average) and sources in a block of the pair part.
CHUNK_TERMS, SOURCE_BLOCK = 8192, 128
GROUP = ["lang", "source"]


def share(count: str, total: str, kept: str) -> Column:
    """``1 + floor(UNIT * (count + 1) / (total + kept))`` without rounding; NULL when nothing is kept."""
    return F.expr(f"CASE WHEN {kept} > 0 THEN 1 + (CAST({count} + 1 AS DECIMAL(20, 0)) * {UNIT}) "
                  f"div CAST({total} + {kept} AS DECIMAL(20, 0)) END")


def excess(p: str, q: str) -> Column:
    """``floor((p - q)^2 / q)`` in BIGINT (at most 10^18)."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _pair_sums(groups: pa.Table, entries: pa.Table) -> pa.Table:
    """Sums over one chunk of terms of f(g, h) less the value of terms that neither source has."""
    empty = pa.table({"g": pa.array([], pa.int32()), "h": pa.array([], pa.int32()), "part": pa.array([], pa.int64()), "lang": pa.array([], pa.string())})
    if not entries.num_rows or not groups.num_rows:
        return empty
    lang, a, b = (groups[c][0].as_py() for c in ("lang", "a", "b"))
    at, place = np.unique(np.asarray(groups["at"]), return_index=True)
    none = np.asarray(groups["p0"])[place]
    term = pc.dictionary_encode(entries["term"].combine_chunks()).indices
    p = np.tile(none, (len(pc.unique(term)), 1))
    p[np.asarray(term), np.searchsorted(at, np.asarray(entries["at"]))] = np.asarray(entries["p"])
    p, copies = np.unique(p, axis=0, return_counts=True)
    block = at // SOURCE_BLOCK
    out = []
    for left, right in {(a, b), (b, a)}:
        h = np.flatnonzero(block == right)
        q, q0 = p[:, h], none[h]
        for g in np.flatnonzero(block == left):
            value = (p[:, g, None] - q) ** 2 // q - (none[g] - q0) ** 2 // q0
            out += [(int(at[g]), int(at[j]), int(s)) for j, s in zip(h, copies @ value) if j != g]
    if not out:
        return empty
    g, h, s = zip(*out)
    return pa.table({"g": pa.array(g, pa.int32()), "h": pa.array(h, pa.int32()), "part": pa.array(s, pa.int64()),
                     "lang": pa.array([lang] * len(out), pa.string())})


def _pairs(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` of every ordered pair of a language's sources."""
    placed = groups.withColumn("at", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int"))
    placed = landed(placed.select("lang", "source", "total", "kept", share("0L", "total", "kept").alias("p0"), "at",
                                  F.expr(f"ceil(kept / {CHUNK_TERMS})").cast("int").alias("chunks"),
                                  F.expr(f"(count(*) OVER (PARTITION BY lang) - 1) div {SOURCE_BLOCK}").cast("int").alias("last")),
                    "placed-groups")
    mine = F.expr(f"at div {SOURCE_BLOCK}").cast("int")
    met = placed.filter("kept > 0").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last")))) \
        .withColumn("a", F.least(mine, "other")).withColumn("b", F.greatest(mine, "other"))
    sides = met.select("lang", "a", "b", "at", "p0", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    entries = kept.join(met, GROUP).select("lang", "a", "b", "at", "term", share("n", "total", "kept").alias("p"),
                                           F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int").alias("chunk"))
    sides = sides.toDF(*sides.columns)  # columns of its own beside those of ``entries``
    key = ["lang", "chunk", "a", "b"]
    sums = (sides.groupBy(*key).cogroup(entries.groupBy(*key)).applyInArrow(_pair_sums, "g int, h int, part long, lang string")
            .groupBy("lang", "g", "h").agg(F.sum("part").alias("part")))
    own = placed.select("lang", "source", F.col("at").alias("g"), F.col("p0").alias("p"), "kept")
    others = placed.select("lang", F.col("source").alias("item"), F.col("at").alias("h"), F.col("p0").alias("q"))
    return (own.join(others, "lang").filter("g <> h").join(sums, ["lang", "g", "h"], "left")
            .select("lang", "source", "item",
                    F.expr("CASE WHEN kept > 0 THEN kept * (((p - q) * (p - q)) div q) + coalesce(part, 0L) ELSE 0L END").alias("value")))


def _terms(groups: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """``(lang, source, item, value, rank)``: each group's ``top`` over-used terms."""
    cells = (kept.groupBy(*GROUP, "n", "lang_n").agg(F.count("*").alias("terms")).join(groups, GROUP)
             .select(*GROUP, "n", "lang_n", "terms", share("n", "total", "kept").alias("p"), share("lang_n", "lang_total", "kept").alias("q"))
             .filter("p > q").select(*GROUP, "n", "lang_n", "terms", excess("p", "q").alias("value")))
    cells = landed(cells, "count-cells", merge=False)
    falling = Window.partitionBy(*GROUP).orderBy(F.col("value").desc())
    # a class holds a term at least, so the first ``top`` classes of a group are enough
    classes = (cells.groupBy(*GROUP, "value").agg(F.sum("terms").alias("terms"))
               .withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= top)
               .withColumn("before", F.sum("terms").over(falling.rowsBetween(Window.unboundedPreceding, -1)))
               .select(*GROUP, "value", F.coalesce("before", F.lit(0)).alias("before")).filter(F.col("before") < top))
    chosen = landed(cells.join(classes, [*GROUP, "value"]).select(*GROUP, "n", "lang_n", "value", "before"), "chosen-cells")
    within = Window.partitionBy(*GROUP, "value").orderBy("term")
    return (kept.join(chosen, [*GROUP, "n", "lang_n"]).withColumn("place", F.row_number().over(within)).filter(F.col("place") <= top)
            .withColumn("rank", F.col("before") + F.col("place")).filter(F.col("rank") <= top)
            .select(*GROUP, F.col("term").alias("item"), "value", F.col("rank").cast("int")))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every occurring (language, source) group.

    NULL text, language and source count as empty texts.  A language keeps the terms (runs of
    ASCII letters and non-ASCII code points, A-Z lower-cased) that at least ``min_docs`` of its
    rows hold; each row is a document of its own, also when rows repeat.  Part ``pair`` has the
    language's other sources with the sum over all kept terms (0 when none is kept), part ``term``
    the first ``top`` kept terms that the group holds and uses more than its language.  Ranks run
    by falling value, then by rising UTF-8 bytes of the item, so ties are settled.  A group without
    terms has pairs only; a language with one source has no pairs; an empty table gives no rows.
    Other columns are ignored.  Sums stay in BIGINT below 8 * 10^9 kept terms a language.
    """
    base = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counted = landed(term_counts(base, ("lang", "source")), "group-terms", merge=False)
    in_lang = landed(counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                     .filter(F.col("docs") >= min_docs).drop("docs"), "lang-terms", merge=False)
    kept = landed(counted.drop("docs").join(in_lang, ["lang", "term"]), "kept-terms", merge=False)
    of_lang = in_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    of_group = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    groups = landed(base.select(*GROUP).distinct().join(of_group, GROUP, "left").join(of_lang, "lang", "left")
                    .na.fill(0, ["total", "kept", "lang_total"]), "groups")
    ranked = Window.partitionBy(*GROUP).orderBy(F.col("value").desc(), "item")
    pairs = _pairs(groups, kept).withColumn("rank", F.row_number().over(ranked).cast("int"))
    out = [*GROUP, "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*out)
            .unionByName(_terms(groups, kept, top).withColumn("part", F.lit("term")).select(*out)))
