"""Mixing sources to target weights.

Every row gets a hash-random key; within a source, rows in key order are cut at the
source's exact budget of words.  The order is never materialised whole: the key space of a
source splits into ``ranges`` equal ranges (even, because keys are hashes), range totals
give the words before each range, and only a range's own rows are sorted together.  A
budget above the source's size first takes whole epochs and cuts the last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import word_count

#: Ranges of the key space per source; each is one sorted group (1 / 4096 of a source).
RANGES = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, limit: int) -> DataFrame:
    """``(source, source_size, target, budget)`` from ``sizes(source, source_size)``.

    The total target is ``percent`` % of all sizes.  Sources in code-point order (NULL last)
    weigh ``weights`` repeating.  A target stops at ``limit`` times its source's size and the
    excess is shared again by weight: that fixpoint is ``min(cap, level * weight)`` for the
    one level that spends the total, found by taking sources in order of cap / weight.
    One row per source: the two windows over all of them hold a row for each source only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod(rank, F.lit(len(weights))) + 1)
    s = sizes.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * limit)
    by_ratio = Window.orderBy((F.col("cap").cast("double") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    since = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    # left: 100 * words still to share among the sources from here on
    s = (s.withColumn("left", F.sum("source_size").over(everything) * percent
                      - 100 * F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("w_left", F.sum("w").over(since))
         .withColumn("open", F.col("left") * F.col("w") < 100 * F.col("cap") * F.col("w_left"))
         .withColumn("n_capped", F.coalesce(F.min(F.when(F.col("open"), F.row_number().over(by_ratio)))
                                            .over(everything), F.lit(2**31 - 1)))
         .withColumn("place", F.row_number().over(by_ratio)))
    level = [F.max(F.when(F.col("place") == F.col("n_capped"), F.col(c))).over(everything) for c in ("left", "w_left")]
    target = F.when(F.col("place") < F.col("n_capped"), F.col("cap").cast("double")).otherwise(
        F.col("w").cast("double") * level[0].cast("double") / (F.lit(100.0) * level[1].cast("double")))
    return (s.withColumn("target", target)
            .select("source", "source_size", "target", F.floor(F.col("target") + 0.5).cast("long").alias("budget")))


def random_key(id_col: Column, seed: str) -> Column:
    """Hash-random key of a row's id: 32 hex digits, the same on every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, limit: int = 2,
        seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, copies, carry...)``, a row for every input row.

    ``size`` is the number of words, ``taken`` the words the mix takes of the row, repeats
    counted: whole epochs plus the row's part of the last one.  Per source ``taken`` sums to
    the target, rounded to whole words; one row at most is cut.  ``copies`` is the same mix in
    whole documents: the row at the cut counts when at least half of it fits.  Rows are ordered by random
    key, then id, then size, so reruns agree; rows equal in all three are interchangeable.
    NULL texts have size 0 and NULL sources form one source, last in order.  Empty input
    gives an empty result.  ``carry`` names further columns to keep (a struct ``carried``).
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), random_key(F.col(id_col), seed).alias("key"),
                       *([F.struct(*carry).alias("carried")] if carry else []))
    base = base.withColumn("range", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * RANGES / F.lit(2**32)) \
        .withColumn("range", F.floor("range").cast("int"))
    ranges = base.groupBy("source", "range").agg(F.sum("size").alias("words"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, percent, limit)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
              .withColumnRenamed("source", "s")
              .join(targets, F.col("s").eqNullSafe(F.col("source"))).drop("source")
              .select(F.col("s").alias("r_source"), F.col("range").alias("r_range"), "start", "source_size", "target", "budget"))
    within = Window.partitionBy("source", "range").orderBy("key", F.col("doc_id").asc_nulls_first(), "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = base.join(starts, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
    before = F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    return (rows.withColumn("before", before).withColumn("epochs", epochs)
            .withColumn("taken", F.col("epochs") * F.col("size")
                        + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before"))))
            .withColumn("copies", F.col("epochs") + F.when((rest > 0) & (2 * F.col("before") + F.col("size") <= 2 * rest), 1)
                        .otherwise(0))
            .select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"),
                    F.col("copies").cast("int").alias("copies"),
                    *(["carried"] if carry else [])))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, limit: int = 2,
                    seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix as documents: each row of ``docs`` as often as ``copies`` says (columns of ``docs``)."""
    rows = mix(docs, weights, percent, limit, seed, id_col, text_col, source_col, carry=tuple(docs.columns))
    return (rows.filter("copies > 0").select("carried", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("carried.*"))
