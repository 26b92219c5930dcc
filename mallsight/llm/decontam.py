"""Benchmark decontamination: short test items found inside long documents.

MinHash containment with size partitions.  For a random permutation the smallest shingle of
an item lies in a document with probability equal to the item's containment, however long
the document is; a Jaccard signature of the document would drown a short item.  Items are
partitioned by their number of shingles: small items keep all shingles, larger ones the
minima of a number of permutations that grows with the partition.  A partition also fixes
how many minima a document must hold, by its chosen miss probability.  Documents are probed
shingle by shingle against the minima, documents with too few words for the containment are
ruled out by size, and the candidates left are verified on all shingles.  Only DataFrame
functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, landed

#: Size partitions of the items: (most shingles, permutations).  None: all shingles are kept; open end.
PARTITIONS = ((16, None), (64, 24), (None, 48))


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    spaced = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def shingles(words: str, width: int) -> Column:
    """64-bit hashes of the ``width``-word shingles of an array column (too short: none)."""
    return F.when(F.size(words) >= width, F.transform(
        F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, width)))) \
        .otherwise(F.array().cast("array<bigint>"))


def needed(n: int, containment: float, miss: float) -> int:
    """Most minima that a document of the containment fails to hold with probability <= miss, plus one.

    Of ``n`` minima it holds Binomial(n, containment) many."""
    below = 0.0
    for m in range(n + 1):
        below += math.comb(n, m) * containment**m * (1 - containment) ** (n - m)
        if below > miss:
            return max(m, 1)
    return n


def contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80, miss: float = 1e-6,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, item_shingles, shared)``: documents that hold ``percent`` % of an item's shingles.

    Words are lower-cased runs of letters and digits.  Items of fewer than ``shingle`` words
    are one shingle of all their words and match documents that hold that sequence; items
    without words match nothing.  NULL texts have no words; rows without an id take no part;
    rows that repeat an id (with any text) count as one document or item that holds the
    shingles of all of them.  Empty tables give an empty result; other columns are ignored.
    """
    item = (items.filter(F.col(item_col).isNotNull())
            .select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col)).alias("words"))
            .withColumn("width", F.least(F.size("words"), F.lit(shingle))).filter("width > 0"))
    widths = sorted(r.width for r in item.select("width").distinct().collect())  # at most ``shingle`` values
    # every width of the items has its own shingles, on both sides
    by_width = [F.when(F.col("width") == k, shingles("words", k)) for k in widths] or [F.array().cast("array<bigint>")]
    of_item = landed(item.select("item_id", F.explode(F.coalesce(*by_width)).alias("sh")).distinct(), "item-shingles")
    sizes = of_item.groupBy("item_id").agg(F.count("*").alias("n"))

    # minima of each item with the number of permutations they stand for, and the number needed
    perms = need = None
    for limit, n in reversed(PARTITIONS):
        p = F.col("n") * 0 if n is None else F.lit(n)
        m = F.ceil(F.col("n") * percent / 100) if n is None else F.lit(needed(n, percent / 100, miss))
        inside = F.lit(True) if limit is None else F.col("n") <= limit
        perms = F.when(inside, p) if perms is None else F.when(inside, p).otherwise(perms)
        need = F.when(inside, m) if need is None else F.when(inside, m).otherwise(need)
    sized = of_item.join(sizes, "item_id").withColumn("perms", perms).withColumn("need", need.cast("long"))
    whole = sized.filter("perms = 0").select("item_id", "sh", F.lit(1).cast("long").alias("weight"), "need", "n")
    sampled = (sized.filter("perms > 0").withColumn("perm", F.explode(F.sequence(F.lit(1), F.col("perms").cast("int"))))
               .groupBy("item_id", "perm", "need", "n")
               .agg(F.min_by("sh", F.struct(F.xxhash64("perm", "sh"), "sh")).alias("sh"))
               .groupBy("item_id", "sh", "need", "n").agg(F.count("*").alias("weight"))
               .select("item_id", "sh", "weight", "need", "n"))
    minima = landed(whole.unionByName(sampled), "item-minima")

    base = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    worded = base.select("doc_id", words_of(F.col("text")).alias("words"))

    def doc_shingles(df):
        arrays = [shingles("words", k) for k in widths] or [F.array().cast("array<bigint>")]
        return df.select("doc_id", F.size("words").alias("n_words"),
                         F.explode(F.array_distinct(F.concat(*arrays))).alias("sh"))

    hits = (doc_shingles(worded).join(beside(minima), "sh")
            .filter(F.col("n_words") * 100 >= F.col("n") * percent)  # the size rule
            .select("doc_id", "item_id", "sh", "weight", "need").distinct())
    pairs = landed(hits.groupBy("doc_id", "item_id", "need").agg(F.sum("weight").alias("held"))
                   .filter("held >= need").select("doc_id", "item_id"), "candidate-pairs")
    # exact containment of the candidate pairs
    found = (doc_shingles(worded.join(beside(landed(pairs.select("doc_id").distinct(), "candidates")), "doc_id")).select("doc_id", "sh").distinct()
             .join(beside(of_item), "sh").join(pairs, ["doc_id", "item_id"])
             .groupBy("doc_id", "item_id").agg(F.count("*").alias("shared")))
    return (found.join(sizes, "item_id").filter(F.col("shared") * 100 >= F.col("n") * percent)
            .select("doc_id", "item_id", F.col("n").alias("item_shingles"), "shared"))


def drop_contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item (columns of ``docs``)."""
    bad = landed(contaminated(docs, items, shingle, percent, id_col=id_col, text_col=text_col)
                 .select(F.col("doc_id").alias("__bad_id")).distinct(), "contaminated")
    return docs.join(beside(bad), F.col(id_col) == F.col("__bad_id"), "left_anti")
