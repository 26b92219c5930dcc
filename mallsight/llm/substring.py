"""Removal of word passages that also occur in an earlier document (exact substring dedup).

A window of ``window`` words is removed when the same words also start somewhere in a
document with a smaller id.  Hashing every window would shuffle one row per word, so the
search goes through anchors at difference-cover positions: with a cover ``D`` modulo ``P``,
any two positions i, j have an offset k < P with (i + k) mod P and (j + k) mod P both in D.
Two equal windows therefore share an *aligned* anchor of ``window - P + 1`` words that both
documents hash, and only |D| / P of the positions are hashed (6 / 31 for 50 words).

1. Word digests; texts with equal word sequences form a class, its smallest id stands for it.
2. Distinct anchor hashes of every text, grouped: those that two classes or more hold are kept.
3. At each place of a kept anchor, it extends to the windows that contain it at its aligned
   place; their 128-bit hashes are grouped for the smallest id that starts each.
4. Windows whose smallest id lies below their own document's are removed; other copies in a
   class lose everything when the class has a window at all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHash, beside, free_shuffles, landed, mix64

#: Perfect difference sets by modulus (every residue is a difference of two members).
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 6, 15, 22, 26, 45, 55),
}
#: Classes a task remembers, so that copies it meets again emit no second set of anchors.
SEEN = 200_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_BASE_A, _BASE_B, _SALT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F))


def cover_for(window: int) -> tuple[int, int, tuple[int, ...]]:
    """``(anchor words, period, cover)``: the largest period of at most two thirds of the window."""
    period = max((p for p in COVERS if 3 * p <= 2 * window), default=1)
    return window - period + 1, period, COVERS[period]


class Rolling:
    """Polynomial hashes modulo 2^64 of all ``size``-word windows of a word-hash array."""

    def __init__(self, base: np.uint64):
        self.factors = base, np.uint64(pow(int(base), -1, 2**64))
        self.powers = [np.ones(1, np.uint64)] * 2

    def __call__(self, w: np.ndarray, size: int) -> np.ndarray:
        n = len(w)
        if len(self.powers[0]) < n:
            for i, factor in enumerate(self.factors):
                self.powers[i] = np.full(2 * n, factor, np.uint64)
                self.powers[i][0] = 1
                np.multiply.accumulate(self.powers[i], out=self.powers[i])
        ups, downs = self.powers
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(w * ups[:n], out=sums[1:])
        # equal windows at different places must agree: divide by the power of the start
        return mix64((sums[size:] - sums[:-size]) * downs[:n - size + 1])


def words_of(text) -> list[bytes]:
    return text.split() if text else []


def sequence_key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def class_of(key: bytes) -> int:
    """First eight bytes of a sequence key: the short name of a class in wide exchanges."""
    return int.from_bytes(key[:8], "little", signed=True)


def _digest(batches):
    for batch in batches:
        n, keys, shas = [], [], []
        for text in batch.column("text"):
            ws = words_of(text.as_py())
            joined = b" ".join(ws)
            n.append(len(ws))
            keys.append(xxhash.xxh3_128_digest(joined))
            shas.append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
             pa.array([class_of(k) for k in keys], pa.int64()), pa.array(shas)],
            names=["doc_id", "n_words", "seq_key", "class", "sha"])


def covered_places(n: int, size: int, period: int, cover: tuple[int, ...]) -> np.ndarray:
    """Places of ``size``-word anchors in ``n`` words whose remainder lies in the cover."""
    covered = np.zeros(period, bool)
    covered[list(cover)] = True
    return np.flatnonzero(covered[np.arange(n - size + 1) % period])


def _anchors(window: int):
    size, period, cover = cover_for(window)

    def run(batches):
        words, roll = WordHash(), Rolling(_BASE_A)
        seen: set[bytes] = set()
        for batch in batches:
            hashes, keys = [], []
            for text in batch.column("text"):
                ws = words_of(text.as_py())
                if len(ws) < window:
                    continue
                key = sequence_key(ws)
                if key in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                at = covered_places(len(ws), size, period, cover)
                found = np.unique(roll(words.hashes(ws), size)[at].view(np.int64))
                hashes.append(found)
                keys.append(np.full(len(found), class_of(key)))
            if hashes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hashes, keys)],
                                                 names=["hash", "class"])
    return run


def _windows(window: int):
    size, period, cover = cover_for(window)

    def run(batches):
        words, roll_a, roll_b = WordHash(), Rolling(_BASE_A), Rolling(_BASE_B)
        for batch in batches:
            a, b, docs, parts, starts = [], [], [], [], []
            for text, key, doc, part, hashes in zip(*(batch.column(c) for c in ("text", "seq_key", "doc_id", "part", "hashes"))):
                ws = words_of(text.as_py())
                if len(ws) < window or sequence_key(ws) != key.as_py():
                    continue  # another text under the same id
                w = words.hashes(ws)
                at = covered_places(len(ws), size, period, cover)
                at = at[np.isin(roll_a(w, size)[at].view(np.int64), np.asarray(hashes.values))]
                last = len(ws) - window
                edge = np.zeros(last + 2, np.int64)
                np.add.at(edge, np.maximum(at - (period - 1), 0), 1)
                np.add.at(edge, np.minimum(at, last) + 1, -1)
                start = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                a.append(roll_a(w, window)[start].view(np.int64))
                b.append(roll_b(mix64(w ^ _SALT), window)[start].view(np.int64))
                docs.append(np.full(len(start), doc.as_py()))
                parts.append(np.full(len(start), part.as_py(), np.int32))
                starts.append(start.astype(np.int32))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, docs, parts, starts)],
                                                 names=["h1", "h2", "doc_id", "part", "start"])
    return run


def _cut(window: int):
    def run(batches):
        for batch in batches:
            keys, removed, kept = [], [], []
            for text, key, starts in zip(*(batch.column(c) for c in ("text", "seq_key", "starts"))):
                ws = words_of(text.as_py())
                if sequence_key(ws) != key.as_py():
                    continue
                keys.append(key.as_py())
                edge = np.zeros(len(ws) + 1, np.int64)
                at = np.asarray(starts.values)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                out = np.cumsum(edge[:-1]) > 0
                removed.append(int(out.sum()))
                kept.append(b" ".join(w for w, x in zip(ws, out.tolist()) if not x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(removed, pa.int64()),
                 pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["seq_key", "n_cut", "kept_text", "cut_sha"])
    return run


def repeated_passages(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept_text)`` for every row of ``docs``.

    ``kept_text`` holds the kept words of documents that keep a part of their words, joined
    by single spaces; it is NULL where nothing or everything is removed (``n_removed`` tells).
    NULL texts have no words.  Texts shorter than the window lose nothing.  Rows without an
    id lose nothing and remove nothing.  Rows that repeat an id are each judged by their own
    text; equal ids never remove each other's words.  Empty input gives an empty result;
    other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    digest = landed(base.mapInArrow(_digest, "doc_id long, n_words long, seq_key binary, class long, sha string"), "digest", merge=False)
    named = digest.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    classes = landed(named.groupBy("seq_key", "class").agg(F.min("doc_id").alias("first_id")), "classes")

    # anchors held by two classes or more; a class holds each hash once, so the rows of one
    # hash are at most the classes that hold it
    same = Window.partitionBy("hash")
    shared = (base.filter("doc_id is not null").select("text").mapInArrow(_anchors(window), "hash long, class long")
              .select("hash", "class", F.min("class").over(same).alias("lo"), F.max("class").over(same).alias("hi"))
              .filter("lo <> hi"))
    anchors = landed(shared.groupBy("class").agg(F.collect_set("hash").alias("hashes")), "shared-anchors")
    free_shuffles(spark)

    # ``part`` tells the texts of a repeated id apart (0 elsewhere)
    numbered = F.row_number().over(Window.partitionBy("first_id").orderBy("seq_key")) - 1
    found = landed(classes.withColumn("part", numbered).withColumnRenamed("first_id", "doc_id")
                   .join(anchors, "class").drop("class"), "found")
    # only the texts that hold a kept anchor are shuffled
    wanted = landed(found.select("doc_id").distinct(), "wanted")
    texts = landed(base.join(beside(wanted), "doc_id", "left_semi").join(found, "doc_id"), "passage-texts", merge=False)
    free_shuffles(spark)
    windows = landed(texts.mapInArrow(_windows(window), "h1 long, h2 long, doc_id long, part int, start int"), "windows", merge=False)
    firsts = landed(windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                    .filter("lo <> hi").drop("hi"), "firsts")
    free_shuffles(spark)
    cuts = (windows.join(firsts, ["h1", "h2"]).filter("lo < doc_id")
            .groupBy("doc_id", "part").agg(F.collect_set("start").alias("starts")))
    cut = landed(texts.join(cuts, ["doc_id", "part"]).select("seq_key", "text", "starts")
                 .mapInArrow(_cut(window), "seq_key binary, n_cut long, kept_text string, cut_sha string")
                 .dropDuplicates(["seq_key"]), "cut", merge=False)
    # one narrow row per class, joined once: a large class's rows can then be split over tasks
    verdicts = landed(classes.drop("class").join(cut, "seq_key", "left"), "verdicts")
    free_shuffles(spark)

    copy = F.col("first_id") < F.col("doc_id")
    return (digest.drop("class").join(verdicts, "seq_key", "left")
            .select("doc_id", "n_words",
                    F.when(copy, F.col("n_words")).when(F.col("doc_id").isNull(), 0)
                    .otherwise(F.coalesce("n_cut", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copy, F.lit(EMPTY_SHA)).when(F.col("doc_id").isNull(), F.col("sha"))
                    .otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
                    F.when(~F.coalesce(copy, F.lit(True)), F.col("kept_text")).alias("kept_text")))

