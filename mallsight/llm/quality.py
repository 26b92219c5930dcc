"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its hashed features: words, character
n-grams of words (over UTF-8 bytes, with word ends marked), and word pairs (a word that
repeats its predecessor is one feature of its own).  A softmax over the average gives the class; vectors and output weights are trained
together by plain stochastic gradient descent in numpy on a bounded sample of the labelled
documents.  Because both layers are linear, scoring needs one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CACHE, landed, mix64

#: Documented bound of the training sample: labelled documents, smallest id hashes first.
TRAIN_DOCS = 2000
BUCKETS = 2**17     # a power of two; bucket BUCKETS is that of a word that repeats its predecessor
DIM, EPOCHS, RATE = 12, 6, 0.6
GRAMS = (2, 3, 4)
#: Words that a scoring task gathers before it computes their texts' scores.
CHUNK_WORDS = 200_000
_PAIR, _MASK = np.uint64(0xD6E8FEB86659FD93), np.uint64(BUCKETS - 1)


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word; and, per feature of the words, the word's place and the bucket.

    Features are the word itself and the n-grams of ``<word>``, computed for all words at once.
    """
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    text = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    left = np.cumsum(size)[word] - np.arange(len(text))      # bytes from here to the word's end
    places, buckets = [np.arange(len(words))], [(mix64(h) & _MASK).astype(np.int64)]
    code = text
    for n in range(2, max(GRAMS) + 1):
        code = code[:-1] | (text[n - 1:] << np.uint64(8 * (n - 1)))
        if n in GRAMS:
            at = np.flatnonzero(left[:len(code)] >= n)
            places.append(word[at])
            buckets.append((mix64(code[at] + np.uint64(n << 40)) & _MASK).astype(np.int64))
    return h, np.concatenate(places), np.concatenate(buckets)


def pair_buckets(h: np.ndarray) -> np.ndarray:
    """Bucket of every pair of neighbouring words."""
    return np.where(h[:-1] == h[1:], BUCKETS, (mix64(h[:-1] * _PAIR + h[1:]) & _MASK).astype(np.int64))


class Vocabulary(dict):
    """Numbers words as they come; ``pending`` are those without features yet."""

    def __init__(self):
        super().__init__()
        self.pending: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        self.pending.append(word)
        return k

    def numbers(self, text: bytes | None) -> np.ndarray:
        words = text.split() if text else []
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def bag(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their shares of all its features."""
    words = Vocabulary()
    k = words.numbers(text)
    if not len(k):
        return np.empty(0, np.int32), np.empty(0, np.float32)
    h, place, bucket = word_grams(words.pending)
    pairs = pair_buckets(h[k])
    weight = np.concatenate([np.bincount(k)[place], np.ones(len(pairs), np.int64)])
    buckets, inverse = np.unique(np.concatenate([bucket, pairs]), return_inverse=True)
    n = np.bincount(inverse, weights=weight)
    return buckets.astype(np.int32), (n / n.sum()).astype(np.float32)


def _bags(batches):
    for batch in batches:
        bags = [bag(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.array([b for b, _ in bags], pa.list_(pa.int32())), pa.array([s for _, s in bags], pa.list_(pa.float32()))],
            names=["doc_id", "label", "buckets", "shares"])


@dataclass
class Model:
    """Per feature bucket its contribution to the log odds of label 1, and the bias."""
    weights: np.ndarray
    bias: float

    def scorer(self):
        """Column function: text (binary) -> probability of label 1."""
        weights, bias = self.weights.astype(np.float64), self.bias

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            words = Vocabulary()
            known = [np.empty(0, t) for t in (np.uint64, np.float64, np.int64)]  # hash, sum of weights, features

            def logits(texts: list[np.ndarray]) -> list[float]:
                if words.pending:
                    h, place, bucket = word_grams(words.pending)
                    n = len(words.pending)
                    new = h, np.bincount(place, weights[bucket], n), np.bincount(place, minlength=n)
                    known[:] = [np.concatenate(x) for x in zip(known, new)]
                    words.pending.clear()
                h, total, count = known
                out = []
                for k in texts:
                    pairs = weights[pair_buckets(h[k])]
                    out.append(bias + (total[k].sum() + pairs.sum()) / max(1, count[k].sum() + len(pairs)))
                if len(words) > WORD_CACHE:
                    words.clear()
                    known[:] = [x[:0] for x in known]
                return out

            for batch in batches:
                out, chunk, n = [], [], 0
                for text in batch:
                    chunk.append(words.numbers(text))
                    n += len(chunk[-1])
                    if n >= CHUNK_WORDS:
                        out += logits(chunk)
                        chunk, n = [], 0
                out += logits(chunk)
                yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -50, 50))))
        return score


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """Train by stochastic gradient descent, one document a step, with a falling rate.

    No examples: every score is 0.5."""
    rng = np.random.default_rng(seed)
    vec = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 1, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, at = EPOCHS * len(labels), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(labels)):
            rate = RATE * (1 - at / steps)
            at += 1
            b, s = bags[i]
            hidden = s @ vec[b]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= 0.1 * rate * p
            if len(b):
                # a document's features move together: scale the step by their spread
                vec[b] -= (rate / np.sqrt(s @ s)) * np.outer(s, back)
    return Model((vec @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])) if len(labels) \
        else Model(np.zeros(BUCKETS + 1, np.float32), 0.0)


def _fit_task(batches):
    """Train in one task on the rows of the sample (in id order); one row with the model."""
    bags, labels = [], []
    for batch in batches:
        for b, s, y in zip(batch.column("buckets"), batch.column("shares"), batch.column("label")):
            bags.append((np.array(b.values), np.array(s.values)))
            labels.append(y.as_py())
    model = fit(bags, np.array(labels, np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])],
                                     names=["weights", "bias"])


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 modulo 3 (NULL ids: not held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", train_docs: int = TRAIN_DOCS,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``train_docs`` labelled documents that are not held out.

    The sample is the documents of smallest id hash, the same on every run; of repeated labels
    the smallest counts, NULL labels and ids are left out.  Features are computed where the
    texts are; one task trains on them, and the driver receives the model alone.
    """
    known = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    present = docs.select(F.col(id_col).alias("doc_id")).distinct()
    sample = landed(known.join(present, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs),
                    "training-ids")  # train_docs rows at most
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")) \
        .join(F.broadcast(sample), "doc_id")
    found = texts.mapInArrow(_bags, "doc_id long, label int, buckets array<int>, shares array<float>")
    row = (found.repartition(1).sortWithinPartitions("doc_id", "buckets")
           .mapInArrow(_fit_task, "weights binary, bias double").first())
    return Model(np.frombuffer(row.weights, np.float32), row.bias) if row else fit([], np.empty(0, np.int64))


def score_documents(docs: DataFrame, labels: DataFrame, label_col: str = "quality", train_docs: int = TRAIN_DOCS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier), ``predicted`` and ``held_out``.

    Every row's whole text is scored by its words alone; id, source and language are no inputs.
    NULL, empty and blank texts get the score of the bias.  Rows that repeat an id are each
    scored.  Without any label every score is 0.5.  Existing columns of the three names are
    replaced; other columns stay.
    """
    model = train(docs, labels, label_col, train_docs, id_col, text_col)
    return (docs.withColumn("score", model.scorer()(F.col(text_col).cast("binary")))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .withColumn("held_out", held_out(F.col(id_col))))


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", train_docs: int = TRAIN_DOCS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below 0.5 (columns of ``docs``)."""
    model = train(docs, labels, label_col, train_docs, id_col, text_col)
    return docs.filter(model.scorer()(F.col(text_col).cast("binary")) >= 0.5)
