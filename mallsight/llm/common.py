"""Helpers shared by the training-data operators: words, hashing, written intermediates.

A *word* is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  ``bytes.split()``
separates on exactly that set, so Python tasks receive texts as UTF-8 bytes.
"""

from __future__ import annotations

import atexit
import gc

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import unique_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Entries a task keeps in its word cache before starting afresh (bounds worker memory).
WORD_CACHE = 100_000

#: Files of a landed table, at most, for each core of the cluster.
FILES_PER_CORE = 4

_LANDED: list[tuple[SparkSession, str]] = []


def landed(df: DataFrame, label: str, merge: bool = True) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back (cuts lineage).

    The folder is the one ``spark.checkpoint.dir`` names, so a lost executor costs only
    the tasks it was running.  Partitions merge to a few per core, so that narrow tables do
    not become thousands of files; with ``merge`` off the plan's own partitions are written, whose
    size does not grow with the table.  Tables go when ``release`` is called or the driver ends.
    """
    spark = df.sparkSession
    path = unique_dir(spark, f"llm-{label}")
    _LANDED.append((spark, path))
    (df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism) if merge else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Delete every landed table; results that still read one must be written first."""
    while _LANDED:
        spark, path = _LANDED.pop()
        if spark.sparkContext._jsc is not None:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


atexit.register(release)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's context cleaner drop the shuffle files of finished phases.

    The cleaner acts when the driver's garbage is collected, by default every half
    hour; phases that landed their result need their shuffle files no longer.
    """
    gc.collect()
    spark._jvm.System.gc()


#: Rows (two BIGINTs wide at most) up to which a join broadcasts a counted side, about 40 MB.
BROADCAST_ROWS = 500_000


def beside(df: DataFrame) -> DataFrame:
    """``df`` for the narrow side of a join: broadcast when a count finds it small, else shuffled.

    Small sides then never make Spark shuffle the texts on the other side.  ``df`` should be a
    landed table, so that counting it is cheap."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def word_count(text) -> F.Column:
    """Number of words as BIGINT (NULL text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class WordHash(dict):
    """Bounded cache of 64-bit word hashes; ``hashes(words)`` gives a uint64 array."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * _M1
    x = x ^ (x >> np.uint64(29))
    x = x * _M2
    return x ^ (x >> np.uint64(32))


def shingle_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of a word-hash array.

    Fewer than ``k`` words: the whole sequence is one shingle; no words: empty.
    """
    if len(w) == 0:
        return w
    width = min(k, len(w))
    with np.errstate(over="ignore"):
        acc = np.full(len(w) - width + 1, np.uint64(width) * _M3, np.uint64)
        for i in range(width):
            acc = mix64(acc * _M3 + w[i:len(w) - width + 1 + i])
    return np.unique(acc)
