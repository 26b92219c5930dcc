"""Distributed list ranking by sparse rulers.

A linked list is a table of elements and their successors.  A hash names about one element in
``RATE`` a ruler.  Every element jumps along doubled pointers until it points at a ruler, summing
what it passes; elements that got there leave the rounds.  The rulers form a list ``RATE`` times
shorter, ranked the same way, and each element adds its ruler's rank.  All levels together move a
few times the list, where plain pointer doubling moves it once a round until its longest run ends.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import landed

#: One element in so many is a ruler.
RATE = 64
#: Lists of at most so many elements (24 bytes each) are ranked in one task.
LOCAL = 16_384


def _rank_locally(batches):
    batches = list(batches)
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    a, after, dist = (rows.column(c).to_numpy().copy() for c in range(3))
    order = np.argsort(a)
    a, after, dist = a[order], after[order], dist[order]
    to = np.where(after < 0, -1, np.searchsorted(a, after))
    while (to >= 0).any():
        on = to >= 0
        dist = dist + np.where(on, dist[to], 0)
        to = np.where(on, to[to], -1)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(dist)], names=["a", "dist"])


def list_rank(elements: DataFrame, rate: int = RATE, local: int = LOCAL, level: int = 0) -> DataFrame:
    """``(a, dist)`` from ``(a, after, w)``: the sum of ``w`` from an element to the end of its list.

    Ids are BIGINTs of 0 or more; ``after`` is -1 at an end.  No element may follow two others and
    no list may be a ring.  Several lists are ranked at once.
    """
    if level == 0:
        elements = landed(elements.select(*[F.col(c).cast("long").alias(c) for c in ("a", "after", "w")]), "list")
    if elements.count() <= local:
        one = elements.select("a", "after", "w").repartition(1)
        return landed(one.mapInArrow(_rank_locally, "a long, dist long"), "list-ranks")

    def ruler(c: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(level), F.col(c)), F.lit(rate)) == 0
    there = (F.col("after") < 0) | ruler("after")
    settled, moving = [elements.filter(there)], elements.filter(~there)
    while not moving.isEmpty():
        at = functools.reduce(DataFrame.unionByName, [*settled, moving]).select(F.col("a").alias("after"), F.col("after").alias("to"), F.col("w").alias("v"))
        moved = landed(moving.join(at, "after").select("a", F.col("to").alias("after"), (F.col("w") + F.col("v")).alias("w")), "list-jumps")
        settled, moving = [*settled, moved.filter(there)], moved.filter(~there)
    reached = functools.reduce(DataFrame.unionByName, settled)
    rulers = landed(reached.filter(ruler("a")), "list-rulers")
    # an end may be a ruler's list of its own; lists without a ruler are ranked by their jumps alone
    ranks = list_rank(rulers, rate, local, level + 1).select(F.col("a").alias("after"), F.col("dist").alias("rest"))
    return landed(reached.join(ranks, "after", "left").select("a", (F.col("w") + F.coalesce("rest", F.lit(0))).alias("dist")), "list-ranks")
