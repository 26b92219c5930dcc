"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed


def _mins(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node.  Landed, so that the joins that read it get plain
    exchanges on both sides and a hub's edges can be split over tasks."""
    return landed(edges.groupBy("u").agg(F.min("v").alias("m")), "star-mins")


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.filter("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every node of ``links(u, v)``; component = smallest id reachable.

    Every round links each node's neighbours to its smallest one; the edge set becomes one
    star per component after O(log^2 n) rounds.  Nothing but a count and a checksum of the
    edges reaches the driver.  Raises if ``max_rounds`` do not suffice (never for real graphs:
    60 rounds cover paths of billions of nodes).
    """
    edges = landed(_oriented(links.filter("u is not null and v is not null")), "edges")
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_mins(both), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
        large = landed(_oriented(large), "large-star")
        mins = _mins(large)
        small = (large.join(mins, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(mins.select("u", F.col("m").alias("v"))))
        edges = landed(_oriented(small), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == now:
            return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
                    .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
