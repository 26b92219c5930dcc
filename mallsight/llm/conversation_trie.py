"""Prefix trie of conversations: shared openings, branches and the tokens that sharing them saves.

A turn is reduced to a digest and its number of words where it is read; texts are never shuffled.
A prefix is named by 128 bits: the exclusive or of the hashes of its (place, digest) pairs.  That
can be added up in pieces, so a conversation of any length spreads over many tasks: rows are sorted
into ranges, a task sums within its range, and the few conversations that cross a range border
receive what lies before.  Two different prefixes share a name with probability 2^-128.

Subtree figures come from an Euler tour.  Every node has an enter and an exit arc; an arc's
successor follows from the node's first child, next sibling and parent.  The tour is list-ranked
(``list_rank``), and a node's leaves and savings are the difference of the prefix sums at its arcs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import landed, word_count
from .list_rank import LOCAL, RATE, list_rank

#: Blocks of tour positions whose sums are added up first (their sums are broadcast).
BLOCKS = 4096
#: Conversation ids that one row of text holds on its way to a node's checksum.
IDS_A_ROW = 8192
NODE = ["depth", "h1", "h2"]


def in_ranges(df: DataFrame, *keys) -> DataFrame:
    """Rows sorted by ``keys`` within ranges of them; column ``pid`` numbers the ranges in order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("pid", F.spark_partition_id())


def _runs(conv: np.ndarray):
    """First places of the runs of equal values, and each row's run."""
    first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    return first, np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(conv)]))


def _number(batches):
    """Adds ``place``: a row's number, from 1, among the rows of its conversation in this range."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        first, run = _runs(conv)
        place = np.arange(len(conv)) - first[run] + 1
        if conv[0] == last:
            place[run == 0] += seen
        last, seen = conv[-1], place[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place"])


def _running_xor(batches):
    """Adds ``h1, h2``: the exclusive or of ``x1, x2`` up to the row among its conversation's rows in this range."""
    last, carry = None, np.zeros(2, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        first, run = _runs(conv)
        out = []
        for i, name in enumerate(("x1", "x2")):
            total = np.bitwise_xor.accumulate(batch.column(name).to_numpy())
            h = total ^ np.r_[np.int64(0), total][first][run]
            if conv[0] == last:
                h[run == 0] ^= carry[i]
            out.append(h)
        last, carry = conv[-1], np.array([h[-1] for h in out])
        yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out)], names=[*batch.schema.names, "h1", "h2"])


def before_range(ranged: DataFrame, sums: dict) -> DataFrame:
    """``(conv, pid, sums...)`` of what earlier ranges hold of the conversations that cross a border.

    At most one conversation crosses each border, so there are fewer such conversations than ranges
    and the result has at most two rows a range."""
    edges = ranged.groupBy("pid").agg(F.array_distinct(F.array(F.min("conv"), F.max("conv"))).alias("edge"))
    crossing = edges.select(F.explode("edge").alias("conv")).groupBy("conv").agg(F.count("*").alias("ranges")).filter("ranges > 1")
    pieces = ranged.join(F.broadcast(crossing), "conv").groupBy("conv", "pid").agg(*[s.alias(n) for n, (s, _) in sums.items()])
    earlier = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return landed(pieces.select("conv", "pid", *[F.coalesce(again(n).over(earlier), F.lit(0)).alias(n) for n, (_, again) in sums.items()]),
                  "range-borders")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv, i, digest, words)``: turns by ``turn`` (NULL first), equal ones by digest, ``i`` from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"), word_count(text).alias("words"))
    ranged = in_ranges(turns, F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")).select("conv", "pid", "digest", "words")
    ranged = landed(ranged.mapInArrow(_number, "conv long, pid int, digest string, words long, place long"), "turns")
    before = before_range(ranged, {"earlier": (F.count("*"), F.sum)})
    return (ranged.join(F.broadcast(before), ["conv", "pid"], "left")
            .select("conv", (F.col("place") + F.coalesce("earlier", F.lit(0))).alias("i"), "digest", "words"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths after every conversation c takes the first crc32(c) % 4 turns of c - c % 20.

    A conversation without that base takes none; its own turns follow after as many of them."""
    sizes = landed(turns.groupBy("conv").agg(F.max("i").alias("len")), "conversations")
    convs = sizes.select("conv", "len", (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("h"),
                         (F.col("conv") - F.col("conv") % 20).alias("base"))
    taken = F.least("h", F.coalesce("base_len", F.lit(0)))
    convs = landed(convs.join(sizes.select(F.col("conv").alias("base"), F.col("len").alias("base_len")), "base", "left")
                   .select("conv", "base", "h", taken.alias("head"), (taken + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("size")), "rebuilt")
    opening = turns.filter("conv % 20 = 0 AND i <= 3").withColumnRenamed("conv", "base")
    heads = convs.join(opening, "base").filter("i <= head").select("conv", F.col("i").alias("depth"), "digest", "words", "size")
    own = turns.join(convs, "conv").filter("i > h").select("conv", F.expr("head + i - h").alias("depth"), "digest", "words", "size")
    return heads.unionByName(own), convs.select("conv", "size")


def named_prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, depth, h1, h2, p1, p2, words, last)``: each turn with the names of the prefix it ends and of the one before."""
    hashed = turns.select("conv", "depth", *[F.xxhash64(F.lit(s), "depth", "digest").alias(f"x{s}") for s in (1, 2)], "words",
                          (F.col("depth") == F.col("size")).alias("last"))
    ranged = in_ranges(hashed, "conv", "depth").select("conv", "depth", "x1", "x2", "words", "last", "pid")
    ranged = landed(ranged.mapInArrow(_running_xor, "conv long, depth long, x1 long, x2 long, words long, last boolean, pid int, h1 long, h2 long"),
                    "prefixes")
    before = before_range(ranged, {"b1": (F.bit_xor("x1"), F.bit_xor), "b2": (F.bit_xor("x2"), F.bit_xor)})
    name = {s: F.expr(f"h{s} ^ coalesce(b{s}, 0L)") for s in (1, 2)}
    return (ranged.join(F.broadcast(before), ["conv", "pid"], "left")
            .select("conv", "depth", *[name[s].alias(f"h{s}") for s in name], *[name[s].bitwiseXOR(F.col(f"x{s}")).alias(f"p{s}") for s in name],
                    "words", "last"))


def trie_nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """Numbered nodes with their family: number, first child, children, last sibling, parent.

    Numbers run by (depth, parent, smallest member), so siblings are neighbours and the root is 0."""
    nodes = prefixes.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("words").alias("words"),
                                        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).filter("n_convs > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in NODE], "n_convs", "conv", *[F.lit(0).cast("long").alias(c) for c in ("words", "p1", "p2")])
    ranged = in_ranges(nodes.unionByName(root), "depth", "p1", "p2", "conv")
    cols = [*NODE, "n_convs", "conv", "words", "p1", "p2"]
    ranged = landed(ranged.select(F.lit(0).cast("long").alias("all"), "pid", *cols)
                    .mapInArrow(_number, "all long, pid int, " + ", ".join(f"{c} long" for c in cols) + ", place long").drop("all"), "nodes")
    counts = ranged.groupBy("pid").agg(F.count("*").alias("n"))  # one row a range
    starts = counts.select("pid", F.coalesce(F.sum("n").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    nodes = ranged.join(F.broadcast(starts), "pid").select((F.col("start") + F.col("place") - 1).alias("nid"), *cols)
    below = (nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
             .agg(F.min("nid").alias("first"), F.count("*").alias("n_children")))
    nodes = landed(nodes.join(below, NODE, "left").na.fill(0, ["n_children"]), "families")
    parents = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                                                    F.col("nid").alias("parent"), F.col("conv").alias("parent_conv_id"),
                                                    (F.col("first") + F.col("n_children") - 1).alias("last_sibling"))
    return landed(nodes.join(parents, ["depth", "p1", "p2"], "left").drop("p1", "p2"), "trie")


def subtree_sums(nodes: DataFrame, rate: int = RATE, local: int = LOCAL) -> DataFrame:
    """``(nid, n_leaves, saved_tokens)`` over each node's subtree, from the ranked Euler tour."""
    enter = F.expr("CASE WHEN n_children > 0 THEN 2 * first ELSE 2 * nid + 1 END")
    leave = F.expr("CASE WHEN parent IS NULL THEN -1L WHEN nid < last_sibling THEN 2 * (nid + 1) ELSE 2 * parent + 1 END")
    arcs = nodes.select(F.explode(F.array(F.struct((2 * F.col("nid")).alias("a"), enter.alias("after")),
                                          F.struct((2 * F.col("nid") + 1).alias("a"), leave.alias("after")))).alias("arc")).select("arc.*")
    ranks = list_rank(arcs.withColumn("w", F.lit(1)), rate, local)
    total = ranks.count()
    weights = nodes.select((2 * F.col("nid")).alias("a"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
                           ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    placed = (ranks.join(weights, "a", "left").na.fill(0, ["leaf", "saved"]).withColumn("at", F.lit(total) - F.col("dist"))
              .withColumn("block", F.expr(f"at * {BLOCKS} div {max(total, 1)}L")))
    placed = landed(placed.select("a", "at", "block", "leaf", "saved"), "tour")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("block").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))  # at most BLOCKS rows
    blocks = blocks.select("block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("l", "s")])
    within = Window.partitionBy("block").orderBy("at")
    sums = (placed.select("a", "block", "leaf", "saved", F.sum("leaf").over(within).alias("l"), F.sum("saved").over(within).alias("s"))
            .join(F.broadcast(blocks), "block"))
    # from just before the enter arc to the exit arc
    side = F.when(F.col("a") % 2 == 0, -1).otherwise(1)
    return sums.groupBy(F.expr("a div 2").alias("nid")).agg(
        F.sum(side * (F.col("l") + F.col("l_before")) + F.col("leaf")).alias("n_leaves"),
        F.sum(side * (F.col("s") + F.col("s_before")) + F.col("saved")).alias("saved_tokens"))


def _joined_ids(batches):
    """Sorted (node, conv) rows to rows of (node, first id, ids joined by commas)."""
    def row(node, ids):
        return (*node, ids[0], ",".join(map(str, ids)))

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])],
                                          names=[*NODE, "first", "ids"])
    node, ids = None, []
    for batch in batches:
        out = []
        for *at, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (at != node or len(ids) >= IDS_A_ROW):
                out.append(row(node, ids))
                ids = []
            node = at
            ids.append(conv)
        if out:
            yield table(out)
    if ids:
        yield table([row(node, ids)])


def _checksums(batches):
    """Sorted rows of joined ids to one SHA-256 a node, read as a stream."""
    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])],
                                          names=[*NODE, "ends_sha256"])
    node, sha = None, None
    for batch in batches:
        out = []
        for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if at == node:
                sha.update(b",")
            else:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = at, hashlib.sha256()
            sha.update(ids.encode())
        if out:
            yield table(out)
    if node is not None:
        yield table([(*node, sha.hexdigest())])


def end_checksums(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """``(depth, h1, h2, ends_sha256)`` of the nodes at which conversations end.

    Ids are sorted in ranges and joined there; the one task of a node hashes joined ids as a stream."""
    zero = [F.lit(0).cast("long").alias(c) for c in NODE]
    ends = prefixes.filter("last").select(*NODE, "conv").unionByName(convs.filter("size = 0").select(*zero, "conv"))
    joined = in_ranges(ends, *NODE, "conv").select(*NODE, "conv").mapInArrow(_joined_ids, "depth long, h1 long, h2 long, first long, ids string")
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (joined.repartition(n, *NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(_checksums, "depth long, h1 long, h2 long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, rate: int = RATE, local: int = LOCAL) -> DataFrame:
    """The trie of ``turns (conv, depth, digest, words, size)`` of ``convs (conv, size)``; see ``conversation_trie``."""
    prefixes = landed(named_prefixes(turns), "named-prefixes")
    nodes = trie_nodes(prefixes, convs)
    return (nodes.join(subtree_sums(nodes, rate, local), "nid").join(end_checksums(prefixes, convs), NODE, "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, rate: int = RATE, local: int = LOCAL) -> DataFrame:
    """One row for each distinct sequence of first turns, from the textless root (depth 0) down.

    Reads ``conv_id, turn, role, text``.  A node is named by its smallest member and its depth;
    ``parent_conv_id`` is the parent's smallest member (NULL at the root).  ``n_convs`` counts the
    conversations that start with the sequence, ``n_children`` the nodes below, ``n_leaves`` the
    childless nodes of its subtree, ``saved_tokens`` the subtree's sum of (n_convs - 1) times the
    words of the node's last text; ``ends_sha256`` is the SHA-256 of the ids of the conversations
    that end there, ascending, joined by commas.  NULL role and text count as empty; turns run by
    ``turn``, NULL first, equal turns by the MD5 digest of role and text, and repeated rows are
    turns of their own.  Rows without a conversation id are left out.  Very long conversations and
    texts are read whole.  An empty table gives no rows, not even a root.  Other columns are ignored.
    """
    turns = landed(numbered_turns(conversations), "numbered")
    convs = landed(turns.groupBy("conv").agg(F.max("i").alias("size")), "conversations")
    whole = turns.join(convs, "conv").select("conv", F.col("i").alias("depth"), "digest", "words", "size")
    return prefix_trie(whole, convs, rate, local)


def rebuilt_trie(conversations: DataFrame, rate: int = RATE, local: int = LOCAL) -> DataFrame:
    """``conversation_trie`` of conversations rebuilt by ``rebuilt_turns``; such a one may have no turn left."""
    turns, convs = rebuilt_turns(landed(numbered_turns(conversations), "numbered"))
    return prefix_trie(turns, convs, rate, local)
