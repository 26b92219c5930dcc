"""Sharding by histogram sort: shards of near equal bytes in one global key order.

Rows are ordered by (60-bit digest of the text, id), so equal texts lie side by side.  The
splitters between parts are found without sorting: each round counts the exact bytes below
candidate boundaries inside every open bracket, over all partitions, and narrows the bracket
that holds a splitter; a bracket closes when its boundary is within ``tolerance`` bytes or a
single key is left.  Then rows are exchanged once, by part, and numbered.

A splitter inside a group of equal texts moves to the group's nearer edge, unless the group is
larger than a stated share of a shard.  A shard is ``split`` consecutive parts, and a part falls
into cells of the key space, so that no task holds a whole shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import landed

#: Candidate boundaries per round: over the whole key space first, then inside each bracket.
FIRST_PROBES, PROBES = 4096, 128
#: Exact parts at most: the driver holds so many brackets, and so many times PROBES rows a round.
MOST_PARTS = 1024
#: Groups of equal texts are kept whole up to 1 / GROUP_SHARE of a mean shard, or twice the largest row.
GROUP_SHARE = 20
KEY_BITS = 60
LEAST_ID = -(2**63)
_COARSE = 2**KEY_BITS // FIRST_PROBES


def _counts(keys: DataFrame, brackets: list[tuple[int, int, int, int]]) -> list:
    """Bytes, smallest and largest value of every non-empty probe interval of the brackets.

    A bracket is (level, h, lo, hi): values are the digests (level 0), or the ids of the
    rows with digest ``h`` (level 1).  At most ``PROBES`` rows per bracket come back.
    """
    spark = keys.sparkSession
    rows = []
    for b, (level, h, lo, hi) in enumerate(brackets):
        first, last = (lo, hi) if level == 0 else (h, h)
        rows += [(b, level, h, lo, hi, c) for c in range(first // _COARSE, last // _COARSE + 1)]
    small = spark.createDataFrame(rows, "b int, level int, bh long, lo long, hi long, coarse int")
    value = F.when(F.col("level") == 0, F.col("h")).otherwise(F.col("d")).cast("decimal(20,0)")
    probe = F.floor((F.col("x") - F.col("lo")) * PROBES / (F.col("hi").cast("decimal(20,0)") - F.col("lo") + 1)).cast("int")
    return (keys.withColumn("coarse", F.expr(f"cast(h div {_COARSE} as int)"))
            .join(F.broadcast(small), "coarse").withColumn("x", value)
            .filter("x between lo and hi and (level = 0 or h = bh)")
            .groupBy("b", probe.alias("p"))
            .agg(F.sum("size").alias("size"), F.min("x").cast("long").alias("lo"), F.max("x").cast("long").alias("hi"))
            .collect())


def splitters(keys: DataFrame, parts: int, tolerance: int = 0) -> list[tuple[int, int] | None]:
    """``parts - 1`` splitters (h, d): the smallest key with at least k / parts of the bytes below.

    ``keys(h, d, size)``; None stands for a splitter beyond the last key.  The driver holds
    ``parts`` brackets and the counts of their probes, whatever the number of rows.
    """
    coarse = {r.c: r for r in keys.groupBy(F.expr(f"cast(h div {_COARSE} as int)").alias("c"))
              .agg(F.sum("size").alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi")).collect()}
    total = sum(r["size"] for r in coarse.values())
    goals = [k * total for k in range(1, parts)]          # in units of 1 / parts bytes
    out: list[tuple[int, int] | None] = [None] * (parts - 1)
    # a bracket keeps: where it starts (bytes below it), the key that follows it, its goals
    top = sorted(coarse.values(), key=lambda r: r["lo"])
    work = [(0, [(0, 0, r["lo"], r["hi"], r["size"]) for r in top], None, list(range(parts - 1)))]
    while work:
        open_ = []
        for below, cells, after, wanted in work:
            waiting = list(wanted)
            for i, (level, h, lo, hi, size) in enumerate(cells):
                follow = after
                if i + 1 < len(cells):
                    nxt = cells[i + 1]
                    follow = (nxt[2], LEAST_ID) if nxt[0] == 0 else (nxt[1], nxt[2])
                here = (lo, LEAST_ID) if level == 0 else (h, lo)
                inside = []
                while waiting and goals[waiting[0]] <= (below + size) * parts:
                    k = waiting.pop(0)
                    if goals[k] <= (below + tolerance) * parts:
                        out[k] = here
                    elif (below + size - tolerance) * parts <= goals[k] or (lo == hi and level == 1):
                        out[k] = follow
                    else:
                        inside.append(k)
                if inside:
                    # one digest left: go on among its ids
                    open_.append((below, (1, lo, LEAST_ID, 2**63 - 1) if lo == hi and level == 0 else (level, h, lo, hi),
                                  follow, inside))
                below += size
            for k in waiting:
                out[k] = after
        if not open_:
            break
        cells: dict[int, list] = {b: [] for b in range(len(open_))}
        for r in _counts(keys, [x[1] for x in open_]):
            level, h = open_[r["b"]][1][:2]
            cells[r["b"]].append((level, h, r["lo"], r["hi"], r["size"]))
        work = [(below, sorted(cells[b], key=lambda c: c[2]), follow, wanted)
                for b, (below, _, follow, wanted) in enumerate(open_)]
    return out


def whole_groups(keys: DataFrame, cuts: list, shards: int) -> list:
    """``cuts`` between shards, those inside a group of equal digests moved to its nearer edge.

    Groups larger than ``group_limit`` stay cut.  One row a cut reaches the driver."""
    inside = [(k, *c) for k, c in enumerate(cuts) if c is not None and c[1] != LEAST_ID]
    if not inside:
        return cuts
    spark = keys.sparkSession
    size = keys.agg(F.sum("size").alias("total"), F.max("size").alias("largest")).first()
    limit = max(2 * size.largest, size.total // (shards * GROUP_SHARE))
    small = F.broadcast(spark.createDataFrame(inside, "k int, h long, cut long"))
    out = list(cuts)
    for r in keys.join(small, "h").groupBy("k", "h").agg(F.sum("size").alias("size"), F.sum(F.when(F.col("d") < F.col("cut"), F.col("size"))).alias("below")).collect():
        if r["size"] <= limit:
            out[r.k] = (r.h, LEAST_ID) if 2 * (r.below or 0) <= r["size"] else (r.h + 1, LEAST_ID)
    return out


def shard_by_bytes(docs: DataFrame, shards: int = 40, overhead: int = 16, tolerance: int = 0,
                   split: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot, carry...)`` for every row of ``docs``.

    ``size`` = UTF-8 bytes of the text + ``overhead`` (NULL text: no bytes, crc32 of "").
    Rows in order of (text digest, id) fill shards of near equal bytes: a row whose key has
    b of B bytes strictly below it goes to shard floor(shards * b / B) (``tolerance`` 0).
    Equal texts stay together: a group of at most 1 / GROUP_SHARE of a mean shard, or twice the
    largest row, goes whole to the shard of its last key that has at most half of the group below
    it.  Larger groups are cut at the byte; rows equal in text and id are never parted.  ``slot``
    numbers a shard's rows from 0 in key order.  NULL ids sort first.  Empty input gives an empty
    result.  ``split`` (exact parts per shard, by default from the session's shuffle partitions,
    MOST_PARTS in all) does not change the result.  ``carry`` names further columns to keep (a
    struct ``carried``).
    """
    spark = docs.sparkSession
    wanted = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    split = split or max(1, min(-(-wanted // shards), MOST_PARTS // shards))
    # parts that are too few for the session's partitions fall into cells of equal key ranges
    cell_bits = (wanted - 1).bit_length() if shards * split < wanted else 0
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text) + overhead).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long").alias("h"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID)).alias("d"),
                       *([F.struct(*carry).alias("carried")] if carry else []))
    keys = landed(base.select("h", "d", "size"), "shard-keys")
    parts = shards * split
    cuts = splitters(keys, parts, tolerance)
    between = whole_groups(keys, cuts[split - 1::split], shards)
    far = (2**KEY_BITS, LEAST_ID)  # beyond every key
    low = (0, LEAST_ID)
    for k in range(parts - 1):  # cuts within a shard stay between the shard's own
        s = k // split
        left = (between[s - 1] or far) if s > 0 else low
        right = (between[s] or far) if s < shards - 1 else far
        cuts[k] = right if k % split == split - 1 else min(max(cuts[k] or far, left), right)
    cuts = [c for c in cuts if c < far]
    # part of a row = splitters at or below its key: those of lower coarse cells by count,
    # those of its own cell by comparison (one row per coarse cell, FIRST_PROBES at most)
    by_cell: dict[int, list] = {}
    for h, d in cuts:
        by_cell.setdefault(h // _COARSE, []).append({"h": h, "d": d})
    lower, cells = 0, []
    for c in range(FIRST_PROBES):
        cells.append((c, lower, by_cell.get(c, [])))
        lower += len(by_cell.get(c, []))
    small = spark.createDataFrame(cells, "coarse int, lower int, cuts array<struct<h:bigint,d:bigint>>")
    placed = (base.withColumn("coarse", F.expr(f"cast(h div {_COARSE} as int)")).join(F.broadcast(small), "coarse")
              .withColumn("part", F.col("lower") + F.expr("size(filter(cuts, c -> c.h < h or (c.h = h and c.d <= d)))")))
    cell = F.shiftright("h", KEY_BITS - cell_bits).cast("int") if cell_bits else F.lit(0)
    placed = placed.withColumn("cell", cell)
    # rows of earlier parts and cells of the same shard: one row for each part and cell
    tally = keys.withColumn("coarse", F.expr(f"cast(h div {_COARSE} as int)")).join(F.broadcast(small), "coarse") \
        .select((F.col("lower") + F.expr("size(filter(cuts, c -> c.h < h or (c.h = h and c.d <= d)))")).alias("part"), cell.alias("cell")) \
        .groupBy("part", "cell").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(F.expr(f"part div {split}")).orderBy("part", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = tally.select(F.col("part").alias("s_part"), F.col("cell").alias("s_cell"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    in_part = Window.partitionBy("part", "cell").orderBy("h", "d")
    return (placed.withColumn("rank", F.row_number().over(in_part))
            .join(F.broadcast(starts), (F.col("part") == F.col("s_part")) & (F.col("cell") == F.col("s_cell")))
            .select("doc_id", "size", "text_crc32", F.expr(f"cast(part div {split} as int)").alias("shard"),
                    (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"),
                    *(["carried"] if carry else [])))


def sharded_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard``, ``slot`` and ``n_bytes``; existing columns of these names are replaced."""
    new = ["shard", "slot", "n_bytes"]
    rows = shard_by_bytes(docs, shards, id_col=id_col, text_col=text_col, carry=tuple(docs.columns))
    return rows.select(*[F.col("carried")[c].alias(c) for c in docs.columns if c not in new],
                       "shard", "slot", F.col("size").alias("n_bytes"))
