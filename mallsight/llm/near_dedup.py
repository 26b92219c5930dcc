"""MinHash near-duplicate detection with sequential Bayesian verification.

1. One pass turns each text into its set of word shingles, a digest of that set and a
   MinHash signature; documents with equal sets collapse to one class, named by the set.
2. Signature bands bucket the classes.  Members of a bucket are candidates.
3. Candidates are compared in signature batches.  After each batch a pair is dropped when
   the posterior probability that its similarity reaches the threshold (uniform prior,
   Beta posterior) falls below ``miss``.  Survivors are confirmed on their full sets.
4. Buckets never expand into all pairs.  First each class meets the smallest one of its
   buckets (a star), the links found contract to components, and only buckets that still
   hold several components are searched again: members outside the bucket's main component
   against all members, in blocks of bounded size.
5. Connected components of the links give the groups, named by their smallest document id.

Misses: with 24 bands of 5 values two texts at similarity 0.85 share no bucket with
probability 8e-7 and at 0.8 with 7e-5; pruning adds ``miss`` per batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, beside, free_shuffles, landed, shingle_hashes
from .components import connected_components

BANDS, ROWS = 24, 5
N_HASHES = BANDS * ROWS
BATCH = 24
#: Block sizes: followers of a leader in the first search (about), minority members x members in the second.
MINOR_BLOCK, MEMBER_BLOCK = 256, 512
SIGNED = "doc_id long, n_shingles long, set_key binary, sig binary"

_rng = np.random.default_rng(20240611)
_XOR = _rng.integers(0, 2**32, N_HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
_MUL = (_rng.integers(0, 2**32, N_HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]


def minhash(shingles: np.ndarray) -> np.ndarray:
    """Signature of a non-empty shingle set, in blocks that stay in the CPU cache."""
    s = (shingles >> np.uint64(32)).astype(np.uint32)
    sig = np.full(N_HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(s), 2048):
        np.minimum(sig, ((s[at:at + 2048] ^ _XOR) * _MUL).min(axis=1), out=sig)
    return sig


def posterior_floor(threshold: float, miss: float) -> dict[int, int]:
    """For each batch end n: the fewest matches whose posterior P(J >= threshold) is >= miss."""
    x = (np.arange(20_000) + 0.5) / 20_000
    floors = {}
    for n in range(BATCH, N_HASHES + 1, BATCH):
        for m in range(n + 1):
            logp = m * np.log(x) + (n - m) * np.log1p(-x)
            p = np.exp(logp - logp.max())
            if p[x >= threshold].sum() / p.sum() >= miss:
                floors[n] = m
                break
    return floors


def _sets(k: int):
    words = WordHash()
    return lambda text: shingle_hashes(words.hashes(text.lower().split()), k) if text else np.empty(0, np.uint64)


def _sign(k: int):
    def run(batches):
        shingles = _sets(k)
        for batch in batches:
            n, keys, sigs = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py())
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(minhash(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "set_key", "sig"])
    return run


def _full_sets(k: int):
    def run(batches):
        shingles = _sets(k)
        for batch in batches:
            out = [s.tobytes() for s in map(shingles, (t.as_py() for t in batch.column("text"))) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in out], pa.binary()),
                                              pa.array(out, pa.binary())], names=["set_key", "shingles"])
    return run


def _linker(percent: int, miss: float, once: bool):
    """Group function: link minority rows (role 0) to members (role 1) of one group.

    Emits at most one link per merge of two components.  ``once``: a pair that already
    met in an earlier band is left to that band's bucket.
    """
    floors = posterior_floor(percent / 100, miss)

    def run(table: pa.Table) -> pa.Table:
        role = np.asarray(table["role"])
        ids, comp = np.asarray(table["id"]), np.asarray(table["comp"])
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(len(ids), N_HASHES)
        sets = table["shingles"]
        minor, member = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        band = int(table["band"][0].as_py())
        root: dict[int, int] = {}

        def find(c):
            while c in root:
                c = root[c]
            return c

        links = []
        cache: dict[int, np.ndarray] = {}

        def full(i):
            if i not in cache:
                cache[i] = np.frombuffer(sets[i].as_py(), np.uint64)
            return cache[i]

        for i in minor.tolist():
            left = member[(comp[member] != comp[i])]
            if once and band:
                a = sig[i, :band * ROWS].reshape(band, ROWS)
                met = (sig[left, :band * ROWS].reshape(len(left), band, ROWS) == a).all(axis=2).any(axis=1)
                left = left[~met]
            matches = np.zeros(len(left), np.int64)
            for at in range(0, N_HASHES, BATCH):
                matches += (sig[left, at:at + BATCH] == sig[i, at:at + BATCH]).sum(axis=1)
                alive = matches >= floors[at + BATCH]
                left, matches = left[alive], matches[alive]
            for j in left[np.argsort(-matches, kind="stable")].tolist():
                a, b = find(int(comp[i])), find(int(comp[j]))
                if a == b:
                    continue
                x, y = full(i), full(j)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((int(ids[i]), int(ids[j])))
                    root[max(a, b)] = min(a, b)
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()),
                         "v": pa.array([y for _, y in links], pa.int64())})
    return run


def _linked(groups: DataFrame, feats: DataFrame, percent: int, miss: float, once: bool) -> DataFrame:
    """``groups(g1, g2, g3, band, role, id, comp)`` -> confirmed links ``(u, v)``."""
    rows = groups.join(feats, "id")
    return rows.groupBy("g1", "g2", "g3").applyInArrow(_linker(percent, miss, once), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = 1e-6,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Two documents are linked when ``100 * |A ∩ B| >= percent * |A ∪ B|`` for their sets of
    ``shingle``-word shingles (A-Z lower-cased).  Texts of fewer words are one shingle;
    NULL, empty and blank texts have none and stay alone.  Rows that repeat an id are each
    judged by their own text.  Rows without an id are linked with nothing and kept
    (component NULL).  Empty input gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    signed = landed(base.mapInArrow(_sign(shingle), SIGNED), "signed", merge=False)
    # equal sets: one class each, named ``id`` by its set (a document id may stand for several classes)
    name = F.xxhash64("set_key").alias("id")
    classes = landed(signed.filter("doc_id is not null and set_key is not null")
                     .groupBy("set_key").agg(F.min("doc_id").alias("rep")).select("set_key", name, "rep"), "classes")
    reps = (signed.select("doc_id", "set_key", "sig")
            .join(classes.select(F.col("rep").alias("doc_id"), "set_key", "id"), ["doc_id", "set_key"])
            .select("id", "sig").dropDuplicates(["id"]))
    bands = reps.select("id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring("sig", b * (4 * ROWS) + 1, F.lit(4 * ROWS))))).alias("band", "key"))
    bands = landed(bands, "bands")
    leaders = landed(bands.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n"))
                     .filter("n > 1").drop("n"), "leaders")
    members = landed(bands.join(beside(leaders), "key"), "members")
    free_shuffles(spark)
    wanted = landed(members.select("id").distinct(), "wanted")
    holders = landed(classes.join(beside(wanted), "id", "left_semi").select(F.col("rep").alias("doc_id")).distinct(), "holders")
    texts = base.join(beside(holders), "doc_id", "left_semi")
    sets = (texts.mapInArrow(_full_sets(shingle), "set_key binary, shingles binary")
            .select(name, "shingles").dropDuplicates(["id"]))
    feats = landed(sets.join(reps.join(beside(wanted), "id", "left_semi"), "id"), "features", merge=False)
    free_shuffles(spark)

    # first search: each class and the smallest class it shares a bucket with
    star = landed(members.filter("id <> leader").groupBy("id").agg(F.min("leader").alias("leader")), "star")
    # a leader's followers are split into as many groups as their count needs
    crowded = landed(star.groupBy("leader").agg(F.ceil(F.count("*") / MINOR_BLOCK).alias("groups")).filter("groups > 1"), "crowded")
    salted = (star.join(beside(crowded), "leader", "left")
              .select(F.col("leader").alias("g1"), F.pmod(F.xxhash64("id"), F.coalesce("groups", F.lit(1))).alias("g2"), "id"))
    rows = (salted.select("g1", "g2", F.lit(0).alias("role"), "id")
            .unionByName(salted.select("g1", "g2", F.lit(1).alias("role"), F.col("g1").alias("id")).distinct())
            .select("g1", "g2", F.lit(0).alias("g3"), F.lit(0).alias("band"), "role", "id", F.col("id").alias("comp")))
    first = landed(_linked(rows, feats, percent, miss, once=False), "links")
    comps = landed(connected_components(first), "components")

    # second search: buckets that still hold several components
    placed = landed(members.select("key", "band", "id").join(comps, "id", "left")
                    .select("key", "band", "id", F.coalesce("component", "id").alias("comp")), "placed")
    sizes = placed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = landed(sizes.groupBy("key").agg(F.max_by("comp", F.struct("n", -F.col("comp"))).alias("main"),
                                            F.sum("n").alias("n"), F.count("*").alias("comps"),
                                            F.max("n").alias("n_main"))
                   .filter("comps > 1")
                   .select("key", "main",
                           F.ceil((F.col("n") - F.col("n_main")) / MINOR_BLOCK).cast("int").alias("blocks_a"),
                           F.ceil(F.col("n") / MEMBER_BLOCK).cast("int").alias("blocks_c")), "mixed")
    placed = placed.join(mixed, "key")
    block = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    minor = (placed.filter("comp <> main").withColumn("g2", block(1, "blocks_a"))
             .withColumn("g3", every("blocks_c")).withColumn("role", F.lit(0)))
    member = (placed.withColumn("g3", block(2, "blocks_c"))
              .withColumn("g2", every("blocks_a")).withColumn("role", F.lit(1)))
    cols = [F.col("key").alias("g1"), "g2", "g3", "band", "role", "id", "comp"]
    rows = minor.select(*cols).unionByName(member.select(*cols))
    second = _linked(rows, feats, percent, miss, once=True)
    contracted = second.join(comps.select(F.col("id").alias("u"), F.col("component").alias("cu")), "u", "left") \
        .join(comps.select(F.col("id").alias("v"), F.col("component").alias("cv")), "v", "left") \
        .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    merged = connected_components(contracted)
    final = (comps.unionByName(merged.join(comps, "id", "left_anti"))
             .join(merged.select(F.col("id").alias("component"), F.col("component").alias("top")), "component", "left")
             .select("id", F.coalesce("top", "component").alias("top")))
    # components of classes take their smallest document id only now
    linked = landed(final.join(classes.select("id", "rep"), "id"), "linked-classes")
    firsts = landed(linked.groupBy("top").agg(F.min("rep").alias("first")), "first-documents")
    linked = linked.join(beside(firsts), "top").select("id", "first")
    # one narrow row per set, joined once: a large class's rows can then be split over tasks
    groups = landed(classes.join(linked, "id", "left").select("set_key", F.coalesce("first", "rep").alias("top")), "groups")
    free_shuffles(spark)
    return (signed.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("top", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group (columns of ``docs``).

    The smallest id stays.  Rows equal in id and text are one row afterwards; different texts
    under one id stay while one of them does.  Rows without an id stay.
    """
    found = near_duplicates(docs, shingle, percent, id_col=id_col, text_col=text_col)
    per_id = landed(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("__found_id"))
                    .agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "kept-ids")
    removed = landed(per_id.filter(~F.col("kept")).select("__found_id"), "removed-ids")
    repeated = landed(per_id.filter(F.col("kept") & (F.col("n") > 1)).select("__found_id"), "repeated-ids")
    same = F.col(id_col).cast("long") == F.col("__found_id")
    once = docs.join(beside(repeated), same, "left_semi").dropDuplicates([id_col, text_col])
    return (docs.join(beside(removed), same, "left_anti").join(beside(repeated), same, "left_anti")
            .unionByName(once))
