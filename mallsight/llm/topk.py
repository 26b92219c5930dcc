"""Exact top-k inner-product search with multi-resolution segment statistics.

For vectors cut into segments, with a segment's mean and deviation of each vector,
``<q, x> <= sum_s len_s * (mean_q * mean_x + dev_q * dev_x)`` (Cauchy-Schwarz on the centred
segments): the upper bound of the score that belongs to the lower bound of the distance
``|q - x|^2 = |q|^2 + |x|^2 - 2 <q, x>``.  Bounds go from few segments to many; a candidate
below the k-th best exact score found so far is dropped, survivors get their exact score.

Queries and candidates meet in blocks: a task holds at most one block of each.  A first round scores,
in every block, only the candidates whose segment means promise most; the ``k``-th best of all
blocks' seeds is the query's floor.  The second round drops, level by level, candidates whose bound is below the
floor, and scores the rest.  Bounds are in double precision with a relative margin; scores are exact
integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import landed

QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
#: Segments per vector, coarse to fine.
LEVELS = (2, 8, 32)
#: Seeds of a block (``k`` if that is more): the best by segment means of the finest level.
SEED_ROWS = 64
#: Scores saturate at the BIGINT range.
LONG = 2**63 - 1


def to_integers(vectors: list[np.ndarray], scale: int) -> np.ndarray:
    """Matrix of floor(scale * x): float64 where every inner product is exact in it, else objects."""
    m = np.floor(np.stack(vectors).astype(np.float64) * scale) + 0.0
    if m.size and np.abs(m).max() ** 2 * m.shape[1] >= 2**53:
        return np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape)
    return m


def segment_stats(m: np.ndarray, segments: int) -> np.ndarray:
    """Per vector: sqrt(len) * mean and sqrt(len) * deviation of every segment."""
    cols = np.array_split(np.arange(m.shape[1]), min(segments, m.shape[1]))
    mean = np.stack([m[:, c].mean(axis=1) * np.sqrt(len(c)) for c in cols], axis=1)
    dev = np.stack([m[:, c].std(axis=1) * np.sqrt(len(c)) for c in cols], axis=1)
    return np.hstack([mean, dev])


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[int]:
    """Places of the k best (score descending, id ascending)."""
    if scores.dtype == object:
        return sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    if len(ids) > k:
        kth = -np.partition(-scores, k - 1)[k - 1]
        places = np.flatnonzero(scores >= kth)
    else:
        places = np.arange(len(ids))
    return places[np.lexsort((ids[places], -scores[places]))][:k].tolist()


def _exact_in_doubles(q: np.ndarray, x: np.ndarray) -> bool:
    return x.dtype != object and q.dtype != object and \
        (not x.size or not q.size or np.abs(x).max() * np.abs(q).max() * x.shape[1] < 2**53)


def seed_block(q_ids, q, x_ids, x, k: int):
    """(query id, exact score) of the candidates of one block with the best products of segment means, ``k`` a query at most."""
    if not _exact_in_doubles(q, x):  # such blocks are not pruned
        return []
    means = [segment_stats(m, LEVELS[-1])[:, :min(LEVELS[-1], m.shape[1])] for m in (q, x)]
    likely = means[0] @ means[1].T
    rows, out = max(SEED_ROWS, k), []
    for i, qid in enumerate(q_ids.tolist()):
        left = np.flatnonzero(x_ids != qid)
        if len(left) > rows:
            left = left[np.argpartition(-likely[i, left], rows - 1)[:rows]]
        scores = np.sort(x[left] @ q[i])[::-1][:k]
        out += [(qid, int(s)) for s in scores]
    return out


def search_block(q_ids, q, x_ids, x, k: int, floors=None, counts=None):
    """(query id, vector id, exact score) of each query's ``k`` best candidates of one block.

    ``floors`` holds a score for each query that its ``k``-th best is known to reach (NaN: none);
    candidates below it are left out.  ``counts`` receives the candidates left after each level."""
    out = []
    exact = _exact_in_doubles(q, x)
    if not exact:  # components too large for doubles: whole integers, no bounds
        x, q = x.astype(object), q.astype(object)
    floors = np.full(len(q_ids), np.nan) if floors is None else floors
    if exact and not np.isnan(floors).all():
        sx = [segment_stats(x, s) for s in LEVELS]
        sq = [segment_stats(q, s) for s in LEVELS]
    for i, qid in enumerate(q_ids.tolist()):
        left = np.flatnonzero(x_ids != qid)
        pruned = exact and not np.isnan(floors[i])
        sizes = [len(left)]
        for a, b in zip(sx, sq) if pruned else ():
            bound = a[left] @ b[i]
            left = left[bound * (1 + 1e-9) + np.abs(bound).max(initial=0) * 1e-9 + 1e-6 >= floors[i]]
            sizes.append(len(left))
        if counts is not None:
            counts += np.array(sizes + sizes[-1:] * (len(LEVELS) + 1 - len(sizes)))
        if exact:
            scores = x[left] @ q[i]
        else:
            scores = np.array([max(-LONG - 1, min(LONG, sum(u * v for u, v in zip(x[j], q[i])))) for j in left] + [0],
                              dtype=object)[:-1]
        for j in best(scores, x_ids[left], k):
            if not pruned or scores[j] >= floors[i]:
                out.append((qid, int(x_ids[left[j]]), int(scores[j])))
    return out


def _block(k: int, scale: int, step: str):
    names = {"seeds": ("query_id", "score"), "search": ("query_id", "vec_id", "score"), "counts": ("level", "candidates")}[step]

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and candidates.num_rows:
            ids = [np.asarray(t["id"]) for t in (queries, candidates)]
            mats = [to_integers([np.asarray(v.values) for v in t["vec"]], scale) for t in (queries, candidates)]
            if step == "seeds":
                found = seed_block(ids[0], mats[0], ids[1], mats[1], k)
            else:
                floors = np.array([np.nan if f is None else float(f) for f in queries["floor"].to_pylist()])
                counts = np.zeros(len(LEVELS) + 1, np.int64)
                found = search_block(ids[0], mats[0], ids[1], mats[1], k, floors, counts)
                if step == "counts":
                    found = list(enumerate(counts.tolist()))
        cols = list(zip(*found)) or [()] * len(names)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cols)})
    return run, ", ".join(f"{n} long" for n in names)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest inner products.

    Components become ``floor(scale * x)``.  ``queries`` has the columns of ``vectors``; a
    candidate with the query's own id is left out.  Ties go to the smaller id.  Vectors that
    are NULL or empty or hold a NULL or non-finite component, and rows without an id, take
    no part; only vectors of equal length are compared; rows that repeat an id are separate
    candidates.  Scores beyond the BIGINT range saturate.  Fewer than ``k`` candidates: all of
    them; none: no rows.
    """
    found = _search(vectors, queries, k, scale, id_col, vec_col, "search")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def pruned_shares(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024,
                  id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(level, candidates)``: pairs of query and candidate (level 0), and pairs left after each level of bounds."""
    return (_search(vectors, queries, k, scale, id_col, vec_col, "counts").groupBy("level").agg(F.sum("candidates").alias("candidates")))


def _search(vectors, queries, k, scale, id_col, vec_col, step) -> DataFrame:
    def usable(df, name):
        fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return landed(df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0))
                      .filter(fine)
                      .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")), name)

    spark = vectors.sparkSession
    x, q = usable(vectors, "candidates"), usable(queries, "queries")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_x, n_q = x.count(), q.count()
    # enough candidate blocks to use every task, none above its size
    x_blocks = max(-(-n_x // CANDIDATE_BLOCK), min(spread, -(-n_x // 64)), 1)
    q_blocks = max(-(-n_q // QUERY_BLOCK), 1)
    at = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["dim", "qb", "xb"]
    right = x.select("id", "vec", F.size("vec").alias("dim"), at(x_blocks).alias("xb"), every(q_blocks).alias("qb"))

    def meet(asked: DataFrame, step: str) -> DataFrame:
        left = asked.withColumns({"dim": F.size("vec"), "qb": at(q_blocks), "xb": every(x_blocks)})
        run, schema = _block(k, scale, step)
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, schema)
    falling = Window.partitionBy("query_id").orderBy(F.col("score").desc())
    floors = (meet(q, "seeds").withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= k).filter(F.col("place") == k)
              .select(F.col("query_id").alias("id"), F.col("score").alias("floor")))
    return meet(q.join(landed(floors, "floors"), "id", "left"), step)
