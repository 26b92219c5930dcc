"""Brute-force versions and small frames for the operator tests."""

import hashlib
import re
import zlib

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0D]+")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside; tables may carry them as extra columns.
CLASHING = ("id", "u", "v", "comp", "key", "size", "rank", "part", "shard", "slot", "score", "hash", "class", "at", "n", "words",
            "label", "carried", "source_size", "target", "before", "range")


def words(text):
    return WORD.findall(text or "")


def docs_df(spark, rows, extra=False):
    """Documents from ``(doc_id, text[, source])`` tuples; ``extra`` adds columns with clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(7).alias(c) for c in CLASHING])
    return df


def shingle_set(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = words(low)
    if not ws:
        return set()
    return {tuple(ws)} if len(ws) < k else {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)}


def near_dup_components(rows, k, percent):
    """doc_id -> smallest id reachable over links of all pairs (distinct ids)."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    comp[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def passages_removed(rows, window):
    """(doc_id, kept words) by the statement of the operator, window by window."""
    first = {}
    for i, t in rows:
        ws = words(t)
        for p in range(len(ws) - window + 1):
            w = tuple(ws[p:p + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        ws = words(t)
        gone = [False] * len(ws)
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        out.append((i, [w for w, g in zip(ws, gone) if not g]))
    return out


def shard_statement(rows, shards, overhead):
    """(doc_id, size, crc32, shard, slot) by one pass over all rows in key order."""
    keyed = []
    for i, t in rows:
        b = (t or "").encode()
        keyed.append((int(hashlib.md5(b).hexdigest()[:15], 16), -2**63 if i is None else i, len(b) + overhead, i, zlib.crc32(b)))
    keyed.sort(key=lambda k: k[:2])
    total, below, rows = sum(k[2] for k in keyed), 0, []
    for n, k in enumerate(keyed):
        before = below if n == 0 or keyed[n - 1][:2] != k[:2] else rows[-1][1]
        rows.append((k, before))
        below += k[2]
    most = max(2 * max((k[2] for k in keyed), default=0), total // (20 * shards))
    groups = {}
    for k, before in rows:
        groups.setdefault(k[0], []).append((k[2], before))
    out, fill = [], {}
    for k, before in rows:
        group = groups[k[0]]
        size, first = sum(s for s, _ in group), group[0][1]
        at = max(b for _, b in group if 2 * (b - first) <= size) if size <= most else before
        s = at * shards // total
        out.append((k[3], k[2], k[4], s, fill.get(s, 0)))
        fill[s] = fill.get(s, 0) + 1
    return out
