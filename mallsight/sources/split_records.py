"""Records of large single files, read by many tasks (SRC1, SRC13, SRC15).

A quoted CSV record may hold line breaks and a JSON array element may span lines, so a byte range
of a file does not tell where its records start; Spark's ``multiLine`` readers therefore give a
file to one task.  Here a file is read in ranges as *pieces* that end at a separator byte (a line
break, or ``}``), and what a reader must know at the start of a range is a sum over the ranges
before it: the parity of the quotes, and for JSON the depth of the braces.  So

1. every range is reduced to a few numbers (no text is kept), written once;
2. sums run over the few rows of one row per range;
3. the task that reads a range puts its records together, and only the cut records at the ends of ranges are joined.

Records that lie within a range never meet a shuffle.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import materialize
from .readers import CORRUPT

# tasks need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def _earlier(by: str = "block"):
    """Ranges of the file before this one."""
    return Window.partitionBy("file").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)


def pieces(spark: SparkSession, path, sep: str) -> DataFrame:
    """``(file, file_name, size, block, pos, piece)``: raw bytes between separators, in byte ranges.

    ``block`` is the range's offset in its file, ``pos`` rises within a range."""
    return spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("piece"))


def count_of(text: Column, mark: str) -> Column:
    """Occurrences of an ASCII character, on the bytes (valid for any ASCII-compatible charset)."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _assembled(batches):
    """Records of the byte ranges in ``batches`` (``rid, open, pos, piece``, ranges whole and in file order).

    ``kind`` 0 is a whole record; the first piece of text of a range that starts inside a field is 1, the
    last one of a range that ends inside a field 2, or 1 when it began before the range.  ``open`` NULL: every line is one.
    """
    rid, inside, lead, held, held_pos = None, False, False, [], None

    def rows(rids, poss, kinds, texts):
        return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(poss, pa.int64()), pa.array(kinds, pa.int32()),
                                           pa.array(texts, pa.binary()) if isinstance(texts, list) else texts], ["rid", "pos", "kind", "text"])
    for batch in batches:
        ids, pos = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)] if len(ids) else [0]
        for a, b in zip(cuts, cuts[1:]):
            if ids[a] != rid:
                if held:
                    yield rows([rid], [held_pos], [1 if lead else 2], [b"\n".join(held)])
                rid, held = ids[a], []
                inside = batch.column(1)[a].as_py()
                lead = bool(inside)
            pieces = batch.column(3).slice(a, b - a)
            if inside is None:
                ends = np.arange(b - a)
            else:
                after = (int(inside) + np.cumsum(pc.count_substring(pieces, '"').to_numpy(zero_copy_only=False))) % 2
                ends, inside = np.flatnonzero(after == 0), bool(after[-1])
            done = int(ends[-1]) + 1 if len(ends) else 0
            if done:
                starts = np.concatenate([[0], ends + 1])
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.concat_arrays([pieces.slice(0, done)])), b"\n")
                at, kinds = pos[a + starts[:-1]], np.zeros(len(ends), dtype=np.int32)
                if held:
                    texts = pa.concat_arrays([pa.array([b"\n".join([*held, texts[0].as_py()])], pa.binary()), texts.slice(1)])
                    at[0] = held_pos
                if lead:
                    kinds[0], lead = 1, False
                yield rows(np.full(len(ends), rid), at, kinds, texts)
                held = []
            if done < b - a:
                held_pos = held_pos if held else pos[a + done]
                held.append(b"\n".join(pieces.slice(done).to_pylist()))
    if held:
        yield rows([rid], [held_pos], [1 if lead else 2], [b"\n".join(held)])


def _joined(owned: DataFrame, sep: str) -> DataFrame:
    """``(file, file_name, block, pos, text)``: pieces with the same owner in one text."""
    grouped = (owned.groupBy("file", "file_name", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "piece"))).alias("parts")))
    return grouped.select("file", "file_name", "owner.block", "owner.pos",
                          F.array_join(F.transform("parts", lambda p: p["piece"]), sep).alias("text"))


# ------------------------------------------------------------------ CSV
def csv_records(lines: DataFrame) -> DataFrame:
    """``(file, file_name, block, pos, text)``: RFC 4180 records of ``pieces(..., "\\n")``, raw bytes.

    A record runs to the first line after which the file's quotes are balanced.  Files whose quotes
    are never balanced (a stray quote) are left as single lines, for the field count to reject.
    Blank lines between records are dropped.
    """
    ranges = lines.groupBy("file", "file_name", "block").agg(F.sum(quotes := count_of(F.col("piece"), '"')).alias("q"), F.max(quotes % 2).alias("odd"))
    ranges = materialize(ranges.withColumn("rid", F.monotonically_increasing_id()), "csv_quotes")  # one row a byte range
    crossed = ranges.groupBy("file").agg(F.sum("q").alias("all"), F.max("odd").alias("odd")).filter("all % 2 = 0 AND odd = 1").select("file")
    single = lines.select("file", "file_name", "block", "pos", F.col("piece").alias("text"))
    if crossed.isEmpty():  # no record crosses a line
        return single.filter(F.trim(F.col("text"), F.lit(" \r\t")) != "")
    ahead = F.coalesce(F.sum("q").over(_earlier("block")), F.lit(0))
    starts = ranges.withColumn("ahead", ahead).join(crossed.withColumn("crossed", F.lit(True)), "file", "left").select(
        "file", "file_name", "block", "rid", F.when(F.col("crossed"), F.col("ahead") % 2 == 1).alias("open"))
    starts = F.broadcast(materialize(starts, "csv_starts"))
    # records are put together where their range is read; no text is shuffled but the ends of ranges
    told = lines.join(starts.drop("file_name"), ["file", "block"]).select("rid", "open", "pos", F.col("piece").cast("binary").alias("piece"))
    parts = told.mapInArrow(_assembled, "rid long, pos long, kind int, text binary").join(starts.drop("open"), "rid")
    parts = parts.select("file", "file_name", "block", "pos", "kind", F.col("text").cast("string").alias("text"))
    begins = F.when(F.col("kind") == 2, F.struct("block", "pos"))
    cut = parts.filter("kind > 0").withColumn("owner", F.last(begins, ignorenulls=True).over(Window.partitionBy("file").orderBy("block", "pos")))
    whole = parts.filter("kind = 0").select(*single.columns)
    out = whole.unionByName(_joined(cut.withColumnRenamed("text", "piece"), "\n").select(*single.columns))
    return out.filter(F.trim(F.col("text"), F.lit(" \r\t\n")) != "")


def field_count(record: Column) -> Column:
    """Fields of a CSV record: separators outside quotes, and one."""
    unquoted = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, '"[^"]*"', "")).otherwise(record)
    return count_of(unquoted, ",") + 1


# ------------------------------------------------------------------ JSON arrays
def _measured(batches):
    """One row a byte range from its pieces (``file, file_name, size, block, q, o0, o1, bytes``, ranges whole and in file order):
    pieces, bytes, quotes, and how much deeper the range ends, for both cases of what it starts in."""
    key, sums = None, []

    def row():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*key, *sums], _MEASURED.types)], _MEASURED.names)
    for batch in batches:
        names = [batch.column(i) for i in range(2)]
        block, q, o0, o1, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6, 7))
        for a, b in _runs(batch.column(0), block):
            now = (names[0][a].as_py(), names[1][a].as_py(), batch.column(2)[a].as_py(), int(block[a]))
            if now != key:
                if key:
                    yield row()
                key, sums = now, [0, 0, 0, 0, 0]
            deeper = [int(_deeper(q[a:b], o0[a:b], o1[a:b], (sums[2] + start) % 2).sum()) for start in (0, 1)]
            sums = [x + y for x, y in zip(sums, [b - a, int(size[a:b].sum()), int(q[a:b].sum()), *deeper])]
    if key:
        yield row()


_MEASURED = pa.schema([("file", pa.string()), ("file_name", pa.string()), ("size", pa.int64()), ("block", pa.int64()),
                       *[(x, pa.int64()) for x in ("n", "bytes", "q", "deeper0", "deeper1")]])


def _runs(names, block):
    """(start, end) of the runs of one byte range in a batch."""
    if not len(names):
        return []
    codes = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(block) != 0)) + 1).tolist(), len(codes)]
    return zip(cuts, cuts[1:])


def _deeper(q, o0, o1, quoted):
    """Braces that each piece opens, less its own ``}`` unless that stands in a string; ``quoted``: 1 if the first starts in one."""
    before = (quoted + np.cumsum(q) - q) % 2
    return np.where(before == 0, o0, o1) - ((before + q) % 2 == 0)


def _objects(batches):
    """Records of the byte ranges in ``batches`` (``rid, quoted, depth, n, pos, q, o0, o1, piece``, ranges whole and in file order).

    ``kind`` 0 is a whole record, 1 the text of a range before its first start, 2 a record that its range cuts.  ``n``
    is given for the range whose last piece ends its file without a brace: the ``}`` added to that piece is taken off.
    """
    rid, quoted, depth, seen, held, held_pos, lead = None, 0, 0, 0, [], None, False

    def left():
        return pa.RecordBatch.from_arrays([pa.array([rid], pa.int64()), pa.array([held_pos], pa.int64()), pa.array([1 if lead else 2], pa.int32()),
                                           pa.array([b"".join(held)], pa.binary())], ["rid", "pos", "kind", "text"])
    for batch in batches:
        ids, pos, q, o0, o1 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 4, 5, 6, 7))
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)] if len(ids) else [0]
        for a, b in zip(cuts, cuts[1:]):
            if ids[a] != rid:
                if held:
                    yield left()
                rid, quoted, depth, seen, held = ids[a], batch.column(1)[a].as_py(), batch.column(2)[a].as_py(), 0, []
                lead = depth > 0
            pieces, n = batch.column(8).slice(a, b - a), batch.column(3)[a].as_py()
            seen += b - a
            if n == seen:
                pieces = pa.concat_arrays([pieces.slice(0, b - a - 1), pa.array([pieces[b - a - 1].as_py()[:-1]], pa.binary())])
            after = depth + np.cumsum(_deeper(q[a:b], o0[a:b], o1[a:b], quoted))
            quoted, depth = int(quoted + q[a:b].sum()) % 2, int(after[-1])
            ends = np.flatnonzero(after <= 0)
            done = int(ends[-1]) + 1 if len(ends) else 0
            if done:
                starts = np.concatenate([[0], ends + 1])
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.concat_arrays([pieces.slice(0, done)])), b"")
                at, kinds = pos[a + starts[:-1]], np.zeros(len(ends), dtype=np.int32)
                if held:
                    texts = pa.concat_arrays([pa.array([b"".join([*held, texts[0].as_py()])], pa.binary()), texts.slice(1)])
                    at[0] = held_pos
                if lead:
                    kinds[0], lead = 1, False
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ends), rid), pa.int64()), pa.array(at, pa.int64()), pa.array(kinds, pa.int32()), texts],
                                                 ["rid", "pos", "kind", "text"])
                held = []
            if done < b - a:
                held_pos = held_pos if held else pos[a + done]
                held += pieces.slice(done).to_pylist()
    if held:
        yield left()


def json_records(spark: SparkSession, path) -> DataFrame:
    """``(file, file_name, block, pos, text)``: the objects of files that hold JSON arrays, or objects one after another.

    Pieces end at ``}``.  A piece opens braces outside strings, counted for both cases of what it
    starts in; its own ``}`` closes one unless it stands in a string.  An object runs from depth 0
    to the piece that returns to it; one that never ends is the last record of its file, as it is.
    One pass measures the byte ranges, one puts the objects together; only those cut by the end of a range are shuffled.
    """
    plain = F.regexp_replace("piece", r"(?s)\\.", "")

    def opened(text: Column) -> Column:
        return count_of(F.regexp_replace(F.regexp_replace(text, '"[^"]*"', ""), '"[^"]*$', ""), "{").cast("long")
    counts = [count_of(plain, '"').cast("long").alias("q"), opened(plain).alias("o0"), opened(F.concat(F.lit('"'), plain)).alias("o1")]
    parts = pieces(spark, path, "}")
    ranges = parts.select("file", "file_name", "size", "block", *counts, (F.octet_length("piece") + 1).cast("long").alias("bytes")).mapInArrow(
        _measured, "file string, file_name string, size long, block long, n long, bytes long, q long, deeper0 long, deeper1 long")
    ranges = materialize(ranges.withColumn("rid", F.monotonically_increasing_id()), "json_ranges")  # one row a byte range
    ahead = lambda c: F.coalesce(F.sum(c).over(_earlier("block")), F.lit(0))
    starts = ranges.withColumn("quoted", (ahead("q") % 2).cast("int"))
    starts = starts.withColumn("deeper", F.when(F.col("quoted") == 0, F.col("deeper0")).otherwise(F.col("deeper1")))
    # a file that does not end with a brace has a last piece without one
    of_file = Window.partitionBy("file")
    open_end = (F.sum("bytes").over(of_file) > F.col("size")) & (F.col("block") == F.max("block").over(of_file))
    starts = starts.select("file", "file_name", "block", "rid", "quoted", ahead("deeper").alias("depth"), F.when(open_end, F.col("n")).alias("n"))
    starts = F.broadcast(materialize(starts, "json_starts"))
    told = parts.select("file", "block", "pos", *counts, F.concat("piece", F.lit("}")).cast("binary").alias("piece")).join(starts.drop("file_name"), ["file", "block"])
    found = told.select("rid", "quoted", "depth", "n", "pos", "q", "o0", "o1", "piece").mapInArrow(_objects, "rid long, pos long, kind int, text binary")
    found = found.join(starts.select("rid", "file", "file_name", "block"), "rid").withColumn("text", F.col("text").cast("string"))
    cut = found.filter("kind > 0").withColumn("owner", F.last(F.when(F.col("kind") == 2, F.struct("block", "pos")), ignorenulls=True).over(
        of_file.orderBy("block", "pos")))
    out = ["file", "file_name", "block", "pos", "text"]
    joined = found.filter("kind = 0").select(*out).unionByName(_joined(cut.withColumnRenamed("text", "piece"), "").select(*out))
    return joined.withColumn("text", F.regexp_replace("text", r"(?s)^[\s\[,\]\x{FEFF}]+", "")).filter(F.col("text").contains("{"))


def read_json_objects(spark: SparkSession, path, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows of ``schema``, quarantine of unreadable objects as ``value``, ``file_name``) of large JSON files."""
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = json_records(spark, path).select("file_name", "text", F.from_json("text", wide, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("row"))
    good = parsed.filter(F.col(f"row.{CORRUPT}").isNull()).select("row.*").drop(CORRUPT)
    return good, parsed.filter(F.col(f"row.{CORRUPT}").isNotNull()).select(F.col("text").alias("value"), "file_name")
