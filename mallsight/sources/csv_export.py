"""CSV order exports (SRC13-SRC15, PRJ10-PRJ14) and the import dataset (SNK6, SRC14, WIN2).

Raw exports arrive with one of several header vocabularies and encodings.
Parsing reads every column as text (no inference), canonicalises the headers
(first present alias wins, D21), cleans numbers and fills absent columns.
Cleaned imports are appended to a parquet dataset partitioned by
``import_id``; loading it keeps the last row per (order_number, item_name)
across imports.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.money import clean_int
from ..functions.time import ntz, parse_lenient_time
from ..operators.flatten import parse_once
from ..schema import IMPORTED_ORDER
from ..sinks import CSV_EXACT, materialize
from .readers import _empty, path_exists
from .split_records import csv_records, field_count, pieces

# Accepted header names per canonical column, in precedence order.
HEADER_ALIASES = {
    "order_number": ["注文ID", "オーダーID", "OrderId"],
    "order_date": ["注文日時", "注文日", "OrderTime"],
    "item_name": ["商品名", "Title", "商品タイトル"],
    "quantity": ["数量", "Quantity", "個数"],
    "unit_price": ["単価", "UnitPrice", "商品単価"],
    "subtotal": ["小計", "SubTotal", "商品小計"],
    "total_price": ["合計金額", "TotalPrice", "請求金額"],
    "use_point": ["ポイント利用", "UsePoint"],
    "coupon_discount": ["クーポン割引", "CouponDiscount"],
}
_ALIASES = [a for names in HEADER_ALIASES.values() for a in names]
REQUIRED = ["order_number", "order_date"]
# Default item name when the export has no name column; store label.
UNKNOWN_ITEM = "不明"
CSV_SOURCE = "Yahoo"
BOM = "\ufeff"


def _enable_legacy_charsets(spark: SparkSession) -> None:
    # windows-31j (cp932) is only accepted with the legacy charset list (H2).
    if spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def write_export(df: DataFrame, path: str, encoding: str = "windows-31j", mode: str = "overwrite", compression: str = "none") -> str:
    """An export file set in the given encoding (header line first in every part).

    Compressed files are read by one task each: only for frames whose partitions are of a bounded size.
    """
    if encoding.upper().replace("-", "") != "UTF8":
        _enable_legacy_charsets(df.sparkSession)
    df.write.mode(mode).options(**CSV_EXACT).option("header", True).option("encoding", encoding).csv(path, compression=compression)
    return path


@contextmanager
def _lenient_decoding(spark: SparkSession):
    """Expressions analysed inside accept cp932 and turn undecodable bytes into U+FFFD; the session is left as it was."""
    flags = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {f: spark.conf.get(f, None) for f in flags}
    for f in flags:
        spark.conf.set(f, "true")
    try:
        yield
    finally:
        for f, v in before.items():
            spark.conf.unset(f) if v is None else spark.conf.set(f, v)


_UTF8 = "UTF-8"
#: Field parser: RFC 4180, blanks kept, an empty field is NULL.
_FIELDS = CSV_EXACT | {"mode": "PERMISSIVE"}


def _with_fields(df: DataFrame, n: int, name: str, text: str) -> DataFrame:
    """``df`` with the first ``n`` fields of a record as an array (absent ones NULL); each record is parsed once."""
    schema = ", ".join(f"c{i} string" for i in range(n))
    return df.select("*", *parse_once(F.from_csv(F.col(text), F.lit(schema), _FIELDS).alias("_row"))) \
        .withColumn(name, F.array(*[F.col("_row")[f"c{i}"] for i in range(n)])).drop("_row")


def _export_rows(spark: SparkSession, path, encoding: str) -> tuple[DataFrame, DataFrame]:
    """(records, files) of an export: every file by its own header and its own charset.

    ``records``: ``file, file_name, position, value, header, at, n_fields, fields`` of the records below
    the headers; ``at`` are the fields' places for ``_ALIASES``, found once a file.  ``files``: one row a file, ``file, bad, header, n_fields``.  A file is UTF-8 (undecodable bytes dropped)
    when its bytes are not valid in ``encoding``.  Files are read in byte ranges by many tasks
    (``split_records``); one pass finds charsets and headers, one reads the records.
    """
    lines = pieces(spark, path, "\n")
    raw = F.col("piece").cast("binary")
    declared_utf8 = encoding.upper().replace("-", "") == "UTF8"
    with _lenient_decoding(spark):
        bad = F.lit(False) if declared_utf8 else F.max(F.decode(raw, encoding).contains("\ufffd"))
        ranges = lines.groupBy("file", "block").agg(bad.alias("bad"), F.min("pos").alias("first"),
                                                    F.min_by(F.when(F.col("block") == 0, raw), "pos").alias("head"))
        ranges = materialize(ranges, "csv_ranges")  # one row a byte range

        def decoded(b):
            if declared_utf8:
                return F.decode(b, _UTF8)
            return F.when(F.col("bad"), F.replace(F.decode(b, _UTF8), F.lit("\ufffd"), F.lit(""))).otherwise(F.decode(b, encoding))
        files = ranges.groupBy("file").agg(F.max("bad").alias("bad"), F.max("head").alias("head"))
        files = files.withColumn("head", F.regexp_replace(decoded(F.col("head")), f"^{BOM}|\r$", ""))
        n = files.agg(F.max(field_count(F.col("head")))).first()[0] or 1
        files = materialize(_with_fields(files, n, "header", "head").withColumn("n_fields", field_count(F.col("head")))
                            .select("file", "bad", F.slice("header", F.lit(1), F.col("n_fields")).alias("header"), "n_fields")
                            .withColumn("at", F.array(*[_place(a) for a in _ALIASES])), "csv_files")
        records = (csv_records(lines).join(ranges.select("file", "block", "first"), ["file", "block"]).join(files, "file")
                   .filter((F.col("block") > 0) | (F.col("pos") > F.col("first")))
                   .select("file", "file_name", "block", "pos", "first", "header", "at", "n_fields",
                           *parse_once(F.regexp_replace(decoded(F.col("text").cast("binary")), "\r$", "").alias("value"))))
    # a byte range has no more lines than bytes, so this rises through the file
    position = F.col("block") + F.col("pos") - F.col("first")
    records = _with_fields(records.select("file", "file_name", position.alias("position"), "value", "header", "at", "n_fields"), n, "fields", "value")
    return records, files


def _right_width():
    return field_count(F.col("value")) == F.col("n_fields")


def read_raw_export(spark: SparkSession, path, encoding: str = "windows-31j") -> DataFrame:
    """SRC13/SRC15: an export as all-text columns, header from the files; the well-formed rows."""
    return read_raw_export_checked(spark, path, encoding)[0]


def read_raw_export_checked(spark: SparkSession, path, encoding: str = "windows-31j") -> tuple[DataFrame, DataFrame]:
    """SRC13/SRC15: (well-formed rows as text columns, rows with a wrong number of fields).

    RFC 4180: fields in double quotes may hold commas, doubled quotes and line breaks; blanks are
    kept, empty fields are NULL.  Columns are matched by each file's own header, so files may order
    them differently; a column that a file lacks is NULL there.  Columns come in the order of the
    first file that has them.  The second frame has ``value`` (the row's text) and ``file_name``.
    ``path`` is one path or a list.
    """
    records, files = _export_rows(spark, path, encoding)
    names = (files.select("file", F.posexplode("header").alias("at", "name")).groupBy("name").agg(F.min(F.struct("file", "at")).alias("seen"))
             .orderBy("seen").collect())  # column names only
    raw = records.filter(_right_width()).select(*[_named(r.name).alias(r.name) for r in names])
    return raw, records.filter(~_right_width()).select("value", "file_name")


def _place(column: str):
    """Index of a header name's field, NULL when the file has no such column."""
    return F.nullif(F.array_position("header", column), F.lit(0)).cast("int") - 1


def _named(column: str):
    """The field under a header name, NULL when the file has no such column."""
    return F.get("fields", _place(column))


def _places(key: str):
    """Places of a canonical column's accepted names, by precedence."""
    return [F.get("at", F.lit(_ALIASES.index(a))) for a in HEADER_ALIASES[key]]


def _require(missing: list[str], where: str = "") -> None:
    if missing:
        raise ValueError(f"required columns missing{where}: {missing}")


def _each(clean, *columns: str):
    """``clean`` of each column, as an array."""
    return F.transform(F.array(*columns), lambda c: clean(c))  # a function of two arguments would get the position too


def _canonical(rows: DataFrame) -> DataFrame:
    """PRJ10-PRJ14: canonical columns, cleaned numbers, defaults, net sales; ``_file`` and ``_pos`` of each record.

    Each field is picked once, by the accepted names of its column in the file's own header, and
    cleaned once; a column none of whose names the header has takes its default.
    """
    has = lambda k: F.coalesce(*_places(k)).isNotNull()
    numbers = ("quantity", "unit_price", "subtotal", "use_point", "coupon_discount", "total_price")
    picked = rows.select("file_name", "position", *parse_once(
        *[F.coalesce(*[F.get("fields", i) for i in _places(k)]).alias(k) for k in HEADER_ALIASES], *[has(k).alias(f"_has_{k}") for k in (*numbers, "item_name")]))
    # one expression over an array: written out per column, the generated code is too large to be compiled
    cleaned = picked.select("file_name", "position", "order_number", "item_name", *[f"_has_{k}" for k in (*numbers, "item_name")], *parse_once(
        _each(parse_lenient_time, "order_date").alias("_t"), _each(clean_int, *numbers).alias("_n")))
    given = lambda k, value, absent: F.when(F.col(f"_has_{k}"), value).otherwise(F.lit(absent))
    absent = {"quantity": 1, "total_price": None, "subtotal": None}                    # no quantity column -> 1 (D20)
    cleaned = cleaned.select("file_name", "position", "order_number", F.col("_t")[0].alias("order_date"), "_has_subtotal", "_has_total_price",
                             given("item_name", F.col("item_name"), UNKNOWN_ITEM).alias("item_name"),
                             *[given(k, F.col("_n")[i], absent.get(k, 0)).cast("bigint").alias(k) for i, k in enumerate(numbers)])
    cleaned = cleaned.withColumn("subtotal", F.when(F.col("_has_subtotal"), F.col("subtotal")).otherwise(F.col("unit_price") * F.col("quantity")))
    net = F.when(F.col("_has_total_price"), F.col("total_price") - F.col("use_point") - F.col("coupon_discount")).otherwise(F.col("subtotal"))
    return cleaned.select("order_number", "order_date", "item_name", "quantity", "unit_price", "subtotal", "total_price", "use_point",
                          "coupon_discount", net.alias("order_net_sales"), F.lit(CSV_SOURCE).alias("source"),
                          F.col("file_name").alias("_file"), F.col("position").alias("_pos"))


def _lacking():
    """Required canonical columns for which a file's header has none of the accepted names."""
    return F.array_compact(F.array(*[F.when(~F.arrays_overlap("header", F.array(*map(F.lit, HEADER_ALIASES[k]))), F.lit(k))
                                     for k in REQUIRED]))


def required_columns(spark: SparkSession, path: str, encoding: str = "windows-31j") -> DataFrame:
    """PRJ14: ``(file, missing, n_records)``, one row a file; ``missing`` is empty where the file can be parsed."""
    records, files = _export_rows(spark, path, encoding)
    counts = records.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return (files.select("file", _lacking().alias("missing")).join(counts, "file", "left")
            .select("file", "missing", F.coalesce("n", F.lit(0)).alias("n_records")))


def parse_order_csv(spark: SparkSession, path: str, encoding: str = "windows-31j", skip_incomplete: bool = False) -> DataFrame:
    """SRC13 + PRJ10-PRJ14: decode with ``encoding``, else UTF-8 ignoring bad bytes.

    Every file is read by its own header and decided by its own content: files that are not valid
    in the declared encoding are read as UTF-8.  Rows with a wrong number of fields are left to
    ``quarantined_rows``.  A file without a required column raises ``ValueError``, or with
    ``skip_incomplete`` is left to ``required_columns``.
    """
    records, files = _export_rows(spark, path, encoding)
    if skip_incomplete:
        records = records.filter(F.size(_lacking()) == 0)
    else:
        short = files.select("file", _lacking().alias("missing")).filter(F.size("missing") > 0).first()
        if short is not None:
            _require(short.missing, f" in {short.file}")
    return _canonical(records.filter(_right_width()))


def quarantined_rows(spark: SparkSession, path: str, encoding: str = "windows-31j") -> DataFrame:
    """SRC13: rows of an export with a wrong number of fields (``value``, ``file_name``)."""
    return _export_rows(spark, path, encoding)[0].filter(~_right_width()).select("value", "file_name")


# File name pattern of saved imports.
SAVED_GLOB = "yahoo_orders_*.csv"


def save_import_csv(df: DataFrame, root: str, import_id: str) -> str:
    """SNK6 (file form): canonical rows as UTF-8+BOM CSV under ``root/yahoo_orders_<id>.csv/``.

    Times are written as ``yyyy-MM-dd HH:mm:ss``, a layout the loader reads.
    """
    from ..sinks import write_csv
    cols = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t == "timestamp_ntz" else F.col(c)
            for c, t in df.dtypes if not c.startswith("_")]
    return write_csv(df.select(*cols), f"{root}/yahoo_orders_{import_id}.csv")


def _saved_imports(spark: SparkSession, root: str) -> list[str]:
    """Saved imports under ``root``: plain files, or folders of part files (one name per import)."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{SAVED_GLOB}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(str(f.getPath().toString()) for f in (found or []))


def load_saved_csv(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """SRC14 (file form): every saved import under ``root`` that matches the pattern.

    Imports are plain ``yahoo_orders_<stamp>.csv`` files or folders of that name;
    columns are matched by header name, absent ones are NULL.  Import order =
    name, which carries the save timestamp; then keep-last per (order_number,
    item_name) and optional bounds (FLT10).
    """
    from ..operators.grain import keep_last
    cols = [f.name for f in IMPORTED_ORDER.fields if f.name not in ("import_id", "row_seq", "file_name")]
    paths = _saved_imports(spark, root)
    if not paths:
        return _empty(spark, IMPORTED_ORDER).select(*cols)
    picked = _export_rows(spark, paths, "UTF-8")[0].filter(_right_width()).select(
        "file", "file_name", "position", *parse_once(*[_named(c).alias(c) for c in cols]))
    numbers = ("quantity", "unit_price", "subtotal", "use_point", "coupon_discount", "order_net_sales")
    typed = picked.select("file", "file_name", "position", "order_number", "item_name", "total_price", "source", *parse_once(
        _each(parse_lenient_time, "order_date").alias("_t"), _each(clean_int, *numbers).alias("_n"))).select(
        "order_number", F.col("_t")[0].alias("order_date"), "item_name", *[F.col("_n")[i].alias(c) for i, c in enumerate(numbers)],
        F.col("total_price").try_cast("bigint").alias("total_price"), "source", F.regexp_extract("file", r"/(yahoo_orders_[^/]+)\.csv(?:/|$)", 1).alias("import_id"),
        "file_name", F.col("position").alias("row_seq"))
    last = keep_last(typed, ("order_number", "item_name"), ("import_id", "file_name", "row_seq"),
                     columns=["order_number", "item_name", *[c for c in cols if c not in
                                                             ("order_number", "item_name")]])
    if start is not None:
        last = last.filter(F.col("order_date") >= ntz(start))
    if end is not None:
        last = last.filter(F.col("order_date") <= ntz(end))
    return last.select(*cols)


def as_import(df: DataFrame, import_id: str) -> DataFrame:
    """Tag canonical rows with their import and a sequence that follows file order.

    ``row_seq`` orders rows by (file name, position in file); it is only used
    to order rows of the same import.
    """
    return df.select(*[c for c in df.columns if not c.startswith("_")],
                     F.lit(import_id).alias("import_id"),
                     F.col("_pos").alias("row_seq"), F.col("_file").alias("file_name"))


def save_imports(df: DataFrame, root: str, mode: str = "append") -> None:
    """SNK6: append cleaned rows to the import dataset (parquet, partitioned by import_id)."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy("import_id").parquet(root))


def load_saved_imports(spark: SparkSession, root: str, start=None, end=None, keep_order: bool = False) -> DataFrame:
    """SRC14 + WIN2 + FLT10: all imports; last row per (order_number, item_name); optional bounds.

    Import ids sort in arrival order (timestamped names); inside an import the
    row order is (file name, position).  Rows whose time failed to parse drop
    out only when a bound is given.  ``keep_order`` adds those three columns.
    """
    from ..operators.grain import keep_last
    order = ["import_id", "file_name", "row_seq"]
    cols = [f.name for f in IMPORTED_ORDER.fields if f.name not in order]
    out = [*cols, *order] if keep_order else cols
    if not path_exists(spark, root):
        return _empty(spark, IMPORTED_ORDER).select(*out)
    df = spark.read.parquet(root)
    last = keep_last(df, ("order_number", "item_name"), order,
                     columns=["order_number", "item_name", *[c for c in out if c not in
                                                             ("order_number", "item_name")]])
    if start is not None:
        last = last.filter(F.col("order_date") >= ntz(start))
    if end is not None:
        last = last.filter(F.col("order_date") <= ntz(end))
    return _with_arrival(last, df).select(*out, "arrival") if keep_order else last.select(*out)


#: Positions in one file stay below this.
FILE_STRIDE = 2**42


def _with_arrival(rows: DataFrame, imports: DataFrame) -> DataFrame:
    """``rows`` of ``imports`` with ``arrival``, a number that rises with (import id as text, file name, position), NULLs first.

    Only the files are ranked (one row a file), so no row is sorted or shuffled for it.
    """
    files = imports.select(F.col("import_id").cast("string").alias("_import"), F.col("file_name").alias("_name")).distinct()
    files = files.withColumn("_rank", F.row_number().over(Window.orderBy("_import", "_name")).cast("bigint"))
    known = F.col("import_id").cast("string").eqNullSafe(F.col("_import")) & F.col("file_name").eqNullSafe(F.col("_name"))
    fits = (F.col("row_seq").between(0, FILE_STRIDE - 2) | F.col("row_seq").isNull()) & (F.col("_rank") < 2**63 // FILE_STRIDE)
    place = F.col("_rank") * FILE_STRIDE + F.coalesce(F.col("row_seq") + 1, F.lit(0))
    arrival = F.when(fits, place).otherwise(F.raise_error(F.lit("position or number of files out of range")).cast("bigint"))
    return rows.join(F.broadcast(files), known, "left").withColumn("arrival", arrival)


def imports_as_order_lines(df: DataFrame) -> DataFrame:
    """Imported CSV rows -> canonical order lines (one document per import row).

    With the columns of ``load_saved_imports(keep_order=True)``, or its three order columns alone, the rows of
    an order keep their arrival order; without them all rows tie.
    """
    from ..functions.time import with_time_parts
    from ..operators.grain import numbered
    from ..schema import ORDER_LINE_COLUMNS
    seq = F.lit(0).cast("bigint")
    if "arrival" in df.columns:
        seq = F.col("arrival")
    elif {"import_id", "file_name", "row_seq"} <= set(df.columns):
        # a rank over all rows: one order number (an empty one, say) may stand on any share of them
        df = numbered(df.withColumn("import_id", F.col("import_id").cast("string")), ("import_id", "file_name", "row_seq"), "_arrival")
        seq = F.col("_arrival").cast("bigint")
    lines = df.select(
        "order_number", F.col("order_date").alias("order_datetime"),
        F.lit(None).cast("string").alias("item_id"), "item_name", F.lit("").alias("item_number"),
        "unit_price", "quantity", "subtotal", F.col("use_point").alias("point_used"),
        F.col("coupon_discount").alias("coupon_used"), F.lit(0).cast("bigint").alias("shipping_charge"),
        "total_price", "order_net_sales", F.lit("").alias("payment_method"),
        F.lit(None).cast("int").alias("status"), "source", F.lit("Y").alias("mall"),
        F.lit(0).cast("bigint").alias("line_seq"), seq.alias("ingest_seq"))
    return with_time_parts(lines).select(*ORDER_LINE_COLUMNS)
