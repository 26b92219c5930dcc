"""Readers of landed marketplace documents (SRC1-SRC12, SRC15-SRC18).

All readers take an explicit schema (no inference) and return lazy
DataFrames.  A missing location gives an empty DataFrame of the same schema
("missing file -> empty"); every other failure (permission, damaged file,
wrong schema) raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import R_ORDER, R_SEARCH_PAGE

#: Document sequences of one store stay below this (epoch microseconds do, for 2,000 years).
STORE_STRIDE = 2**56
R_ORDER_LANDED = T.StructType(R_ORDER.fields + [T.StructField("_ingest_seq", T.LongType())])


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a glob pattern, names anything in its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


# Amounts arrive as JSON numbers with or without decimals; they are read as
# decimals and truncated, so 1000.0 is 1000 and not a missing value.
_AMOUNT = T.DecimalType(20, 2)
CORRUPT = "_corrupt"


def _with_decimals(schema: T.DataType) -> T.DataType:
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, f.dataType if f.name.startswith("_") else _with_decimals(f.dataType))
                             for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(_with_decimals(schema.elementType))
    return _AMOUNT if isinstance(schema, T.LongType) else schema


def read_order_json(spark: SparkSession, path: str, multi_line: bool = False,
                    schema: T.StructType = R_ORDER_LANDED) -> DataFrame:
    """SRC1: R order documents; the readable ones of ``read_order_json_checked``."""
    return read_order_json_checked(spark, path, multi_line, schema)[0]


def _any_length(column: str):
    # always true; Spark refuses to read the corrupt-record column alone, so
    # filters on it also refer to a parsed column
    return F.length(F.concat_ws("", F.col(f"`{column}`").cast("string"))) >= 0


def well_formed(raw: DataFrame, column: str) -> DataFrame:
    """The records of a text-format read that are not malformed, without the corrupt-record column."""
    return raw.filter(F.col(CORRUPT).isNull() & _any_length(column)).drop(CORRUPT)


def corrupt_rows(raw: DataFrame, column: str) -> DataFrame:
    """``value`` and ``file_name`` of the malformed records of a text-format read."""
    return raw.filter(F.col(CORRUPT).isNotNull() & _any_length(column)).select(
        F.col(CORRUPT).alias("value"), F.col("_metadata.file_name").alias("file_name"))


def read_order_json_checked(spark: SparkSession, path: str, multi_line: bool = False,
                            schema: T.StructType = R_ORDER_LANDED) -> tuple[DataFrame, DataFrame]:
    """SRC1: (R order documents, quarantine of malformed ones as ``value``, ``file_name``).

    ``multi_line=True`` reads a pretty-printed JSON array per file (one task per
    file); landed data is JSON lines, split across tasks by size.
    """
    if not path_exists(spark, path):
        return _empty(spark, schema), _empty(spark, T.StructType([T.StructField("value", T.StringType()),
                                                                  T.StructField("file_name", T.StringType())]))
    wide = T.StructType(_with_decimals(schema).fields + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(wide).option("multiLine", multi_line).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    good = well_formed(raw, schema.fieldNames()[0]).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, corrupt_rows(raw, schema.fieldNames()[0])


def read_store_orders(spark: SparkSession, root: str, stores) -> DataFrame:
    """SRC5: documents of the configured stores, in configuration order.

    Landed as ``root/store=<name>/``; one scan with partition pruning on the
    store list.  ``_ingest_seq`` becomes (store position, document position) so
    keep-first semantics follow store order first; sequences that do not fit
    below ``STORE_STRIDE`` raise an error.
    """
    stores = list(stores)
    schema = T.StructType(R_ORDER_LANDED.fields + [T.StructField("store", T.StringType())])
    df = read_order_json(spark, root, schema=schema).filter(F.col("store").isin(stores))
    pos = F.lit(None).cast("bigint")
    for i, s in reversed(list(enumerate(stores))):
        pos = F.when(F.col("store") == s, F.lit(i).cast("bigint")).otherwise(pos)
    seq = F.col("_ingest_seq")
    fits = F.when(seq.between(0, STORE_STRIDE - 1), seq).when(seq.isNotNull(), F.raise_error(
        F.concat(F.lit("document sequence out of range: "), seq)).cast("bigint"))
    return (df.withColumn("_store_name", F.coalesce("_store_name", "store"))
              .withColumn("_ingest_seq", pos * STORE_STRIDE + fits).drop("store"))


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: concatenated id lists of the readable search pages (one row per order number)."""
    return read_search_pages_checked(spark, path)[0].select(F.explode("orderNumberList").alias("order_number"))


def read_search_pages_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC3: (search pages, quarantine of unreadable ones as ``value``, ``file_name``).

    A page has ``chain`` (the search it belongs to), ``page`` from 1, and the response's columns.
    """
    schema = T.StructType([T.StructField("chain", T.StringType()), T.StructField("page", T.LongType()), *R_SEARCH_PAGE.fields])
    if not path_exists(spark, path):
        return _empty(spark, schema), _empty(spark, T._parse_datatype_string("value string, file_name string"))
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return well_formed(raw, "page"), corrupt_rows(raw, "page")


def page_gaps(pages: DataFrame) -> DataFrame:
    """SRC3/SRC6/SRC11: what is wrong with paged reads: ``(chain, kind, first_page, last_page, n)``.

    ``pages`` has ``chain, page, total_pages``, one row for each readable page.  ``missing`` is a run of
    ``n`` absent pages between 1 and the largest total the chain's pages state (or its last page, if
    none does); ``repeated`` a page read ``n`` times; ``beyond`` a page above the total.  A chain without any
    readable page cannot be known.  Gaps come from neighbouring pages, so no page list is generated.
    """
    seen = pages.filter(F.col("page").isNotNull()).groupBy("chain", "page").agg(F.count("*").alias("n"), F.max("total_pages").alias("total"))
    order = Window.partitionBy("chain").orderBy("page")
    seen = (seen.withColumn("total", F.max("total").over(Window.partitionBy("chain")))
            .withColumn("before", F.coalesce(F.lag("page").over(order), F.lit(0)))
            .withColumn("last", F.lead("page").over(order).isNull()))
    span = lambda a, b: F.struct(F.lit("missing").alias("kind"), a.cast("long").alias("first_page"), b.cast("long").alias("last_page"),
                                 (b - a + 1).cast("long").alias("n"))
    one = lambda kind: F.struct(F.lit(kind).alias("kind"), F.col("page").alias("first_page"), F.col("page").alias("last_page"), "n")
    page, total = F.col("page"), F.col("total")
    within = F.least(page - 1, F.coalesce(total, page - 1))
    found = F.array(F.when(within > F.col("before"), span(F.col("before") + 1, within)),
                    F.when(F.col("last") & (total > page), span(page + 1, total)),
                    F.when(F.col("n") > 1, one("repeated")), F.when(page > total, one("beyond")))
    return seen.select("chain", F.explode(F.array_compact(found)).alias("gap")).select("chain", "gap.*")


def details_for_ids(details: DataFrame, ids: DataFrame, key: str = "orderNumber") -> DataFrame:
    """SRC4/JON4: details of the searched ids (left semi join, ids drop falsy values)."""
    ids = ids.filter(F.nullif(F.col("order_number"), F.lit("")).isNotNull())
    return details.join(ids, details[key] == ids.order_number, "left_semi")


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """Y XML responses landed one document per line, with their arrival order.

    Landed as JSON lines ``{value, ingest_seq}`` so the arrival sequence
    travels with each document.
    """
    schema = "value string, ingest_seq bigint"
    if not path_exists(spark, path):
        return _empty(spark, T._parse_datatype_string(schema))
    return spark.read.schema(schema).json(path)


def read_graphql_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: GraphQL pages landed as ``{set_seq, page, value}`` JSON lines."""
    schema = "set_seq int, page bigint, value string"
    if not path_exists(spark, path):
        return _empty(spark, T._parse_datatype_string(schema))
    return spark.read.schema(schema).json(path)


def read_table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """SRC16: a named table, or an empty one of the given schema when absent."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return _empty(spark, schema)


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """SRC16 for path-named tables: the table, or an empty one of ``schema`` when absent."""
    return spark.read.parquet(path) if path_exists(spark, path) else _empty(spark, schema)


def read_snapshot(spark: SparkSession, path: str, start=None, end=None,
                  schema: T.StructType | None = None) -> DataFrame:
    """SRC17: result snapshot partitioned by ``order_date``; bounds prune partitions."""
    if schema is not None and not path_exists(spark, path):
        return _empty(spark, schema)
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter(F.col("order_date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("order_date") <= F.lit(end))
    return df


def prefer_first_nonempty(primary: DataFrame, fallback: DataFrame, probe: DataFrame | None = None) -> DataFrame:
    """SRC18: the primary source when it has any row, else the fallback.

    ``probe`` is a cheap frame that has rows exactly when ``primary`` has (its
    stored rows, before any aggregation): one ``head(1)`` reads one row of it.
    """
    return primary if (primary if probe is None else probe).head(1) else fallback
