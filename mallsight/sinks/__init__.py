"""Result sinks (SNK1-SNK8): CSV, JSON, named tables, summary bundle, snapshots.

Writers never funnel a result through one task: a CSV "file" is a directory
of part files.  Every sink runs its plan once; whether it was empty is observed
by the write itself.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"
#: CSV options under which text comes back as written: doubled quotes, line breaks and blanks kept.
CSV_EXACT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Dates/timestamps rendered as 'yyyy-MM-dd' text, as the sheet tables hold them."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            cols.append(F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "overwrite") -> str:
    """SNK1/SNK7: header CSV; UTF-8 with a byte-order mark on the header line.

    Text is written exactly: blanks at the ends stay, quotes are doubled (RFC
    4180).  The mark is carried by the first column name; ``spark.read.csv``
    and the readers here strip it again.
    """
    out = df
    if bom and df.columns:
        out = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    out.write.mode(mode).options(**CSV_EXACT).option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """SNK2: JSON lines (one document per line)."""
    df.write.mode(mode).json(path)
    return path


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with an observer of its row count: the write itself tells whether it was empty."""
    rows = Observation("rows")
    return df.observe(rows, F.count(F.lit(1)).alias("n")), rows


def overwrite_table(df: DataFrame, target: str, dates_as_text: bool = True) -> bool:
    """SNK3: replace a named table (or parquet path); an empty input keeps the old contents.

    The plan runs once, into a folder of its own.  At a path the old folder is moved aside, the new
    one in, and the old one deleted last; if moving in fails, the old one moves back.  (Readers
    that must never find the path empty use ``published.publish``.)  A named table is switched to
    the new folder by its catalog entry; the version before stays on disk until the next
    overwrite.  Returns whether anything was written.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    named = not _is_path(target)
    home = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{target.replace('.', '_')}__versions" if named else ""
    new = f"{home}/{uuid.uuid4().hex}" if named else target.rstrip("/") + f"__new_{uuid.uuid4().hex[:8]}"
    fs = path(new).getFileSystem(spark._jsc.hadoopConfiguration())
    out, rows = _counted(_dates_as_text(df) if dates_as_text else df)
    try:
        out.write.parquet(new)
        if not rows.get["n"]:
            fs.delete(path(new), True)
            return False
    except BaseException:
        fs.delete(path(new), True)
        raise
    if named:
        _switch_location(spark, target, new, home)
    else:
        _swap_folders(fs, path, new, target.rstrip("/"))
    return True


def _swap_folders(fs, path, new: str, target: str) -> None:
    """Move ``new`` to ``target``; what was there is deleted only after that, or moved back."""
    old = target + f"__old_{uuid.uuid4().hex[:8]}"
    had = fs.exists(path(target))
    if had and not fs.rename(path(target), path(old)):
        raise OSError(f"cannot move {target} aside; the new rows are in {new}")
    if not fs.rename(path(new), path(target)):
        if had:
            fs.rename(path(old), path(target))
        raise OSError(f"cannot move {new} to {target}; the old rows are in place, the new ones in {new}")
    if had:
        fs.delete(path(old), True)


def _switch_location(spark, table: str, new: str, home: str) -> None:
    """Point a catalog table at folder ``new`` and drop its versions but this one and the one before."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(new).getFileSystem(spark._jsc.hadoopConfiguration())
    before = ""
    if spark.catalog.tableExists(table):
        before = next((r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Location"), "")
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in spark.read.parquet(new).schema]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        else:  # another schema needs another entry; the rows are on disk already
            spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{new}'")
    spark.catalog.refreshTable(table)
    for s in fs.listStatus(path(home)):
        name = s.getPath().getName()
        if name != new.rsplit("/", 1)[1] and name != before.rstrip("/").rsplit("/", 1)[-1]:
            fs.delete(s.getPath(), True)


def append_table(df: DataFrame, target: str, dates_as_text: bool = True) -> bool:
    """SNK4: append rows in one execution; empty input adds no rows.  Returns whether there were any.

    Running it again adds the rows again; ``append_run`` does not."""
    out, rows = _counted(_dates_as_text(df) if dates_as_text else df)
    w = out.write.mode("append")
    if _is_path(target):
        w.parquet(target)
    else:
        w.saveAsTable(target)
    return rows.get["n"] > 0


#: Table name under which a root that holds one published table keeps it.
ROWS = "rows"


def append_run(df: DataFrame, target: str, run: str, dates_as_text: bool = True) -> bool:
    """SNK4: append the rows of run ``run``; running it again replaces that run's rows.

    A path holds a published table ``rows`` (one part a run, one commit a write).  A named table
    is partitioned by ``run``, and only the run's own partition is overwritten.  An empty input
    leaves the table as it is.  Returns whether there were any rows.
    """
    spark = df.sparkSession
    if _is_path(target):
        from .published import publish
        return publish(spark, target, {ROWS: df}, run=run, dates_as_text=dates_as_text)[ROWS]
    from ..session import unique_dir
    out, rows = _counted(_dates_as_text(df) if dates_as_text else df)
    staged, key = unique_dir(spark, "run"), run.replace("\\", "\\\\").replace("'", "\\'")
    out.write.parquet(staged)
    if not rows.get["n"]:
        return False
    part = spark.read.parquet(staged)
    if not spark.catalog.tableExists(target):
        part.withColumn("run", F.lit(run)).write.partitionBy("run").saveAsTable(target)
    else:
        spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION (run = '{key}') SELECT * FROM {{part}}", part=part)
    return True


# Names of the four summary tables.
SUMMARY_TABLES = ("日別売上", "月別売上", "商品別売上", "サマリー")


def summary_bundle(daily: DataFrame, monthly: DataFrame, products: DataFrame, kv: DataFrame,
                   target_dir: str) -> dict[str, bool]:
    """SNK5: daily, monthly, top-50 products and the key/value summary, published in one commit.

    Readers (``published.read_published``) see the four tables of one run, never of two."""
    from .published import publish
    frames = (daily, monthly, products.limit(50), kv)
    return publish(daily.sparkSession, target_dir, dict(zip(SUMMARY_TABLES, frames)))


def export_csvs(daily: DataFrame, products: DataFrame, lines: DataFrame, target_dir: str) -> list[str]:
    """SNK7: daily, product and all-row CSV exports."""
    return [write_csv(daily, f"{target_dir}/daily"), write_csv(products, f"{target_dir}/products"),
            write_csv(lines, f"{target_dir}/lines")]


def write_snapshot(lines: DataFrame, path: str) -> bool:
    """SNK8: order lines partitioned by order_date; only the dates present are replaced.

    One execution: the rebalance hint gathers a date's rows in one task and AQE
    splits a hot date over several; an empty input replaces nothing.
    """
    out, rows = _counted(lines)
    (out.hint("rebalance", "order_date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("order_date").parquet(path))
    return rows.get["n"] > 0


def stamp(prefix: str, at: dt.datetime) -> str:
    """Timestamped object name (import files, exports): prefix_YYYYmmdd_HHMMSS."""
    return f"{prefix}_{at.strftime('%Y%m%d_%H%M%S')}"


def write_bucketed_lines(lines: DataFrame, table: str, buckets: int, mode: str = "overwrite") -> str:
    """Canonical order lines as a catalog table bucketed (and sorted) by ``order_number``.

    Later order-grain aggregates read the buckets already clustered by the
    order key, so their big exchange disappears (``spark.sql.sources.bucketing``
    is on by default).  Bucket count ~ table size / 256 MB; partition by date
    instead (``write_snapshot``) when reads are mostly date-bounded.
    """
    (lines.write.mode(mode).format("parquet")
          .bucketBy(buckets, "order_number").sortBy("order_number").saveAsTable(table))
    return table


def materialize(df: DataFrame, prefix: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage of a result that several outputs read (no recomputation
    of the upstream scans and joins per output) and survives lost executors:
    written files, not cached blocks, back every later read.
    """
    from ..session import unique_dir
    path = unique_dir(df.sparkSession, prefix)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
