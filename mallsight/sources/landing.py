"""Landing area for raw documents derived from the driver tables.

Registered queries that exercise a file reader first land documents built by
Spark from the driver tables (``sources.documents``) below the shared
checkpoint folder, then read them back through the reader under test.  A
landing is written once per session folder and scale directory, through
Spark's commit protocol (a lost executor re-runs its write task), and is
reused by later queries.
"""

from __future__ import annotations

import hashlib
import os
import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

# Part of every landing path; raise it when a document builder changes.
LANDING_VERSION = "v2"


def landed_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Landing folder for one scale directory, builder version and Spark application.

    Keyed by application id so concurrent jobs sharing the checkpoint folder
    never overwrite each other's landings.
    """
    tag = re.sub(r"[^A-Za-z0-9.]+", "_", os.path.basename(sf_dir.rstrip("/"))) + "-" + \
        hashlib.sha1(sf_dir.encode()).hexdigest()[:8]
    app = re.sub(r"[^A-Za-z0-9_.-]+", "_", spark.sparkContext.applicationId)
    return shared_dir(spark, "landed", LANDING_VERSION, app, tag, name)


#: Rows of one large landed file: enough for many byte ranges, few enough for one task to write.
FILE_ROWS = 2_000_000


def in_large_files(df: DataFrame, order_cols, n_rows: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` in the order of ``order_cols``, as one partition for each ``file_rows`` rows (one file, as long as it stays below)."""
    n = max(1, -(-n_rows // file_rows))
    return (df.repartitionByRange(n, *order_cols) if n > 1 else df.coalesce(1)).sortWithinPartitions(*order_cols)


# Paths this driver has landed (landing paths are per application, so the
# record never outlives the data it describes).
_LANDED: set[str] = set()


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """The shuffle files of a write inside are deleted when it ends (else when the driver next collects its garbage)."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def land(spark: SparkSession, sf_dir: str, name: str, build, write) -> str:
    """Write ``build()`` with ``write(df, path)`` unless already landed; return the path."""
    path = landed_path(spark, sf_dir, name)
    if path not in _LANDED:
        df: DataFrame = build()
        with _shuffles_freed(spark):
            write(df, path)
        _LANDED.add(path)
    return path
