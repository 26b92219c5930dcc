"""Registry of named queries: Spark plan + DuckDB oracle SQL per operator ID.

Names follow ``<id>_<slug>`` from the survey's inventory.  Each builder takes
``(spark, sf_dir)`` and returns a lazy DataFrame over the whole driver tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def load_all():
    """Import the modules that register queries."""
    from . import queries_core, queries_reports, queries_sources, queries_more  # noqa: F401  (order matters)
    return QUERIES, ORACLE
