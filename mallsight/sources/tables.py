"""Reading the driver's parquet tables with an explicit column list.

Selecting the columns right at the scan keeps ``ReadSchema`` narrow; filters
written later on these columns are pushed into the parquet reader by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
