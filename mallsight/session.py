"""Session helpers.

The library never creates a session behind the caller's back inside an
operator; these helpers are for scripts, tests and the bench.  The one
piece of session state the library reads is ``spark.checkpoint.dir``,
the shared folder used for landed documents and lineage cuts.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings that matter for every job in this package.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # cp932 CSV exports need the legacy charset list (see sources.csv_export)
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "mallsight", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when unset.

    On a cluster the operator of the cluster names a shared folder in
    ``spark.checkpoint.dir``; we use it as is.  A session without one gets a
    fresh scratch folder only when its master is ``local[...]`` (driver and tasks
    share one disk); on a cluster it is an error, because every executor would
    write to its own disk.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="mallsight-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for landed data)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def unique_dir(spark: SparkSession, prefix: str) -> str:
    return shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Session settings sized for a cluster run over ``input_bytes`` of parquet.

    * scans split at 512 MB (fewer, longer tasks; parquet row groups stay whole)
    * shuffles start with enough partitions for ~``target_partition_bytes`` of
      the largest expected exchange (the line-grain shuffle of a join), never
      fewer than 2 waves of cores; AQE coalesces the small order/day-grain ones
    * AQE skew handling splits oversized join partitions; runtime broadcast only
      below 64 MB of measured size.
    """
    initial = max(2 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    }
