"""SparkSession helpers.

Cluster deployments bring their own session; ``get_session`` is for local
runs and tests. ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session and only sets a directory when the cluster has not named one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "meteora") -> SparkSession:
    master = master or os.environ.get("METEORA_MASTER", "local[8]")
    cores = _cores(master)
    parts = shuffle_partitions or max(8, 2 * cores)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("METEORA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "64")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cores(master: str) -> int:
    if master.startswith("local[") and master.endswith("]"):
        inner = master[6:-1]
        if inner.isdigit():
            return int(inner)
        return os.cpu_count() or 8
    return os.cpu_count() or 8


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; a scratch folder only for a local session
    that has none (tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="meteora-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scale_conf(input_bytes: int, total_cores: int, shuffle_ratio: float = 0.3,
               target_partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Session settings sized for a run over ``input_bytes`` of parquet on
    ``total_cores`` executor cores.

    * scan splits of 256 MB (compressed) keep a task's decoded batch well
      inside executor memory;
    * the initial shuffle partition count covers the expected shuffle volume
      (``shuffle_ratio`` of the input after pruning and partial aggregation)
      at ~256 MB per partition, never fewer than 3 waves of cores; AQE then
      coalesces small partitions and splits skewed ones.
    """
    shuffle_bytes = int(input_bytes * shuffle_ratio)
    parts = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_conf(spark: SparkSession, conf: dict) -> None:
    """Set runtime SQL settings (static ones belong in spark-submit)."""
    for k, v in conf.items():
        spark.conf.set(k, v)
