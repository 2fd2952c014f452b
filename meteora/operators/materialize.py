"""Lineage cuts for small frames reused many times (e.g. the one-row-per-
station features of a k sweep). ``checkpoint`` writes to the folder named
by ``spark.checkpoint.dir`` (shared storage on a cluster), so a lost
executor re-reads the files instead of recomputing the upstream plan."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from meteora.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint computed once: the frame is persisted for the
    duration of the checkpoint (Spark counts it, then writes the files in a
    second job that would otherwise recompute the whole plan)."""
    checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
