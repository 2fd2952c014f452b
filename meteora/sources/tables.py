"""Table scans. Parquet paths or catalog names; projection and filters are
left to Catalyst so they reach the scan (ReadSchema / PushedFilters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root`` is a directory of ``<name>.parquet`` files, local or remote, or
    ``catalog:`` followed by a database name for managed tables."""
    if root.startswith("catalog:"):
        db = root.split(":", 1)[1]
        return spark.table(f"{db}.{name}" if db else name)
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
