"""Sinks: catalog tables, published tables, partition upserts, CSV export.
Formats are parquet: no table-format package is assumed.

``publish`` replaces a table without a moment in which it is gone: the new
rows are written beside the old ones and a view of the table's name is turned
to them, so a failed write leaves the old table, and the schema may change.

``overwrite_partitions`` replaces those partitions that the new rows lie in.
State tables have two levels of partitions, a period and a hash bucket of
the station, so a day with a third of all rows is written by as many tasks as
there are buckets. The count of buckets is a property of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GENERATION = "__g"
BUCKETS_KEY = "meteora.buckets"


def write_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by=None,
                fmt: str = "parquet") -> None:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def _generations(spark: SparkSession, name: str) -> list[int]:
    db, _, short = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES {f'IN {db} ' if db else ''}LIKE '{short}{GENERATION}*'").collect()
    found = (r["tableName"].rpartition(GENERATION)[2] for r in rows)
    return sorted(int(x) for x in found if x.isdigit())


def publish(df: DataFrame, name: str, partition_by=None) -> None:
    """Make ``df`` the content of the table ``name``. The content before it
    is kept, for readers under way; older ones go."""
    spark = df.sparkSession
    known = _generations(spark, name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{GENERATION}0")
        spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {name}{GENERATION}0")
        known = [0]
    new = known[-1] + 1 if known else 1
    table = f"{name}{GENERATION}{new}"
    try:
        write_table(df, table, partition_by=partition_by)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    for old in known[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {name}{GENERATION}{old}")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, table: str, default: int) -> int:
    """The count of buckets that ``table`` was made with."""
    if not spark.catalog.tableExists(table):
        return default
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return int({r["key"]: r["value"] for r in rows}.get(BUCKETS_KEY, default))


def overwrite_partitions(df: DataFrame, table: str, parts: Sequence[str], buckets: int | None = None,
                         gather: bool = True) -> None:
    """Replace the partitions of ``table`` that ``df`` has rows of. With
    ``gather``, rows of one partition meet in one task and make one file."""
    spark = df.sparkSession
    laid = df.repartition(*parts) if gather else df
    if not spark.catalog.tableExists(table):
        laid.write.format("parquet").partitionBy(*parts).saveAsTable(table)
        if buckets:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BUCKETS_KEY}' = '{buckets}')")
        return
    key = "spark.sql.sources.partitionOverwriteMode"  # insertInto reads no write option for it
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        laid.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, before)


#: Periods listed in a scan's partition filter; a batch that touches more is
#: joined without it.
LISTED = 10_000


def touched_rows(table: DataFrame, touched: DataFrame, period: str) -> DataFrame:
    """The rows of ``table`` in the partitions (``period``, bucket) that
    ``touched`` lists; periods reach the scan as a partition filter."""
    rows = touched.select(period).distinct().limit(LISTED + 1).collect()
    if len(rows) <= LISTED:
        days = [r[0] for r in rows if r[0] is not None]
        none = F.col(period).isNull() if len(days) < len(rows) else F.lit(False)
        table = table.filter(F.col(period).isin(days) | none)
    keys = touched.select(F.col(period).alias("_period"), F.col("bucket").alias("_bucket")).distinct()
    return table.join(keys, table[period].eqNullSafe(keys["_period"]) & (table["bucket"] == keys["_bucket"]),
                      "left_semi")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, written by the executors (no driver collect)."""
    df.write.mode("overwrite").option("header", True).csv(path)
