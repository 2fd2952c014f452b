"""Shared pieces of the training-data operators.

Tables are read with Spark alone, so any store Spark knows will do.
``scratch`` writes an intermediate result as Parquet under the folder that
``spark.checkpoint.dir`` names (shared by driver and executors), so a lost
executor costs a re-read and not a re-run of the stages before. Operators
drop a scratch table as soon as its successor is written; what is left is
what their lazy result still reads, and ``drop_scratch`` removes that.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.session import checkpoint_dir

#: Fixed by contract: the six white-space characters that part words.
SPACE_CLASS = r"\x20\x09-\x0D"

#: Rows that a Python worker gets at once: texts can be long.
BATCH_ROWS = 1000
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

_LEFT: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the runs of other than white space; null and empty text: []."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", -1)
    return F.array_remove(parts, "")


def let(value: Column, use) -> Column:
    """``use(v)`` with ``value`` computed once per row: an expression that a
    lambda mentions would otherwise be computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scratch(df: DataFrame, what: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"
    _LEFT.append(path)
    before = spark.conf.get(_ROWS_KEY)
    spark.conf.set(_ROWS_KEY, str(min(int(before), BATCH_ROWS)))
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(_ROWS_KEY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*frames: DataFrame) -> None:
    """Remove the scratch tables behind ``frames``."""
    for df in frames:
        _remove(df.sparkSession, df._scratch_path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove every scratch table of this process; results built on them
    must have been written before."""
    for path in list(_LEFT):
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in _LEFT:
        _LEFT.remove(path)


#: Join partners that hold a larger share of the rows than one in HOT are
#: broadcast; there are fewer than HOT of them.
HOT = 1000


def join_spread(rows: DataFrame, found: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``found``, which has one row for each
    value of ``key`` (null too) and in ``count`` how many rows bear it. Both
    are scratch tables. Values that more than one row in ``HOT`` bears are
    joined by broadcast, so no task gets all rows of a hot value."""
    total = found.agg(F.sum(count)).first()[0] or 0
    other = found.withColumnRenamed(key, "_key")
    hot, cold = (other.where(w).drop(count) for w in (f"{count} * {HOT} > {total}", f"{count} * {HOT} <= {total}"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    return (rows.join(F.broadcast(hot), same).drop("_key")
            .unionByName(rows.join(F.broadcast(hot.select("_key")), same, "left_anti")
                         .join(cold.hint("shuffle_hash"), same).drop("_key")))


def release() -> None:
    """Give a Python worker's free memory back: workers live on, and several
    share an executor's memory."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, label), the
    label being the smallest node of the component.

    Each round gives a node the least label among itself and its neighbours
    and then the label of that label; both steps are joins with partial
    aggregation, so a hub is pre-aggregated in the map tasks. Labels go to a
    scratch table each round. Nodes without an edge are not returned.
    """
    both = scratch(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "edges")
    labels = scratch(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = scratch(labels.join(near, "node", "left")
                       .select("node", F.least("label", F.coalesce("near", "label")).alias("label"),
                               F.col("label").alias("was")), "labels")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = scratch(step.join(up, "label", "left")
                        .select("node", F.least("label", F.coalesce("up", "label")).alias("label"), "was"),
                        "labels")
        changed = after.where("label <> was").limit(1).count()
        drop(step, labels)
        labels = after
        if not changed:
            drop(both)
            out = after.select("node", "label")
            out._scratch_path = after._scratch_path
            return out
