"""Structured Streaming jobs replacing the hourly full rebuild.

Rows without a readable time and rows later than the watermark are not part
of the append-only streams; ``start_silver_upsert`` keeps both, and
``corrections`` counts every row.

D1 ``silver_stream``: file stream of Bronze rows → parse time → watermark on
    ``time`` → ``dropDuplicatesWithinWatermark(city, time)`` → Silver
    columns. State holds only keys inside the watermark delay. Unlike the
    batch rebuild (latest ingest wins), the stream keeps the first arrival
    of a key; use the batch job when corrections must replace values.
D2 ``daily_stream``: tumbling one-day windows per station over the Silver
    stream, appended once the watermark closes the day; rows later than the
    watermark are dropped.

Checkpoints live under ``spark.checkpoint.dir`` (shared storage).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.weather import condition_label, feels_like
from meteora.operators.dedup import latest_by
from meteora.operators.gold import daily_stats
from meteora.operators.materialize import materialize
from meteora.operators.silver import DEDUP_ORDER, parse_time, silver_state
from meteora.schemas import BRONZE, DAILY_COLUMNS, SILVER_COLUMNS
from meteora.session import checkpoint_dir
from meteora.sinks import bucket_of, buckets_of, overwrite_partitions, touched_rows


def _require_utc(spark: SparkSession) -> None:
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError("streaming jobs need spark.sql.session.timeZone=UTC (event time = wall time)")


def _event_time(col: str = "time"):
    """Watermarks need TIMESTAMP; in a UTC session the cast keeps the wall
    time, so day windows align with wall-clock days."""
    return F.col(col).cast("timestamp")


def bronze_file_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of Bronze rows. Without a schema, the schema of the files
    already present is used (``time`` may be text or a timestamp)."""
    if schema is None:
        try:
            schema = spark.read.format(fmt).load(path).schema
        except AnalysisException as e:
            if e.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                raise
            schema = BRONZE  # nothing has landed yet
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def silver_stream(bronze: DataFrame, cfg: PipelineConfig, watermark: str = "2 days") -> DataFrame:
    parsed = (bronze.withColumn("time", parse_time(bronze, cfg)).filter(F.col("time").isNotNull())
              .withColumn("_et", _event_time("time")))
    deduped = parsed.withWatermark("_et", watermark).dropDuplicatesWithinWatermark(["city", "time"])
    return deduped.select(
        "city", "country", "time", "temperature_c",
        feels_like("temperature_c", "wind_speed_kmh").alias("feels_like_c"),
        "humidity_pct", "wind_speed_kmh", "precipitation_mm",
        condition_label("weather_code").alias("weather_description"), "ingested_at",
    ).select(*SILVER_COLUMNS)


def daily_stream(silver: DataFrame, watermark: str = "2 days") -> DataFrame:
    w = silver.withColumn("_et", _event_time("time")).withWatermark("_et", watermark)
    agg = w.groupBy(F.window("_et", "1 day").alias("w"), "city", "country").agg(*daily_stats())
    return agg.withColumn("date", F.col("w.start").cast("timestamp_ntz")).select(*DAILY_COLUMNS)


def start_silver_and_daily(spark: SparkSession, bronze_path: str, silver_path: str, daily_path: str,
                           cfg: PipelineConfig | None = None, available_now: bool = True,
                           watermark: str = "2 days", name: str = "meteora"):
    """Start D1 and D2 as two queries writing parquet; returns both handles."""
    cfg = cfg or PipelineConfig()
    _require_utc(spark)
    ck = checkpoint_dir(spark)
    silver = silver_stream(bronze_file_stream(spark, bronze_path), cfg, watermark)
    trig = {"availableNow": True} if available_now else {"processingTime": "1 hour"}
    q1 = (silver.writeStream.format("parquet").option("path", silver_path)
          .option("checkpointLocation", os.path.join(ck, f"{name}_silver"))
          .outputMode("append").trigger(**trig).start())
    # The daily stream reads the Silver sink: it may start only once the
    # Silver query has committed what is available (its sink log exists).
    if available_now:
        q1.awaitTermination()
    else:
        q1.processAllAvailable()
    silver_in = spark.readStream.format("parquet").schema(silver.schema).load(silver_path)
    q2 = (daily_stream(silver_in, watermark).writeStream.format("parquet").option("path", daily_path)
          .option("checkpointLocation", os.path.join(ck, f"{name}_daily"))
          .outputMode("append").trigger(**trig).start())
    return q1, q2


# ---- latest-wins upsert (foreachBatch) --------------------------------------

def upsert_silver_batch(spark: SparkSession, batch: DataFrame, table: str,
                        cfg: PipelineConfig | None = None) -> DataFrame:
    """Merge one Bronze micro-batch into a Silver table partitioned by day and
    station bucket by the batch rebuild's rule (``DEDUP_ORDER``; rows without
    a time have the NULL day); returns the (day, bucket) pairs it touches.

    Only those partitions are read, merged with ``latest_by`` and rewritten
    (dynamic partition overwrite). The merged rows are checkpointed first, so
    the overwrite never reads the files it replaces."""
    cfg = cfg or PipelineConfig()
    n = buckets_of(spark, table, cfg.state_buckets)
    new = materialize(silver_state(batch, cfg).withColumn("day", F.col("time").cast("date"))
                      .withColumn("bucket", bucket_of("city", n)))
    touched = new.select("day", "bucket").distinct()
    if spark.catalog.tableExists(table):
        existing = touched_rows(spark.table(table), touched, "day")
        new = materialize(latest_by(existing.unionByName(new), ["city", "time"], DEDUP_ORDER))
    overwrite_partitions(new, table, ["day", "bucket"], n)
    return touched


def start_silver_upsert(spark: SparkSession, bronze_path: str, table: str,
                        cfg: PipelineConfig | None = None, available_now: bool = True,
                        name: str = "meteora_upsert"):
    """D1 with latest-wins semantics: file stream of Bronze → foreachBatch
    upsert into a Silver table partitioned by day and bucket."""
    cfg = cfg or PipelineConfig()
    ck = checkpoint_dir(spark)
    trig = {"availableNow": True} if available_now else {"processingTime": "1 hour"}
    return (bronze_file_stream(spark, bronze_path).writeStream
            .foreachBatch(lambda df, _epoch: upsert_silver_batch(spark, df, table, cfg))
            .option("checkpointLocation", os.path.join(ck, f"{name}_silver"))
            .trigger(**trig).start())
