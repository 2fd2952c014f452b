"""Daily roll-up that takes corrections after a day is closed, with every row
accounted for.

A stream of Bronze rows is merged into Silver partitions (day, bucket) by the
batch rule. A row that loses to another version of its reading, be it new or
stored, goes to the side table as ``superseded``; rows without a readable
time go there as ``no_time``. So the rows delivered are the rows of Silver
plus the rows of the side table. Daily rows of the touched partitions are
computed again, however late a reading comes, and the change log gets the
withdrawn row (``-``) and the new one (``+``), marked ``late`` when the day
lies more than ``delay_days`` before the newest day known until then.

A micro-batch that is run again after a failure leaves the same tables: side
rows and changes are written first, under the number of the micro-batch, and
are kept if they are there; Silver rows bear the number of the micro-batch
that brought them, and partitions that have some of it are done.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.weather import condition_label, feels_like
from meteora.operators.gold import gold_daily
from meteora.operators.materialize import materialize
from meteora.operators.silver import DEDUP_ORDER, parse_time
from meteora.schemas import DAILY_COLUMNS
from meteora.session import checkpoint_dir
from meteora.sinks import bucket_of, buckets_of, overwrite_partitions, touched_rows
from meteora.streaming.incremental import bronze_file_stream

SILVER, DAILY, SIDE, CHANGES = "corrected_silver", "corrected_daily", "corrected_side", "corrected_changes"
MEASURES = ["temperature_c", "humidity_pct", "wind_speed_kmh", "precipitation_mm", "weather_code"]
_ROW = ["city", "country", "time", *MEASURES, "ingested_at", "ingest_seq", "batch"]


def _write_once(df: DataFrame, table: str, epoch: int) -> None:
    """Write ``df`` under ``epoch`` unless the table has rows of it."""
    spark = df.sparkSession
    done = spark.catalog.tableExists(table) and spark.table(table).filter(F.col("epoch") == epoch).limit(1).count()
    if not done:
        overwrite_partitions(df.withColumn("epoch", F.lit(epoch).cast("long")), table, ["epoch"], gather=False)


def correct_batch(spark: SparkSession, batch: DataFrame, epoch: int, db: str = "", cfg: PipelineConfig | None = None,
                  delay_days: int = 2) -> None:
    """Merge one micro-batch of Bronze rows; see the module's text."""
    cfg = cfg or PipelineConfig()
    silver_t, daily_t, side_t, changes_t = (f"{db}.{t}" if db else t for t in (SILVER, DAILY, SIDE, CHANGES))
    n = buckets_of(spark, silver_t, cfg.state_buckets)
    if "ingest_seq" not in batch.columns:
        batch = batch.withColumn("ingest_seq", F.lit(None).cast("bigint"))
    raw = materialize(batch.select("city", "country", parse_time(batch, cfg).alias("time"), *MEASURES, "ingested_at",
                                   "ingest_seq", F.lit(epoch).cast("long").alias("batch")))
    new = (raw.filter("time IS NOT NULL").withColumn("day", F.col("time").cast("date"))
           .withColumn("bucket", bucket_of("city", n)))
    touched = materialize(new.select("day", "bucket").distinct())
    known = spark.catalog.tableExists(silver_t)
    every = new
    if known:
        old = touched_rows(spark.table(silver_t), touched, "day")
        applied = old.filter(F.col("batch") == epoch).select("day", "bucket").distinct()
        every = (old.select(*_ROW, "day", "bucket").unionByName(new)
                 .join(applied, ["day", "bucket"], "left_anti"))
    order = [F.col(c).desc_nulls_last() for c in DEDUP_ORDER] + [F.col("batch")]
    ranked = materialize(every.withColumn("_nth", F.row_number().over(Window.partitionBy("city", "time").orderBy(*order))))
    side = (raw.filter("time IS NULL").withColumn("reason", F.lit("no_time"))
            .unionByName(ranked.filter("_nth > 1").select(*_ROW).withColumn("reason", F.lit("superseded"))))
    _write_once(side, side_t, epoch)
    merged = ranked.filter("_nth = 1").withColumn("feels_like_c", feels_like("temperature_c", "wind_speed_kmh")) \
        .withColumn("weather_description", condition_label("weather_code")).drop("_nth")
    overwrite_partitions(merged, silver_t, ["day", "bucket"], n)

    daily = materialize(gold_daily(touched_rows(spark.table(silver_t), touched, "day").drop("day", "bucket"))
                        .withColumn("day", F.col("date").cast("date")).withColumn("bucket", bucket_of("city", n)))
    empty = daily.limit(0)
    before = touched_rows(spark.table(daily_t), touched, "day").select(*daily.columns) if known else empty
    newest = spark.table(daily_t).agg(F.max("day")).first()[0] if known else None
    late = F.lit(False) if newest is None else F.date_add("day", delay_days) < F.lit(newest)
    keys = ["city", "country", "date"]
    pair = before.alias("o").join(daily.alias("n"), keys, "full_outer")
    gone = pair.filter(F.col("o.day").isNotNull() & ~_unchanged()).select("o.*").withColumn("op", F.lit("-"))
    come = pair.filter(F.col("n.day").isNotNull() & ~_unchanged()).select("n.*").withColumn("op", F.lit("+"))
    _write_once(materialize(gone.unionByName(come).withColumn("late", late).select("op", "late", *DAILY_COLUMNS)),
                changes_t, epoch)
    overwrite_partitions(daily, daily_t, ["day", "bucket"], n)


def _unchanged():
    values = [c for c in DAILY_COLUMNS if c not in ("city", "country", "date")]
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    return F.col("o.day").isNotNull() & F.col("n.day").isNotNull() & same


def start_corrected_daily(spark: SparkSession, bronze_path: str, db: str = "", cfg: PipelineConfig | None = None,
                          available_now: bool = True, name: str = "meteora_corrected", delay_days: int = 2,
                          max_files_per_trigger: int | None = None):
    """The stream over Bronze files; tables ``corrected_*`` in ``db``."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 hour"}
    stream = bronze_file_stream(spark, bronze_path, max_files_per_trigger=max_files_per_trigger)
    return (stream.writeStream
            .foreachBatch(lambda df, epoch: correct_batch(df.sparkSession, df, epoch, db, cfg, delay_days))
            .option("checkpointLocation", os.path.join(checkpoint_dir(spark), name)).trigger(**trigger).start())
