"""Adapters from the driver's test tables to observation (Bronze) rows.

A: ``events`` — one station per user, one reading per event.
B: ``lineitem ⨝ orders ⨝ customer ⨝ nation ⨝ region`` — one station per
   nation, one reading per line item, many readings per (station, day).
The column mapping is fixed so the DuckDB oracle can rebuild it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.numerics import stamp
from meteora.sources.tables import load_table




def _bronze(city, country, time, temp, hum, wind, precip, code, seq, now) -> list:
    return [
        city.alias("city"), country.alias("country"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        F.lit("UTC").alias("timezone"),
        time.alias("time"),
        temp.cast("double").alias("temperature_c"),
        hum.cast("bigint").alias("humidity_pct"),
        wind.cast("double").alias("wind_speed_kmh"),
        precip.cast("double").alias("precipitation_mm"),
        code.cast("bigint").alias("weather_code"),
        stamp(now).alias("ingested_at"),
        seq.cast("bigint").alias("ingest_seq"),
    ]


def events_observations(events: DataFrame, cfg: PipelineConfig | None = None,
                        hour_grain: bool = False) -> DataFrame:
    """Adapter A. ``hour_grain`` truncates time to the hour (a second
    duplicate-key case: several events per user-hour)."""
    cfg = cfg or PipelineConfig()
    k = F.get_json_object("props", "$.k").cast("bigint")
    t = F.date_trunc("hour", "ts").cast("timestamp_ntz") if hour_grain else F.col("ts")
    return events.select(*_bronze(
        F.concat(F.lit("u"), F.col("user_id").cast("string")),
        F.concat(F.lit("g"), (F.col("user_id") % 5).cast("string")),
        t, F.col("value"), F.lit(100) - k, k, F.col("value") / 10, k,
        F.col("event_id"), cfg.now,
    ))


def station_dim(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Station dimension for adapter B: nation name as station, region name
    as country. Left join so a nation without a region keeps a NULL country."""
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(F.col("n_nationkey").alias("nationkey"),
                F.col("n_name").alias("city"), F.col("r_name").alias("country"))
    )


def lineitem_observations(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                          nation: DataFrame, region: DataFrame,
                          cfg: PipelineConfig | None = None) -> DataFrame:
    """Adapter B.

    Join order is chosen for scale: orders ⨝ customer first (orders-sized
    shuffle on custkey, carrying only two keys), then lineitem ⨝ that on
    orderkey, so the lineitem-sized side is shuffled once. The station
    dimension is broadcast only after its row bound is checked; the
    lineitem-to-orders join is pinned to sort-merge.
    """
    cfg = cfg or PipelineConfig()
    oc = (
        orders.select("o_orderkey", "o_custkey")
        .join(customer.select("c_custkey", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    # The station dimension is left to Spark's size-checked join selection
    # (statistics, then AQE on measured shuffle sizes): it is broadcast while
    # small and shuffled if it ever grows, with no extra counting job.
    dim = station_dim(nation, region)
    li = lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                         "l_discount", "l_tax", "l_shipdate")
    # Fact-to-orders is a big-big join: sort-merge (spills, never through the
    # driver), even where a small test file would pass the broadcast size
    # estimate. Smaller joins keep Spark's size-checked strategy choice.
    j = (li.join(oc.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(dim, F.col("c_nationkey") == F.col("nationkey")))
    return j.select(*_bronze(
        F.col("city"), F.col("country"), F.col("l_shipdate"),
        F.col("l_quantity"), F.col("l_discount") * 1000, F.col("l_tax") * 1000,
        F.col("l_extendedprice") / 1000, F.col("l_linenumber"),
        F.col("l_orderkey") * 100 + F.col("l_linenumber"), cfg.now,
    ))


def load_events_observations(spark: SparkSession, root: str, cfg=None, hour_grain=False):
    return events_observations(load_table(spark, root, "events"), cfg, hour_grain)


def load_lineitem_observations(spark: SparkSession, root: str, cfg=None):
    t = lambda n: load_table(spark, root, n)
    return lineitem_observations(t("lineitem"), t("orders"), t("customer"), t("nation"),
                                 t("region"), cfg)
