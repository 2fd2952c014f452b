"""Silver / Gold queries: dedup, derived columns, daily roll-up, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.functions.weather import condition_label, feels_like
from meteora.operators.gold import city_ranking, latest_per_city
from meteora.plans import inputs as I
from meteora.plans import sql_fragments as Q
from meteora.plans.catalog import register
from meteora.schemas import DAILY_COLUMNS, RANKING_COLUMNS, SILVER_COLUMNS

_SILVER_OUT = [c for c in SILVER_COLUMNS if c != "ingested_at"]


@register("silver_clean", Q.with_(Q.OBS_B, Q.silver("obs_b", "silver_b"))
          + f"SELECT {', '.join(_SILVER_OUT)} FROM silver_b")
def silver_clean(spark, root):
    """Adapter B: many readings per (station, day) collapse to one."""
    return I.silver_b(spark, root).select(*_SILVER_OUT)


@register("feels_like", Q.with_(Q.OBS_A, Q.dedup("obs_a", "d"))
          + f"SELECT city, time, temperature_c, wind_speed_kmh, {Q.FEELS} AS feels_like_c FROM d")
def feels_like_q(spark, root):
    """Adapter A: wind 0..99 covers the no-wind case."""
    from meteora.operators.silver import dedup_observations
    d = dedup_observations(I.obs_a(spark, root), I.QCFG)
    return d.select("city", "time", "temperature_c", "wind_speed_kmh",
                    feels_like("temperature_c", "wind_speed_kmh").alias("feels_like_c"))


@register("condition_label", Q.with_(Q.OBS_A)
          + f"SELECT weather_code, {Q.CONDITION_CASE} AS weather_description, count(*) AS readings "
            "FROM obs_a GROUP BY ALL")
def condition_label_q(spark, root):
    """Every code 0-99 occurs in adapter A: each label and each gap."""
    return (I.obs_a(spark, root)
            .groupBy("weather_code", condition_label("weather_code").alias("weather_description"))
            .agg(F.count(F.lit(1)).alias("readings")))


@register("bronze_batch", Q.with_(Q.OBS_A_HOUR, Q.dedup("obs_ah", "d"))
          + "SELECT * FROM d")
def bronze_batch(spark, root):
    """Hour-grain batch of adapter A, de-duplicated on (city, time)."""
    from meteora.operators.silver import dedup_observations
    d = dedup_observations(I.obs_a(spark, root, hour_grain=True), I.QCFG)
    return d.drop("ingested_at", "ingest_seq")


@register("gold_daily", Q.with_(Q.OBS_B, Q.silver("obs_b", "s"), Q.daily("s", "g"))
          + "SELECT * FROM g")
def gold_daily_q(spark, root):
    return I.daily_b(spark, root).select(*DAILY_COLUMNS)


@register("latest_per_city", Q.with_(Q.OBS_A, Q.silver("obs_a", "s"), Q.latest("s", "l"))
          + f"SELECT {', '.join(_SILVER_OUT)} FROM l")
def latest_per_city_q(spark, root):
    return latest_per_city(I.silver_a(spark, root)).select(*_SILVER_OUT)


@register("city_ranking", Q.with_(Q.OBS_A, Q.silver("obs_a", "s"), Q.ranking("s", "r"))
          + "SELECT * FROM r")
def city_ranking_q(spark, root):
    return city_ranking(I.silver_a(spark, root)).select(*RANKING_COLUMNS)
