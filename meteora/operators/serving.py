"""Serving queries over the Gold tables: parameterised Spark SQL (named
parameter markers, never string interpolation of caller values) plus the
dashboard feeds (KPI tiles, axis range, map / mix / drill-down)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def serve_ranking(spark: SparkSession, ranking: DataFrame) -> DataFrame:
    return spark.sql(
        """SELECT temp_rank, city, country, temperature_c, feels_like_c, humidity_pct,
                  wind_speed_kmh, weather_description
           FROM {ranking} ORDER BY temp_rank""", ranking=ranking)


def serve_anomalies(spark: SparkSession, anomalies: DataFrame) -> DataFrame:
    return spark.sql(
        """SELECT city, country, anomaly_type, severity, today_temp_c, normal_temp_c, zscore_temp
           FROM {anomalies} ORDER BY abs(zscore_temp) DESC""", anomalies=anomalies)


def serve_forecast(spark: SparkSession, forecast: DataFrame, city: str) -> DataFrame:
    """One city's forecast; ``city`` is bound as a parameter, so a quote in
    it matches nothing instead of breaking the statement."""
    return spark.sql(
        """SELECT forecast_date, predicted_temp_c, predicted_low_c, predicted_high_c
           FROM {forecast} WHERE city = :city ORDER BY forecast_date""",
        args={"city": city}, forecast=forecast)


def serve_clusters(spark: SparkSession, clusters: DataFrame) -> DataFrame:
    return spark.sql(
        """SELECT city, country, climate_cluster, mean_temp_c, mean_humidity
           FROM {clusters} ORDER BY climate_cluster, mean_temp_c DESC""", clusters=clusters)


def _rh_sql(expr: str, d: int) -> str:
    """SQL text of ``round_half_up`` (fixed-scale half-up rounding)."""
    return (f"coalesce(CAST(round(try_cast(({expr}) AS DECIMAL(38,12)), {d}) AS DOUBLE), "
            f"round(({expr}), {d}))")


def cluster_summary(spark: SparkSession, clusters: DataFrame) -> DataFrame:
    """Per-label size and rounded averages, as SQL text over the table."""
    return spark.sql(
        f"""SELECT climate_cluster, count(*) AS city_count,
                   {_rh_sql('avg(mean_temp_c)', 1)} AS avg_temp,
                   {_rh_sql('avg(mean_humidity)', 1)} AS avg_humidity,
                   {_rh_sql('avg(mean_precip_mm)', 1)} AS avg_precip
            FROM {{clusters}}
            GROUP BY climate_cluster
            ORDER BY avg_temp DESC""", clusters=clusters)


def city_list(latest: DataFrame) -> DataFrame:
    return latest.select("city").distinct().orderBy("city")


def kpi_tiles(latest: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Hottest and coldest station (the first and last by rank: a missing
    temperature counts as coldest, city names break ties as the rank's order
    does), anomaly count, city count — one row. Needs the latest readings
    only, no rank."""
    t = F.col("temperature_c")
    coldness = F.struct(t.isNull().alias("missing"), F.when(F.isnan(t), float("-inf")).otherwise(-t).alias("cold"), F.col("city"))
    tiles = latest.agg(
        F.min_by("city", coldness).alias("hottest_city"),
        F.min_by("temperature_c", coldness).alias("hottest_temp_c"),
        F.max_by("city", coldness).alias("coldest_city"),
        F.max_by("temperature_c", coldness).alias("coldest_temp_c"),
        F.count(F.lit(1)).alias("cities_tracked"),
    )
    n_anom = anomalies.select(F.count(F.lit(1))).scalar()
    return tiles.withColumn("anomalies_today", n_anom)


def forecast_axis_range(forecast: DataFrame, city: str | None = None) -> DataFrame:
    """Chart y-range: min(low) − 2 and max(high) + 2, per city."""
    f = forecast if city is None else forecast.filter(F.col("city") == F.lit(city))
    return f.groupBy("city").agg(
        (F.min("predicted_low_c") - F.lit(2)).alias("y_min"),
        (F.max("predicted_high_c") + F.lit(2)).alias("y_max"),
    )


def country_map(latest: DataFrame) -> DataFrame:
    """Map feed: mean current temperature and city count per country."""
    from meteora.functions.numerics import round_half_up as rh
    return latest.groupBy("country").agg(
        rh(F.avg("temperature_c"), 1).alias("mean_temp_c"),
        F.count(F.lit(1)).alias("cities"),
    )


def condition_mix(latest: DataFrame) -> DataFrame:
    """Bar / pie feed: cities per current condition."""
    return latest.groupBy("weather_description").agg(F.count(F.lit(1)).alias("cities"))


def drilldown(spark: SparkSession, ranking: DataFrame, country: str | None = None,
              city: str | None = None, condition: str | None = None) -> DataFrame:
    """Optional AND-ed filters; a NULL parameter means 'all'."""
    return spark.sql(
        """SELECT temp_rank, city, country, temperature_c, weather_description
           FROM {ranking}
           WHERE (:country IS NULL OR country = :country)
             AND (:city IS NULL OR city = :city)
             AND (:condition IS NULL OR weather_description = :condition)""",
        args={"country": country, "city": city, "condition": condition}, ranking=ranking)
