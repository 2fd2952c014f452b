"""Run log as a table: (run_id, parent_run, kind, name, value) rows, built
from DataFrames with ``unpivot`` and appended by the job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUNLOG_SCHEMA = "run_id string, parent_run string, kind string, name string, value string"


def cluster_size_metrics(clusters: DataFrame) -> DataFrame:
    """cluster_size_<label with spaces as underscores>; NULL label is
    reported as 'Unlabelled' instead of failing."""
    return clusters.groupBy("climate_cluster").agg(F.count(F.lit(1)).alias("value")).select(
        "climate_cluster",
        F.concat(F.lit("cluster_size_"),
                 F.replace(F.coalesce(F.col("climate_cluster"), F.lit("Unlabelled")), F.lit(" "), F.lit("_"))
                 ).alias("metric"),
        "value",
    )


def metrics_long(wide: DataFrame, run_id_col: str, parent: str | None, kind: str) -> DataFrame:
    """One row per (run, metric) from a wide frame of numeric columns."""
    vals = [c for c in wide.columns if c != run_id_col]
    casted = wide.select(F.col(run_id_col).cast("string").alias("run_id"),
                         *[F.col(c).cast("string").alias(c) for c in vals])
    long = casted.unpivot("run_id", vals, "name", "value")
    return long.select("run_id", F.lit(parent).cast("string").alias("parent_run"),
                       F.lit(kind).alias("kind"), "name", "value")


def forecast_run_log(run: str, cfg, daily: DataFrame, metrics: DataFrame) -> DataFrame:
    """The parent run's parameters and one child run per forecast station
    with its parameters (city, country, training rows) and metrics (last
    actual, first forecast, mean interval width)."""
    from meteora.operators.forecasting import series_extent
    extent = series_extent(daily).select(F.col("cities").alias("cities_count"))
    params = extent.select(
        F.lit(run).alias("run"), F.lit(cfg.forecast_days).alias("forecast_days"),
        F.lit(cfg.min_training_rows).alias("min_training_rows"),
        F.lit(cfg.changepoint_prior_scale).alias("changepoint_prior_scale"),
        F.lit(cfg.interval_width).alias("interval_width"), "cities_count")
    child = metrics.withColumn("run", F.concat(F.lit("forecast_"), F.col("city")))
    return (metrics_long(params, "run", None, "param")
            .unionByName(metrics_long(child.select("run", "city", "country", "training_rows"), "run", run, "param"))
            .unionByName(metrics_long(child.select("run", "last_actual_temp", "first_forecast_temp",
                                                   "avg_uncertainty_c"), "run", run, "metric")))
