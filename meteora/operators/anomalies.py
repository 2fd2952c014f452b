"""Z-score anomalies of each station's latest day against its history.

baseline (per city, country)  ─┐
                               ├─ inner join on city ─> z-scores ─> flags ─> anomalies
snapshot (latest day per city) ┘

``baseline`` and ``today_snapshot`` are the two inputs as published;
``zscores`` computes their join in one aggregation plus a station-sized
window (see its docstring), so the daily table is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.numerics import round_half_up as rh
from meteora.functions.numerics import stamp
from meteora.functions.weather import anomaly_type, severity, zscore
from meteora.operators.baselines import MEASURES, merge_states, statistics
from meteora.operators.dedup import latest_by
from meteora.schemas import ANOMALY_COLUMNS


def history_stats() -> list:
    """Mean and sample deviation of each measure's (already rounded) daily
    values, and how many days there are."""
    of = lambda name, f: [f(column).alias(f"hist_{name}_{m}") for m, column in MEASURES]
    return [*of("mean", F.avg), *of("std", F.stddev_samp), F.count(F.lit(1)).alias("history_days")]


_STATS = [f"hist_{x}_{m}" for m, _ in MEASURES for x in ("mean", "std")]


def baseline(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """History of each (city, country); the latest day is part of its own
    baseline. HAVING history_days >= floor."""
    per = daily.groupBy("city", "country").agg(*history_stats())
    return (per.filter(F.col("history_days") >= cfg.min_history_days)
            .select("city", "country", *_STATS, "history_days"))


def today_snapshot(daily: DataFrame) -> DataFrame:
    """Latest day per city (partitioned by city only, as published)."""
    slim = daily.select(
        "city", "date", "country",
        F.col("avg_temp_c").alias("today_temp"),
        F.col("avg_wind_speed_kmh").alias("today_wind"),
        F.col("total_precipitation_mm").alias("today_precip"),
    )
    return latest_by(slim, ["city"], ["date", "country", "today_temp", "today_wind", "today_precip"]) \
        .select("city", "date", "today_temp", "today_wind", "today_precip")


def zscores(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Snapshot ⨝ baseline USING (city) — country from the baseline, σ = 0
    or NULL gives a NULL z (ANSI-safe) — computed without a join.

    One hash aggregation per (city, country) yields the baseline statistics
    and that pair's latest day (``max_by`` over the date, fixed-width
    buffers: partial aggregation before the shuffle). A window over the
    station-sized result then gives every (city, country) row its city's
    snapshot, i.e. the latest day across the city's countries, which is
    exactly what the join of a per-city snapshot with per-(city, country)
    baselines produces. The daily table is read once.
    """
    # A NULL day (unparsable times) loses to any real day but is still a
    # snapshot when it is the only one, as in row_number ordering.
    day = F.coalesce(F.col("date"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    return zscores_of(daily.groupBy("city", "country").agg(
        *history_stats(), F.max("date").alias("_d"),
        *[F.max_by(c, day).alias(f"_{x}") for x, (_, c) in zip("twp", MEASURES, strict=True)]), cfg)


def zscores_of(per: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Z-scores from one row per (city, country): its history and latest day
    (``_d``, ``_t``, ``_w``, ``_p``)."""
    latest_first = Window.partitionBy("city").orderBy(
        *[F.col(c).desc_nulls_last() for c in ("_d", "country", "_t", "_w", "_p")]
    ).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    j = (per.withColumn("date", F.first("_d").over(latest_first))
         .withColumn("today_temp", F.first("_t").over(latest_first))
         .withColumn("today_wind", F.first("_w").over(latest_first))
         .withColumn("today_precip", F.first("_p").over(latest_first))
         .filter(F.col("history_days") >= cfg.min_history_days))
    return j.select(
        "city", "country", "date", "today_temp", "today_wind", "today_precip",
        "hist_mean_temp", "hist_std_temp", "hist_mean_wind", "hist_std_wind",
        "hist_mean_precip", "hist_std_precip", "history_days",
        zscore("today_temp", "hist_mean_temp", "hist_std_temp").alias("zscore_temp"),
        zscore("today_wind", "hist_mean_wind", "hist_std_wind").alias("zscore_wind"),
        zscore("today_precip", "hist_mean_precip", "hist_std_precip").alias("zscore_precip"),
    )


def anomaly_flags(z: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Three-valued flags: NULL z gives a NULL flag; OR keeps NULL OR TRUE."""
    t = cfg.zscore_threshold
    return (
        z.withColumn("temp_anomaly", F.abs("zscore_temp") > t)
        .withColumn("wind_anomaly", F.abs("zscore_wind") > t)
        .withColumn("precip_anomaly", F.abs("zscore_precip") > t)
        .withColumn("is_anomaly", F.col("temp_anomaly") | F.col("wind_anomaly") | F.col("precip_anomaly"))
    )


def anomalies(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Gold anomalies table. No sort before the write (readers order)."""
    return anomalies_of(zscores(daily, cfg), cfg)


def anomalies_from_states(states: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The same from stored history states: no daily row is read."""
    return anomalies_of(zscores_of(statistics(merge_states(states)), cfg), cfg)


def anomalies_of(z: DataFrame, cfg: PipelineConfig) -> DataFrame:
    f = anomaly_flags(z, cfg)
    return (
        f.filter(F.col("is_anomaly"))
        .select(
            "city", "country", "date",
            rh("today_temp", 1).alias("today_temp_c"),
            rh("hist_mean_temp", 1).alias("normal_temp_c"),
            rh("zscore_temp", 2).alias("zscore_temp"),
            rh("today_wind", 1).alias("today_wind_kmh"),
            rh("zscore_wind", 2).alias("zscore_wind"),
            rh("today_precip", 1).alias("today_precip_mm"),
            rh("zscore_precip", 2).alias("zscore_precip"),
            anomaly_type("zscore_temp", "zscore_wind", "zscore_precip", cfg.zscore_threshold).alias("anomaly_type"),
            severity("zscore_temp", "zscore_wind", "zscore_precip",
                     cfg.severity_extreme, cfg.severity_high).alias("severity"),
            stamp(cfg.now).alias("detected_at"),
        )
        .select(*ANOMALY_COLUMNS)
    )
