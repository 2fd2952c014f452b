"""Silver → Gold daily roll-up and latest reading per station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.functions.numerics import round_half_up as rh
from meteora.operators.dedup import latest_by
from meteora.schemas import DAILY_COLUMNS


def day_of(col: str = "time"):
    """Midnight of the wall-clock day, as TIMESTAMP_NTZ (zone independent)."""
    return F.col(col).cast("date").cast("timestamp_ntz")


#: (statistic, Silver column, daily column); fixed names.
DAILY_STATS = [
    ("avg", "temperature_c", "avg_temp_c"),
    ("min", "temperature_c", "min_temp_c"),
    ("max", "temperature_c", "max_temp_c"),
    ("avg", "feels_like_c", "avg_feels_like_c"),
    ("avg", "humidity_pct", "avg_humidity_pct"),
    ("avg", "wind_speed_kmh", "avg_wind_speed_kmh"),
    ("sum", "precipitation_mm", "total_precipitation_mm"),
]


def daily_stats() -> list:
    """The daily aggregates, rounded to 1 dp; batch and stream share them."""
    return [rh(getattr(F, stat)(column), 1).alias(out) for stat, column, out in DAILY_STATS]


def gold_daily(silver: DataFrame) -> DataFrame:
    """(city, country, day) roll-up, each statistic rounded to 1 dp.
    Partial + final hash aggregation; the shuffle carries one row per
    (key, map task)."""
    return (
        silver.groupBy("city", "country", day_of("time").alias("date"))
        .agg(*daily_stats())
        .select(*DAILY_COLUMNS)
    )


def latest_per_city(silver: DataFrame) -> DataFrame:
    """Latest reading per city (time desc; NULL time loses)."""
    order = ["time", "country", "temperature_c", "feels_like_c", "humidity_pct",
             "wind_speed_kmh", "precipitation_mm", "weather_description", "ingested_at"]
    return latest_by(silver, ["city"], order)


def city_ranking(silver: DataFrame) -> DataFrame:
    """Latest reading per city, ranked by temperature (desc, gaps on ties).
    No sort before the write: readers order by temp_rank."""
    from meteora.operators.ranking import global_rank
    from meteora.schemas import RANKING_COLUMNS

    latest = latest_per_city(silver)
    return global_rank(latest, "temperature_c", "temp_rank").select(*RANKING_COLUMNS)
