"""Mergeable history states for z-score baselines.

A state holds, for a station and a month, how many daily rows there are and,
for each measure, the count, sum and sum of squares of its values in tenths.
Daily values are rounded to one decimal, so these are whole numbers: states
merge and subtract exactly, in any order. Values that are not finite (or over
``MOST``) are added up apart and make the mean what they add up to and the
deviation NaN. The latest day of the month goes along; it merges but doesn't
subtract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (short name, daily column): the measures with a baseline.
MEASURES = [("temp", "avg_temp_c"), ("wind", "avg_wind_speed_kmh"), ("precip", "total_precipitation_mm")]
MOST = 1e12
_PARTS = [f"{p}_{m}" for m, _ in MEASURES for p in ("n", "s", "q")]
_ODD = [f"odd_{m}" for m, _ in MEASURES]
LATEST = ["_d", "_t", "_w", "_p"]


def month_of(day: str = "day"):
    return F.trunc(day, "MM")


def history_states(daily: DataFrame, keys: list[str]) -> DataFrame:
    """States of the groups of ``keys`` (city and country among them)."""
    aggs = [F.count(F.lit(1)).alias("history_days")]
    for m, column in MEASURES:
        fine = F.abs(column) < MOST
        tenths = F.when(fine, F.round(F.col(column) * 10)).cast("long")
        wide = tenths.cast("decimal(19,0)")
        aggs += [F.count(tenths).alias(f"n_{m}"), F.sum(wide).cast("decimal(38,0)").alias(f"s_{m}"),
                 F.sum(wide * wide).cast("decimal(38,0)").alias(f"q_{m}"),
                 F.sum(F.when(~fine, F.col(column))).alias(f"odd_{m}")]
    # a NULL day loses to any real one
    day = F.coalesce(F.col("date"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    latest = [F.max("date").alias("_d")] + [
        F.max_by(c, day).alias(f"_{x}") for x, (_, c) in zip("twp", MEASURES, strict=True)]
    return daily.groupBy(*keys).agg(*aggs, *latest)


def merge_states(states: DataFrame, keys: tuple = ("city", "country")) -> DataFrame:
    """One state for each of ``keys``."""
    day = F.coalesce(F.col("_d"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    return states.groupBy(*keys).agg(
        F.sum("history_days").alias("history_days"),
        *[F.sum(c).alias(c) for c in _PARTS + _ODD], F.max("_d").alias("_d"),
        *[F.max_by(c, day).alias(c) for c in LATEST[1:]])


def subtract_states(whole: DataFrame, part: DataFrame, keys: tuple = ("city", "country")) -> DataFrame:
    """The states of what is in ``whole`` and not in ``part``, without the
    latest day; groups that nothing is left of go."""
    cols = ["history_days", *_PARTS]
    less = part.select(*keys, *[(-F.col(c)).alias(c) for c in cols])
    both = whole.select(*keys, *cols).unionByName(less)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols]).filter("history_days > 0")


def statistics(states: DataFrame) -> DataFrame:
    """hist_mean_* and hist_std_* (sample) of each state."""
    for m, _ in MEASURES:
        n = F.col(f"n_{m}").cast("decimal(19,0)")
        s, q = (F.col(f"{x}_{m}").cast("decimal(19,0)") for x in "sq")
        spread = (n * q - s * s).cast("double")
        mean = F.try_divide(s.cast("double"), F.col(f"n_{m}") * 10.0)
        std = F.sqrt(F.try_divide(spread, n.cast("double") * (n.cast("double") - 1))) / 10.0
        if f"odd_{m}" in states.columns:
            odd = F.col(f"odd_{m}")
            mean, std = (F.when(odd.isNotNull(), x).otherwise(y)
                         for x, y in ((odd, mean), (F.lit(float("nan")), std)))
        states = states.withColumn(f"hist_mean_{m}", mean).withColumn(f"hist_std_{m}", std)
    return states
