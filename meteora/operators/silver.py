"""Bronze → Silver: parse time, de-duplicate (city, time), derive columns.

De-duplication runs before the derived columns so feels-like and the
condition text are computed once per surviving row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteora.config import PipelineConfig
from meteora.functions.weather import condition_label, feels_like
from meteora.operators.dedup import latest_by
from meteora.schemas import SILVER_COLUMNS

_ISO_MINUTE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$"
DEDUP_ORDER = ["ingested_at", "ingest_seq", "country", "temperature_c", "humidity_pct",
               "wind_speed_kmh", "precipitation_mm", "weather_code"]


def parse_time(df: DataFrame, cfg: PipelineConfig) -> Column:
    """Local wall time as TIMESTAMP_NTZ; unparsable text becomes NULL.

    Strings in the payload format are validated by pattern and cast, which
    is independent of the session time zone (no DST shifts). Other formats
    go through try_to_timestamp. Timestamp inputs pass through.
    """
    dtype = df.schema["time"].dataType
    t = F.col("time")
    if isinstance(dtype, T.TimestampNTZType):
        return t
    if isinstance(dtype, T.TimestampType):
        return t.cast("timestamp_ntz")
    if cfg.time_format == "yyyy-MM-dd'T'HH:mm":
        return F.when(t.rlike(_ISO_MINUTE), t.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(t, F.lit(cfg.time_format)).cast("timestamp_ntz")


def observed_between(time: Column, start: str, end: str) -> Column:
    """Inclusive day range [start, end] on the observation time, a plain
    range predicate so it reaches the scan as pushed filters."""
    lo = _dt.date.fromisoformat(start).isoformat()
    hi = (_dt.date.fromisoformat(end) + _dt.timedelta(days=1)).isoformat()
    # string → TIMESTAMP_NTZ casts do not depend on the session time zone
    return (time >= F.lit(lo).cast("timestamp_ntz")) & (time < F.lit(hi).cast("timestamp_ntz"))


def dedup_observations(bronze: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """One row per (city, parsed time): the latest ingest wins, then the
    landing sequence, then the measures (total order, reproducible)."""
    cfg = cfg or PipelineConfig()
    if "ingest_seq" not in bronze.columns:
        bronze = bronze.withColumn("ingest_seq", F.lit(None).cast("bigint"))
    slim = bronze.select(
        "city", "country", parse_time(bronze, cfg).alias("time"),
        "temperature_c", "humidity_pct", "wind_speed_kmh", "precipitation_mm",
        "weather_code", "ingested_at", "ingest_seq",
    )
    return latest_by(slim, ["city", "time"], DEDUP_ORDER)


#: What a mergeable Silver table keeps besides Silver's columns, so that a
#: later merge decides by the same order as the batch rule.
STATE_COLUMNS = SILVER_COLUMNS + ["weather_code", "ingest_seq"]


def silver_state(bronze: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """Silver rows with the columns that ``DEDUP_ORDER`` needs."""
    return dedup_observations(bronze, cfg).select(
        "city", "country", "time", "temperature_c",
        feels_like("temperature_c", "wind_speed_kmh").alias("feels_like_c"),
        "humidity_pct", "wind_speed_kmh", "precipitation_mm",
        condition_label("weather_code").alias("weather_description"),
        "ingested_at", "weather_code", "ingest_seq",
    ).select(*STATE_COLUMNS)


def to_silver(bronze: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    return silver_state(bronze, cfg).select(*SILVER_COLUMNS)
