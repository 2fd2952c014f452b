"""Explicit schemas for every table the pipeline reads or writes."""

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
TS, NTZ = T.TimestampType(), T.TimestampNTZType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# One API document: scalars beside a struct of parallel hourly arrays.
HOURLY = T.StructType([
    _f("time", T.ArrayType(S)),
    _f("temperature_2m", T.ArrayType(D)),
    _f("relative_humidity_2m", T.ArrayType(D)),
    _f("wind_speed_10m", T.ArrayType(D)),
    _f("precipitation", T.ArrayType(D)),
    _f("weather_code", T.ArrayType(D)),
])
CORRUPT_COL = "_corrupt_record"
PAYLOAD = T.StructType([
    _f("latitude", D),
    _f("longitude", D),
    _f("timezone", S),
    _f("hourly", HOURLY),
    _f(CORRUPT_COL, S),
])
HOURLY_FIELDS = [f.name for f in HOURLY.fields]

# Landing directory rows: one payload document per fetch attempt.
LANDING = T.StructType([
    _f("city", S), _f("country", S), _f("doc_id", L), _f("attempt", I),
    _f("ingested_at", TS), _f("body", S),
])

# Bronze: one row per station-hour. ``ingest_seq`` is ours: a landing
# sequence that breaks ties between re-fetches with the same ingested_at.
BRONZE = T.StructType([
    _f("city", S), _f("country", S), _f("latitude", D), _f("longitude", D),
    _f("timezone", S), _f("time", S), _f("temperature_c", D), _f("humidity_pct", D),
    _f("wind_speed_kmh", D), _f("precipitation_mm", D), _f("weather_code", D),
    _f("ingested_at", TS), _f("ingest_seq", L),
])

SILVER_COLUMNS = [
    "city", "country", "time", "temperature_c", "feels_like_c", "humidity_pct",
    "wind_speed_kmh", "precipitation_mm", "weather_description", "ingested_at",
]
DAILY_COLUMNS = [
    "city", "country", "date", "avg_temp_c", "min_temp_c", "max_temp_c",
    "avg_feels_like_c", "avg_humidity_pct", "avg_wind_speed_kmh", "total_precipitation_mm",
]
RANKING_COLUMNS = [
    "temp_rank", "city", "country", "temperature_c", "feels_like_c", "humidity_pct",
    "wind_speed_kmh", "precipitation_mm", "weather_description", "time",
]
ANOMALY_COLUMNS = [
    "city", "country", "date", "today_temp_c", "normal_temp_c", "zscore_temp",
    "today_wind_kmh", "zscore_wind", "today_precip_mm", "zscore_precip",
    "anomaly_type", "severity", "detected_at",
]
FEATURE_COLUMNS = ["mean_temp_c", "temp_variability", "mean_humidity", "mean_wind_kmh", "mean_precip_mm"]
CLUSTER_COLUMNS = ["city", "country", *FEATURE_COLUMNS, "prediction", "climate_cluster"]
FORECAST_COLUMNS = [
    "forecast_date", "predicted_temp_c", "predicted_low_c", "predicted_high_c",
    "city", "country", "generated_at",
]
