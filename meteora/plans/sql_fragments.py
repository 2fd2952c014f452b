"""DuckDB SQL text that rebuilds each stage independently of Spark.

Used only as the correctness oracle: every ``oracle_sql`` entry is a WITH
chain built from these fragments over the raw driver tables.
"""

from __future__ import annotations


def rh(expr: str, d: int) -> str:
    """Half-up rounding at a fixed decimal scale (mirror of round_half_up)."""
    return (f"coalesce(CAST(round(TRY_CAST(({expr}) AS DECIMAL(38,12)), {d}) AS DOUBLE), "
            f"round(({expr}), {d}))")


def zdiv(num: str, den: str) -> str:
    return f"(({num}) / nullif(({den}), 0))"


OBS_A = """obs_a AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS city,
         'g' || CAST(user_id % 5 AS VARCHAR) AS country,
         ts AS time,
         CAST(value AS DOUBLE) AS temperature_c,
         CAST(100 - k AS BIGINT) AS humidity_pct,
         CAST(k AS DOUBLE) AS wind_speed_kmh,
         CAST(value / 10 AS DOUBLE) AS precipitation_mm,
         CAST(k AS BIGINT) AS weather_code,
         CAST(event_id AS BIGINT) AS ingest_seq
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""

OBS_A_HOUR = OBS_A.replace("obs_a AS", "obs_ah AS").replace(
    "ts AS time", "date_trunc('hour', ts) AS time")

OBS_B = """obs_b AS (
  SELECT n.n_name AS city, r.r_name AS country, l.l_shipdate AS time,
         CAST(l.l_quantity AS DOUBLE) AS temperature_c,
         CAST(l.l_discount * 1000 AS BIGINT) AS humidity_pct,
         CAST(l.l_tax * 1000 AS DOUBLE) AS wind_speed_kmh,
         CAST(l.l_extendedprice / 1000 AS DOUBLE) AS precipitation_mm,
         CAST(l.l_linenumber AS BIGINT) AS weather_code,
         CAST(l.l_orderkey * 100 + l.l_linenumber AS BIGINT) AS ingest_seq
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

DEDUP_ORDER = ("ingest_seq DESC NULLS LAST, country DESC NULLS LAST, temperature_c DESC NULLS LAST, "
               "humidity_pct DESC NULLS LAST, wind_speed_kmh DESC NULLS LAST, "
               "precipitation_mm DESC NULLS LAST, weather_code DESC NULLS LAST")

# fixed values: condition ranges (same table as meteora.functions.weather)
CONDITION_CASE = """CASE
    WHEN weather_code = 0 THEN 'Clear sky'
    WHEN weather_code = 1 THEN 'Mainly clear'
    WHEN weather_code = 2 THEN 'Partly cloudy'
    WHEN weather_code = 3 THEN 'Overcast'
    WHEN weather_code BETWEEN 45 AND 48 THEN 'Foggy'
    WHEN weather_code BETWEEN 51 AND 55 THEN 'Drizzle'
    WHEN weather_code BETWEEN 61 AND 65 THEN 'Rain'
    WHEN weather_code BETWEEN 71 AND 75 THEN 'Snow'
    WHEN weather_code BETWEEN 80 AND 82 THEN 'Rain showers'
    WHEN weather_code BETWEEN 95 AND 99 THEN 'Thunderstorm'
    ELSE 'Unknown' END"""

FEELS = rh("13.12 + 0.6215 * temperature_c - 11.37 * pow(wind_speed_kmh, 0.16)"
           " + 0.3965 * temperature_c * pow(wind_speed_kmh, 0.16)", 1)


def dedup(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT city, country, time, temperature_c, humidity_pct, wind_speed_kmh,
         precipitation_mm, weather_code
  FROM {src}
  QUALIFY row_number() OVER (PARTITION BY city, time ORDER BY {DEDUP_ORDER}) = 1
)"""


def silver(src: str, name: str) -> str:
    return f"""{dedup(src, name + '_d')},
{name} AS (
  SELECT city, country, time, temperature_c, {FEELS} AS feels_like_c,
         humidity_pct, wind_speed_kmh, precipitation_mm,
         {CONDITION_CASE} AS weather_description
  FROM {name}_d
)"""


def daily(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT city, country, CAST(CAST(time AS DATE) AS TIMESTAMP) AS date,
         {rh('avg(temperature_c)', 1)} AS avg_temp_c,
         {rh('min(temperature_c)', 1)} AS min_temp_c,
         {rh('max(temperature_c)', 1)} AS max_temp_c,
         {rh('avg(feels_like_c)', 1)} AS avg_feels_like_c,
         {rh('avg(humidity_pct)', 1)} AS avg_humidity_pct,
         {rh('avg(wind_speed_kmh)', 1)} AS avg_wind_speed_kmh,
         {rh('sum(precipitation_mm)', 1)} AS total_precipitation_mm
  FROM {src}
  GROUP BY city, country, CAST(CAST(time AS DATE) AS TIMESTAMP)
)"""


def latest(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY time DESC NULLS LAST,
      country DESC NULLS LAST, temperature_c DESC NULLS LAST, feels_like_c DESC NULLS LAST,
      humidity_pct DESC NULLS LAST, wind_speed_kmh DESC NULLS LAST,
      precipitation_mm DESC NULLS LAST, weather_description DESC NULLS LAST) = 1
)"""


def ranking(src: str, name: str) -> str:
    return f"""{latest(src, name + '_l')},
{name} AS (
  SELECT CAST(rank() OVER (ORDER BY temperature_c DESC NULLS LAST) AS INTEGER) AS temp_rank,
         city, country, temperature_c, feels_like_c, humidity_pct, wind_speed_kmh,
         precipitation_mm, weather_description, time
  FROM {name}_l
)"""


def baseline(src: str, name: str, min_days: int) -> str:
    return f"""{name} AS (
  SELECT city, country,
         avg(avg_temp_c) AS hist_mean_temp, stddev_samp(avg_temp_c) AS hist_std_temp,
         avg(avg_wind_speed_kmh) AS hist_mean_wind, stddev_samp(avg_wind_speed_kmh) AS hist_std_wind,
         avg(total_precipitation_mm) AS hist_mean_precip,
         stddev_samp(total_precipitation_mm) AS hist_std_precip,
         count(*) AS history_days
  FROM {src} GROUP BY city, country
  HAVING count(*) >= {min_days}
)"""


def snapshot(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT city, date, avg_temp_c AS today_temp, avg_wind_speed_kmh AS today_wind,
         total_precipitation_mm AS today_precip
  FROM {src}
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY date DESC NULLS LAST,
      country DESC NULLS LAST, avg_temp_c DESC NULLS LAST,
      avg_wind_speed_kmh DESC NULLS LAST, total_precipitation_mm DESC NULLS LAST) = 1
)"""


def zscores(daily_name: str, name: str, min_days: int) -> str:
    return f"""{baseline(daily_name, name + '_b', min_days)},
{snapshot(daily_name, name + '_s')},
{name} AS (
  SELECT s.city, b.country, s.date, s.today_temp, s.today_wind, s.today_precip,
         b.hist_mean_temp, b.hist_std_temp, b.hist_mean_wind, b.hist_std_wind,
         b.hist_mean_precip, b.hist_std_precip, b.history_days,
         {zdiv('s.today_temp - b.hist_mean_temp', 'b.hist_std_temp')} AS zscore_temp,
         {zdiv('s.today_wind - b.hist_mean_wind', 'b.hist_std_wind')} AS zscore_wind,
         {zdiv('s.today_precip - b.hist_mean_precip', 'b.hist_std_precip')} AS zscore_precip
  FROM {name}_s s JOIN {name}_b b ON s.city = b.city
)"""


def flags(z_name: str, name: str, t: float) -> str:
    return f"""{name} AS (
  SELECT *, abs(zscore_temp) > {t} AS temp_anomaly, abs(zscore_wind) > {t} AS wind_anomaly,
         abs(zscore_precip) > {t} AS precip_anomaly,
         (abs(zscore_temp) > {t}) OR (abs(zscore_wind) > {t}) OR (abs(zscore_precip) > {t}) AS is_anomaly
  FROM {z_name}
)"""


def anomalies(f_name: str, name: str, t: float, extreme: float = 3.5, high: float = 2.5) -> str:
    sev = " ".join(
        f"WHEN abs({z}) > {cut} THEN '{lab}'"
        for z in ("zscore_temp", "zscore_wind", "zscore_precip")
        for cut, lab in ((extreme, "Extreme"), (high, "High"))
    )
    return f"""{name} AS (
  SELECT city, country, date,
         {rh('today_temp', 1)} AS today_temp_c, {rh('hist_mean_temp', 1)} AS normal_temp_c,
         {rh('zscore_temp', 2)} AS zscore_temp,
         {rh('today_wind', 1)} AS today_wind_kmh, {rh('zscore_wind', 2)} AS zscore_wind,
         {rh('today_precip', 1)} AS today_precip_mm, {rh('zscore_precip', 2)} AS zscore_precip,
         CASE WHEN temp_anomaly AND zscore_temp > 0 THEN 'Unusually hot'
              WHEN temp_anomaly AND zscore_temp < 0 THEN 'Unusually cold'
              WHEN wind_anomaly AND zscore_wind > 0 THEN 'Unusually windy'
              WHEN precip_anomaly AND zscore_precip > 0 THEN 'Unusually rainy'
              ELSE NULL END AS anomaly_type,
         CASE {sev} ELSE NULL END AS severity
  FROM {f_name} WHERE is_anomaly
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
