"""Forecast queries (adapter B: 25 stations with thousands of days)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.functions.numerics import round_half_up as rh
from meteora.operators import forecasting as FC
from meteora.plans import inputs as I
from meteora.plans import sql_fragments as Q
from meteora.plans.catalog import register
from meteora.schemas import FORECAST_COLUMNS

_CFG = I.QCFG
_D = _CFG.stat_digits
_Z = repr(FC.interval_z(_CFG.interval_width))
_OUT = [c for c in FORECAST_COLUMNS if c != "generated_at"]

_B_DAILY = [Q.OBS_B, Q.silver("obs_b", "s"), Q.daily("s", "g")]
_AB_DAILY = [Q.OBS_A, Q.silver("obs_a", "sa"), Q.daily("sa", "ga"), *_B_DAILY,
             "gab AS (SELECT * FROM ga UNION ALL SELECT * FROM g)"]

_XD = "CAST(date_diff('day', DATE '1970-01-01', CAST({c} AS DATE)) AS DOUBLE)"
_X = _XD.format(c="date")
_XF = _XD.format(c="forecast_date")


def _coef_sql(src, name, min_rows):
    return f"""{name}_a AS (
  SELECT city, arg_min(country, date) AS country, count(*) AS n,
         regr_count(avg_temp_c, {_X}) AS n_xy, regr_avgx(avg_temp_c, {_X}) AS mean_x,
         regr_avgy(avg_temp_c, {_X}) AS mean_y, regr_slope(avg_temp_c, {_X}) AS slope,
         regr_sxx(avg_temp_c, {_X}) AS sxx, regr_syy(avg_temp_c, {_X}) AS syy,
         regr_sxy(avg_temp_c, {_X}) AS sxy, max(date) AS last_date
  FROM {src} GROUP BY city
),
{name} AS (
  SELECT city, country, n, mean_x, mean_y, slope,
         sqrt(greatest(syy - sxy * sxy / nullif(sxx, 0), 0.0) / nullif(CAST(n_xy - 2 AS DOUBLE), 0)) AS sigma,
         last_date
  FROM {name}_a WHERE n >= {min_rows}
)"""


def _horizon_sql(src, name, days):
    return f"""{name} AS (
  SELECT c.*, h.h, CAST(CAST(c.last_date AS DATE) + CAST(h.h AS INTEGER) AS TIMESTAMP) AS forecast_date
  FROM {src} c CROSS JOIN range(1, {days} + 1) AS h(h)
  WHERE c.slope IS NOT NULL
)"""


def _finish_sql(src, yhat, half):
    return (f"SELECT forecast_date, {Q.rh(yhat, 1)} AS predicted_temp_c, "
            f"{Q.rh(f'({yhat}) - ({half})', 1)} AS predicted_low_c, "
            f"{Q.rh(f'({yhat}) + ({half})', 1)} AS predicted_high_c, city, country FROM {src}")


_TREND_YHAT = f"mean_y + slope * ({_XF} - mean_x)"
_TREND_SQL = [*_B_DAILY, _coef_sql("g", "coef", _CFG.min_training_rows),
              _horizon_sql("coef", "hz", _CFG.forecast_days)]
_TREND_FINAL = _finish_sql("hz", _TREND_YHAT, f"{_Z} * sigma")


@register("series_extent", Q.with_(*_B_DAILY)
          + "SELECT count(DISTINCT city) AS cities, min(date) AS first_date, max(date) AS last_date, "
            "count(*) AS rows FROM g")
def series_extent_q(spark, root):
    return FC.series_extent(I.daily_b(spark, root))


@register("forecast_eligible", Q.with_(*_AB_DAILY)
          + f"SELECT city, arg_min(country, date) AS country, count(*) AS training_rows, "
            f"count(*) >= {_CFG.min_training_rows} AS eligible FROM gab GROUP BY city")
def forecast_eligible_q(spark, root):
    """Both station sets: A's 21-30 day series are skipped, B's forecast."""
    d = I.daily_a(spark, root).unionByName(I.daily_b(spark, root))
    return FC.eligibility(d, _CFG)


@register("forecast_trend", Q.with_(*_TREND_SQL) + _TREND_FINAL)
def forecast_trend_q(spark, root):
    return FC.trend_forecast(I.daily_b(spark, root), _CFG).select(*_OUT)


_SEAS_SQL = [*_TREND_SQL, f"""fit AS (
  SELECT city, date, avg_temp_c,
         count(*) OVER (PARTITION BY city) AS n,
         regr_avgy(avg_temp_c, {_X}) OVER (PARTITION BY city)
           + regr_slope(avg_temp_c, {_X}) OVER (PARTITION BY city)
             * ({_X} - regr_avgx(avg_temp_c, {_X}) OVER (PARTITION BY city)) AS fitted
  FROM g
)""", f"""mres AS (
  SELECT city, month(date) AS month, avg(avg_temp_c - fitted) AS month_resid
  FROM fit WHERE n >= {_CFG.min_training_rows} GROUP BY city, month(date)
)""", """hzm AS (
  SELECT hz.*, coalesce(m.month_resid, 0.0) AS month_resid
  FROM hz LEFT JOIN mres m ON hz.city = m.city AND month(hz.forecast_date) = m.month
)"""]


@register("forecast_seasonal", Q.with_(*_SEAS_SQL)
          + _finish_sql("hzm", f"{_TREND_YHAT} + month_resid", f"{_Z} * sigma"))
def forecast_seasonal_q(spark, root):
    return FC.seasonal_forecast(I.daily_b(spark, root), _CFG).select(*_OUT)


_COEF_COLS = ["mean_x", "mean_y", "slope", "sigma"]


@register("forecast_coefficients", Q.with_(*_B_DAILY, _coef_sql("g", "coef", _CFG.min_training_rows))
          + "SELECT city, country, n, " + ", ".join(f"{Q.rh(c, _D)} AS {c}" for c in _COEF_COLS)
          + ", last_date FROM coef")
def forecast_coefficients_q(spark, root):
    """Per-station model artefact of the trend form (one row per station)."""
    c = FC.trend_coefficients(I.daily_b(spark, root), _CFG)
    return c.select("city", "country", "n", *[rh(x, _D).alias(x) for x in _COEF_COLS], "last_date")


_METRICS_SQL = f"""SELECT f.city, f.country, l.training_rows,
       {Q.rh('l.last_actual_temp', 2)} AS last_actual_temp,
       {Q.rh('f.first_forecast_temp', 2)} AS first_forecast_temp,
       {Q.rh('f.avg_uncertainty_c', 2)} AS avg_uncertainty_c
FROM (SELECT city, country, arg_min({_TREND_YHAT}, forecast_date) AS first_forecast_temp,
             avg(2 * ({_Z} * sigma)) AS avg_uncertainty_c
      FROM hz GROUP BY city, country) f
JOIN (SELECT city, arg_max(avg_temp_c, date) AS last_actual_temp, count(*) AS training_rows
      FROM g GROUP BY city) l ON f.city = l.city"""


@register("forecast_metrics", Q.with_(*_TREND_SQL) + _METRICS_SQL)
def forecast_metrics_q(spark, root):
    d = I.daily_b(spark, root)
    return FC.forecast_metrics(d, FC.trend_points(d, _CFG))


@register("forecast_status", Q.with_(*_AB_DAILY, _coef_sql("gab", "coef", _CFG.min_training_rows),
                                     f"""st AS (
  SELECT e.city, CASE WHEN e.training_rows < {_CFG.min_training_rows} THEN 'skipped'
                      WHEN c.slope IS NULL THEN 'failed' ELSE 'ok' END AS status
  FROM (SELECT city, count(*) AS training_rows FROM gab GROUP BY city) e
  LEFT JOIN coef c ON e.city = c.city
)""")
          + "SELECT CAST(count_if(status = 'ok') AS BIGINT) AS cities_succeeded, "
            "CAST(count_if(status = 'failed') AS BIGINT) AS cities_failed, "
            "CAST(count_if(status = 'skipped') AS BIGINT) AS cities_skipped FROM st")
def forecast_status_q(spark, root):
    d = I.daily_a(spark, root).unionByName(I.daily_b(spark, root))
    return FC.status_counts(FC.trend_status(d, _CFG))


@register("forecast_labels", Q.with_(*_TREND_SQL, "fc AS (" + _TREND_FINAL + ")")
          + "SELECT city, forecast_date, CAST(predicted_temp_c AS VARCHAR) || '°C' AS label FROM fc")
def forecast_labels_q(spark, root):
    f = FC.trend_forecast(I.daily_b(spark, root), _CFG)
    return f.select("city", "forecast_date", FC.forecast_label().alias("label"))


@register("forecast_additive")
def forecast_additive_q(spark, root):
    """Trend + changepoints + yearly seasonality per station — rows only."""
    d = I.daily_a(spark, root).unionByName(I.daily_b(spark, root))
    return FC.additive_forecast(d, _CFG).select(*_OUT)


@register("forecast_additive_facts", Q.with_(*_AB_DAILY) + f"""
SELECT city, {_CFG.forecast_days}::BIGINT AS days,
       CAST(CAST(max(date) AS DATE) + 1 AS VARCHAR) AS first_day,
       CAST(CAST(max(date) AS DATE) + {_CFG.forecast_days} AS VARCHAR) AS last_day,
       true AS ordered
FROM gab GROUP BY city HAVING count(*) >= {_CFG.min_training_rows}""")
def forecast_additive_facts_q(spark, root):
    """What holds for any fit of the additive form: the eligible stations,
    their seven days, low ≤ predicted ≤ high."""
    d = I.daily_a(spark, root).unionByName(I.daily_b(spark, root))
    f = FC.additive_forecast(d, _CFG)
    p = F.col("predicted_temp_c")
    return f.groupBy("city").agg(
        F.count_distinct("forecast_date").alias("days"), F.min(F.col("forecast_date").cast("date")).cast("string").alias("first_day"),
        F.max(F.col("forecast_date").cast("date")).cast("string").alias("last_day"),
        F.bool_and((F.col("predicted_low_c") <= p) & (p <= F.col("predicted_high_c"))).alias("ordered"))


@register("forecast_additive_status", Q.with_(*_AB_DAILY) + f"""
SELECT CAST(count_if(n >= {_CFG.min_training_rows} AND city <> 'NATION_3') AS BIGINT) AS cities_succeeded,
       CAST(count_if(n >= {_CFG.min_training_rows} AND city = 'NATION_3') AS BIGINT) AS cities_failed,
       CAST(count_if(n < {_CFG.min_training_rows}) AS BIGINT) AS cities_skipped
FROM (SELECT city, count(*) AS n FROM gab GROUP BY city)""")
def forecast_additive_status_q(spark, root):
    """Outcomes of the additive form when one station's values are not
    numbers: it fails, the others go on."""
    d = I.daily_a(spark, root).unionByName(I.daily_b(spark, root))
    broken = F.when(F.col("city") == "NATION_3", F.lit(float("nan"))).otherwise(F.col("avg_temp_c"))
    return FC.status_counts(FC.additive_model_runs(d.withColumn("avg_temp_c", broken), _CFG))


@register("forecast_from_models", Q.with_(*_AB_DAILY) + f"""
SELECT city, CAST(CAST(max(date) AS DATE) + CAST(h AS INTEGER) AS TIMESTAMP) AS forecast_date, true AS as_fitted
FROM gab CROSS JOIN range(1, {_CFG.forecast_days} + 1) AS r(h)
GROUP BY city, h HAVING count(*) >= {_CFG.min_training_rows}""")
def forecast_from_models_q(spark, root):
    """Forecasts from the stored model table agree with those of the fit."""
    from meteora.operators.materialize import materialize
    runs = materialize(FC.additive_model_runs(I.daily_a(spark, root).unionByName(I.daily_b(spark, root)), _CFG))
    fitted = FC.run_points(runs).select("city", "forecast_date", F.col("yhat").alias("fit"))
    scored = FC.score_models(FC.models_of(runs), _CFG).join(fitted, ["city", "forecast_date"], "left")
    near = F.abs(F.col("yhat") - F.col("fit")) <= 1e-9 * F.greatest(F.abs("fit"), F.lit(1.0))
    return scored.select("city", "forecast_date", F.coalesce(near, F.lit(False)).alias("as_fitted"))


@register("forecast_interval_facts", Q.with_(*_B_DAILY, f"""cut AS (
  SELECT city, CAST(max(date) AS DATE) - {_CFG.forecast_days} AS cut FROM g GROUP BY city
)""", f"""seen AS (
  SELECT city, max(date) AS last FROM g JOIN cut USING (city) WHERE CAST(date AS DATE) <= cut
  GROUP BY city HAVING count(*) >= {_CFG.min_training_rows}
)""") + f"""
SELECT count(DISTINCT city) AS stations, count(*) AS days, true AS plausible
FROM g JOIN cut USING (city) JOIN seen USING (city)
WHERE CAST(date AS DATE) > cut AND CAST(date AS DATE) <= CAST(last AS DATE) + {_CFG.forecast_days}""")
def forecast_interval_facts_q(spark, root):
    """Held-out days that the 80 % interval covers: 60 to 95 of a hundred."""
    c = FC.held_out_coverage(I.daily_b(spark, root), _CFG)
    return c.select("stations", "days", F.col("coverage").between(0.6, 0.95).alias("plausible"))
