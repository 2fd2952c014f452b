"""Serving queries: what the dashboard reads from the Gold tables."""

from __future__ import annotations

from meteora.operators import anomalies as A
from meteora.operators import forecasting as FC
from meteora.operators import serving as S
from meteora.operators.gold import city_ranking, latest_per_city
from meteora.plans import inputs as I
from meteora.plans import q_clustering as QC
from meteora.plans import q_forecast as QF
from meteora.plans import sql_fragments as Q
from meteora.plans.catalog import register

_CFG_A = I.QCFG_A
_RANK_A = [Q.OBS_A, Q.silver("obs_a", "s"), Q.ranking("s", "r")]
_ANOM_A = [Q.daily("s", "g"), Q.zscores("g", "z", _CFG_A.min_history_days),
           Q.flags("z", "f", _CFG_A.zscore_threshold), Q.anomalies("f", "a", _CFG_A.zscore_threshold)]
FORECAST_CITY = "NATION_1"
DRILL_COUNTRY = "g2"


def _ranking_a(spark, root):
    return city_ranking(I.silver_a(spark, root))


def _latest_a(spark, root):
    return latest_per_city(I.silver_a(spark, root))


def _anomalies_a(spark, root):
    return A.anomalies(I.daily_a(spark, root, _CFG_A), _CFG_A)


@register("serve_ranking", Q.with_(*_RANK_A)
          + "SELECT temp_rank, city, country, temperature_c, feels_like_c, humidity_pct, wind_speed_kmh, "
            "weather_description FROM r ORDER BY temp_rank")
def serve_ranking_q(spark, root):
    return S.serve_ranking(spark, _ranking_a(spark, root))


@register("serve_anomalies", Q.with_(*_RANK_A, *_ANOM_A)
          + "SELECT city, country, anomaly_type, severity, today_temp_c, normal_temp_c, zscore_temp "
            "FROM a ORDER BY abs(zscore_temp) DESC")
def serve_anomalies_q(spark, root):
    return S.serve_anomalies(spark, _anomalies_a(spark, root))


@register("serve_forecast", Q.with_(*QF._TREND_SQL, "fc AS (" + QF._TREND_FINAL + ")")
          + f"SELECT forecast_date, predicted_temp_c, predicted_low_c, predicted_high_c FROM fc "
            f"WHERE city = '{FORECAST_CITY}' ORDER BY forecast_date")
def serve_forecast_q(spark, root):
    f = FC.trend_forecast(I.daily_b(spark, root), I.QCFG)
    return S.serve_forecast(spark, f, FORECAST_CITY)


@register("serve_clusters", Q.with_(*QC._LABELLED_SQL)
          + "SELECT city, country, climate_cluster, mean_temp_c, mean_humidity FROM lab "
            "ORDER BY climate_cluster, mean_temp_c DESC")
def serve_clusters_q(spark, root):
    return S.serve_clusters(spark, QC._labelled(spark, root))


@register("city_list", Q.with_(*_RANK_A) + "SELECT DISTINCT city FROM r ORDER BY city")
def city_list_q(spark, root):
    return S.city_list(_latest_a(spark, root))


@register("kpi_tiles", Q.with_(*_RANK_A, *_ANOM_A) + """SELECT
  arg_min(city, (temp_rank, city)) AS hottest_city,
  arg_min(temperature_c, (temp_rank, city)) AS hottest_temp_c,
  arg_max(city, (temp_rank, city)) AS coldest_city,
  arg_max(temperature_c, (temp_rank, city)) AS coldest_temp_c,
  count(*) AS cities_tracked,
  (SELECT count(*) FROM a) AS anomalies_today
FROM r""")
def kpi_tiles_q(spark, root):
    return S.kpi_tiles(_latest_a(spark, root), _anomalies_a(spark, root))


@register("forecast_axis_range", Q.with_(*QF._TREND_SQL, "fc AS (" + QF._TREND_FINAL + ")")
          + "SELECT city, min(predicted_low_c) - 2 AS y_min, max(predicted_high_c) + 2 AS y_max "
            "FROM fc GROUP BY city")
def forecast_axis_range_q(spark, root):
    return S.forecast_axis_range(FC.trend_forecast(I.daily_b(spark, root), I.QCFG))


@register("country_map", Q.with_(*_RANK_A)
          + f"SELECT country, {Q.rh('avg(temperature_c)', 1)} AS mean_temp_c, count(*) AS cities "
            "FROM r GROUP BY country")
def country_map_q(spark, root):
    return S.country_map(_latest_a(spark, root))


@register("condition_mix", Q.with_(*_RANK_A)
          + "SELECT weather_description, count(*) AS cities FROM r GROUP BY weather_description")
def condition_mix_q(spark, root):
    return S.condition_mix(_latest_a(spark, root))


@register("drilldown", Q.with_(*_RANK_A)
          + f"SELECT temp_rank, city, country, temperature_c, weather_description FROM r "
            f"WHERE country = '{DRILL_COUNTRY}'")
def drilldown_q(spark, root):
    return S.drilldown(spark, _ranking_a(spark, root), country=DRILL_COUNTRY)
