"""Operations queries: quality gate, printed report, table counts, run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.operators import anomalies as A
from meteora.operators import forecasting as FC
from meteora.operators import quality as QY
from meteora.operators.gold import latest_per_city
from meteora.operators.runlog import forecast_run_log
from meteora.plans import inputs as I
from meteora.plans import q_forecast as QF
from meteora.plans import sql_fragments as Q
from meteora.plans.catalog import register

_B_SILVER = [Q.OBS_B, Q.silver("obs_b", "s")]
_FLOOR = I.QCFG.quality_min_rows


@register("quality_checks", Q.with_(*_B_SILVER, "st AS (SELECT count(*) AS total, "
                                    "count_if(temperature_c IS NULL) AS nulls, max(time) AS latest FROM s)")
          + f"""SELECT 'row_count' AS "check", CAST(total AS VARCHAR) AS observed, '> {_FLOOR}' AS expected,
       total > {_FLOOR} AS passed FROM st
UNION ALL SELECT 'null_temperatures', CAST(nulls AS VARCHAR), '= 0', nulls = 0 FROM st
UNION ALL SELECT 'latest_time', CAST(latest AS VARCHAR), 'not null', latest IS NOT NULL FROM st""")
def quality_checks_q(spark, root):
    """The gate over Silver B with the published floor of 1,000,000 rows
    (fails at test scale; the table shows which check and why)."""
    return QY.quality_checks(I.silver_b(spark, root), _FLOOR)


@register("quality_report", Q.with_(*_B_SILVER, "st AS (SELECT count(*) AS total, "
                                    "count_if(temperature_c IS NULL) AS nulls, max(time) AS latest FROM s)")
          + """SELECT 'Total Silver rows' AS metric, format('{:,}', total) AS text FROM st
UNION ALL SELECT 'Null temperatures', CAST(nulls AS VARCHAR) FROM st
UNION ALL SELECT 'Latest timestamp', coalesce(CAST(latest AS VARCHAR), 'None') FROM st""")
def quality_report_q(spark, root):
    return QY.quality_report(I.silver_b(spark, root))


@register("table_counts", Q.with_(*_B_SILVER, Q.daily("s", "g"), Q.ranking("s", "r"),
                                  Q.zscores("g", "z", I.QCFG.min_history_days), Q.flags("z", "f", 1.5),
                                  Q.anomalies("f", "a", 1.5))
          + """SELECT (SELECT count(*) FROM obs_b) AS bronze_rows, (SELECT count(*) FROM s) AS silver_rows,
       (SELECT count(*) FROM g) AS daily_rows, (SELECT count(*) FROM r) AS ranking_rows,
       (SELECT count(*) FROM a) AS anomalies_rows""")
def table_counts_q(spark, root):
    cfg = I.QCFG.with_(zscore_threshold=1.5)
    bronze = I.obs_b(spark, root)
    silver = I.silver_b(spark, root)
    daily = I.daily_b(spark, root)
    return QY.table_counts(bronze=bronze, silver=silver, daily=daily,
                           ranking=latest_per_city(silver), anomalies=A.anomalies(daily, cfg))


_RUN = "forecast_all_cities"


@register("run_metrics", Q.with_(*QF._TREND_SQL, f"m AS ({QF._METRICS_SQL})") + f"""
SELECT '{_RUN}' AS run_id, CAST(NULL AS VARCHAR) AS parent_run, 'param' AS kind, name, value
FROM (VALUES ('forecast_days', {float(I.QCFG.forecast_days)}), ('min_training_rows', {float(I.QCFG.min_training_rows)}),
             ('changepoint_prior_scale', {I.QCFG.changepoint_prior_scale}), ('interval_width', {I.QCFG.interval_width})) v(name, value)
UNION ALL
SELECT '{_RUN}', NULL, 'param', 'cities_count', CAST(count(DISTINCT city) AS DOUBLE) FROM g
UNION ALL
SELECT 'forecast_' || city, '{_RUN}', 'param', 'training_rows', CAST(training_rows AS DOUBLE) FROM m
UNION ALL SELECT 'forecast_' || city, '{_RUN}', 'metric', 'last_actual_temp', last_actual_temp FROM m
UNION ALL SELECT 'forecast_' || city, '{_RUN}', 'metric', 'first_forecast_temp', first_forecast_temp FROM m
UNION ALL SELECT 'forecast_' || city, '{_RUN}', 'metric', 'avg_uncertainty_c', avg_uncertainty_c FROM m""")
def run_metrics_q(spark, root):
    """The numbers of a forecast run's log: parent parameters, one child run
    per station with its training rows and three metrics."""
    daily = I.daily_b(spark, root)
    metrics = FC.forecast_metrics(daily, FC.trend_points(daily, I.QCFG))
    log = forecast_run_log(_RUN, I.QCFG, daily, metrics).filter(~F.col("name").isin("city", "country"))
    return log.withColumn("value", F.col("value").cast("double"))
