import datetime as dt

import pytest

from meteora.config import PipelineConfig
from meteora.operators import quality as QY
from meteora.operators import serving as S
from meteora.operators.silver import to_silver
from tests.helpers import NOW, bronze_rows, obs

CFG = PipelineConfig(now=NOW)


def test_forecast_param_with_quote(spark):
    f = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1.0, 0.0, 2.0, "O'Hare", "US")],
                              "forecast_date timestamp_ntz, predicted_temp_c double, predicted_low_c double, "
                              "predicted_high_c double, city string, country string")
    assert S.serve_forecast(spark, f, "x' OR '1'='1").count() == 0
    assert S.serve_forecast(spark, f, "O'Hare").count() == 1


def test_gate_fails_on_empty_and_null(spark):
    empty = to_silver(bronze_rows(spark, []), CFG)
    with pytest.raises(QY.QualityGateError):
        QY.enforce(QY.quality_checks(empty, 0))
    one_null = to_silver(bronze_rows(spark, [obs("A", "2025-03-01T00:00", None)]), CFG)
    rows = {r.check: r.passed for r in QY.quality_checks(one_null, 0).collect()}
    assert rows == {"row_count": True, "null_temperatures": False, "latest_time": True}
    ok = to_silver(bronze_rows(spark, [obs("A", "2025-03-01T00:00", 1.0)]), CFG)
    QY.enforce(QY.quality_checks(ok, 0))


def test_gate_from_observed_metrics():
    rows = QY.checks_from_metrics({"total": 5, "nulls": 1, "latest": dt.datetime(2025, 1, 1)}, 3)
    assert [r["passed"] for r in rows] == [True, False, True]
    with pytest.raises(QY.QualityGateError):
        QY.enforce_rows(rows)
    with pytest.raises(QY.QualityGateError):
        QY.enforce_rows(QY.checks_from_metrics({"total": 0, "nulls": 0, "latest": None}, 0))
    QY.enforce_rows(QY.checks_from_metrics({"total": 2, "nulls": 0, "latest": dt.datetime(2025, 1, 1)}, 1))
