import datetime as dt

from meteora.config import PipelineConfig
from meteora.operators import anomalies as A
from tests.helpers import NOW, daily_rows

CFG = PipelineConfig(now=NOW)
D0 = dt.datetime(2025, 1, 1)


def _series(city, n, temps=None, winds=None, precs=None):
    rows = []
    for i in range(n):
        t = temps[i] if temps else 10.0 + (i % 3)
        w = winds[i] if winds else 10.0 + (i % 2)
        p = precs[i] if precs else 1.0 + (i % 4)
        rows.append((city, "C", D0 + dt.timedelta(days=i), t, w, p))
    return rows


def test_history_floor(spark):
    d = daily_rows(spark, _series("short", 29) + _series("long", 30))
    got = {r.city for r in A.baseline(d, CFG).collect()}
    assert got == {"long"}


def test_zero_sigma_precip_null_z_row_kept(spark):
    n = 40
    temps = [10.0 + (i % 3) for i in range(n - 1)] + [40.0]
    d = daily_rows(spark, _series("X", n, temps=temps, precs=[2.0] * n))
    rows = A.anomalies(d, CFG).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.zscore_precip is None and r.anomaly_type == "Unusually hot"


def test_low_wind_outlier_type_null_severity_set(spark):
    n = 40
    winds = [20.0 + (i % 2) for i in range(n - 1)] + [0.0]
    d = daily_rows(spark, _series("W", n, winds=winds))
    rows = A.anomalies(d, CFG).collect()
    assert len(rows) == 1
    assert rows[0].anomaly_type is None and rows[0].severity in ("High", "Extreme")


def test_severity_temperature_first(spark):
    from pyspark.sql import functions as F
    from meteora.functions.weather import severity
    df = spark.createDataFrame([(2.7, 4.0, None)], "zt double, zw double, zp double")
    assert df.select(severity("zt", "zw", "zp")).first()[0] == "High"
    df2 = spark.createDataFrame([(None, None, -3.6)], "zt double, zw double, zp double")
    assert df2.select(severity("zt", "zw", "zp")).first()[0] == "Extreme"
    assert F is not None


def test_anomaly_set_shrinks_with_threshold(spark):
    from tests.conftest import SF01
    from meteora.plans import inputs as I
    d = I.daily_a(spark, SF01, I.QCFG_A).cache()
    counts = [A.anomalies(d, I.QCFG_A.with_(zscore_threshold=t)).count() for t in (1.0, 1.5, 2.5, 3.5)]
    assert counts == sorted(counts, reverse=True)
    d.unpersist()
