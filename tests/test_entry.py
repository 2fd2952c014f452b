import importlib

from tests.conftest import SF001


def test_entry_and_registry(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 12
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_some_oracles_small(spark):
    import duckdb
    import os
    E = importlib.import_module("__spark_entry__")
    q, o = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    for k in ["silver_clean", "gold_daily", "anomalies_b", "city_ranking", "payload_flatten", "forecast_trend"]:
        s = q[k](spark, SF001).toPandas()
        d = con.execute(o[k]).df()
        assert sorted(s.columns) == sorted(d.columns), k
        assert len(s) == len(d), k
