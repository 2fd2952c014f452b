import json
import os

from meteora.config import PipelineConfig
from meteora.sources.cities import city_dim
from meteora.sources.landing import read_documents, read_envelopes
from meteora.sources.payload import landing_to_bronze, parse_landing, quarantine
from tests.helpers import NOW

CFG = PipelineConfig(now=NOW)


def _doc(n):
    return json.dumps({"latitude": 51.5, "longitude": -0.1, "timezone": "Europe/London",
                       "hourly": {"time": [f"2025-03-01T{i:02d}:00" for i in range(n)],
                                  "temperature_2m": [5.0 + i for i in range(n)],
                                  "relative_humidity_2m": [80] * n, "wind_speed_10m": [10.0] * n,
                                  "precipitation": [0.1] * n, "weather_code": [61] * n}})


def test_city_dim(spark):
    d = city_dim(spark)
    assert d.count() == 100 and d.select("city").distinct().count() == 100


def test_read_documents_layout(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "landing")
    for city, body, att in [("London", _doc(24), 1), ("Paris", "{oops", 1), ("Paris", _doc(3), 2)]:
        d = os.path.join(base, "country=XX", f"city={city}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"7.{att}.json"), "w") as fh:
            fh.write(body)
    landing = read_documents(spark, base)
    assert landing.count() == 3
    q = quarantine(parse_landing(landing)).collect()
    assert [(r.city, r.attempt, r.reason) for r in q] == [("Paris", 1, "malformed_json")]
    b = landing_to_bronze(landing, CFG)
    counts = {r.city: r["count"] for r in b.groupBy("city").count().collect()}
    assert counts == {"London": 24, "Paris": 3}


def test_read_envelopes(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "env.jsonl")
    with open(p, "w") as fh:
        for city, att, body in [("Oslo", 1, _doc(2)), ("Oslo", 2, _doc(2))]:
            fh.write(json.dumps({"city": city, "country": "NO", "doc_id": 1, "attempt": att,
                                 "ingested_at": "2025-03-01T10:00:00", "body": body}) + "\n")
    env = read_envelopes(spark, p, start="2025-03-01", end="2025-03-01")
    assert env.count() == 2
    assert landing_to_bronze(env, CFG).count() == 2
    assert read_envelopes(spark, p, start="2025-03-02").count() == 0


def test_landing_readers_lose_no_input(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "mixed.jsonl")
    with open(p, "w") as fh:
        fh.write(json.dumps({"city": "Oslo", "country": "NO", "doc_id": 1, "attempt": 1,
                             "ingested_at": "2025-03-01T10:00:00", "body": _doc(2)}) + "\nno envelope\n")
    for bounds in ({}, {"start": "2025-03-01", "end": "2025-03-01"}):
        env = read_envelopes(spark, p, **bounds)
        assert env.count() == 2
        assert [(r.reason, r.body) for r in quarantine(parse_landing(env)).collect()] == [
            ("unreadable_landing", "no envelope")]
    d = os.path.join(tmpdir_path, "docs", "country=XX", "city=Rome")
    os.makedirs(d)
    for name in ("7.1.json", "latest.json"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(_doc(2))
    landing = read_documents(spark, os.path.join(tmpdir_path, "docs"))
    assert landing.count() == 2
    assert [r.reason for r in quarantine(parse_landing(landing)).collect()] == ["unreadable_landing"]


def test_table_read_sees_new_files(spark, tmpdir_path):
    from meteora.sources.tables import load_table
    path = os.path.join(tmpdir_path, "t.parquet", "day=1")
    spark.range(2).write.parquet(path)
    assert load_table(spark, tmpdir_path, "t").count() == 2
    spark.range(3).write.mode("append").parquet(path)
    assert load_table(spark, tmpdir_path, "t").count() == 5
