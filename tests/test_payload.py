import json

from meteora.config import PipelineConfig
from meteora.sources import payload as P
from tests.helpers import NOW

CFG = PipelineConfig(now=NOW)
SCHEMA = "city string, country string, doc_id bigint, attempt int, ingested_at timestamp, body string"


def _doc(n=3, short=None, drop_hourly=False):
    h = {"time": [f"2025-03-01T{i:02d}:00" for i in range(n)], "temperature_2m": [1.0 * i for i in range(n)],
         "relative_humidity_2m": [50] * n, "wind_speed_10m": [3.0] * n, "precipitation": [0.0] * n,
         "weather_code": [1] * n}
    if short:
        h[short] = h[short][:-1]
    d = {"latitude": 1.0, "longitude": 2.0, "timezone": "UTC"}
    if not drop_hourly:
        d["hourly"] = h
    return json.dumps(d)


def test_quarantine_and_retry(spark):
    rows = [
        ("good", "C", 1, 1, NOW, _doc()),
        ("uneq", "C", 2, 1, NOW, _doc(short="wind_speed_10m")),
        ("nohourly", "C", 3, 1, NOW, _doc(drop_hourly=True)),
        ("badjson", "C", 4, 1, NOW, _doc()[:20]),
        ("recover", "C", 5, 1, NOW, _doc()[:10]),
        ("recover", "C", 5, 2, NOW, _doc(n=4)),
        ("stillbad", "C", 6, 1, NOW, "{"),
        ("stillbad", "C", 6, 2, NOW, _doc(short="time")),  # longer siblings are fine
        ("stillbad2", "C", 7, 1, NOW, "{"),
        ("stillbad2", "C", 7, 2, NOW, _doc(short="precipitation")),
    ]
    landing = spark.createDataFrame(rows, SCHEMA)
    parsed = P.parse_landing(landing)
    reasons = {(r.city, r.attempt): r.reason for r in P.quarantine(parsed).collect()}
    assert reasons[("uneq", 1)] == "length_mismatch"
    assert reasons[("nohourly", 1)] == "missing_hourly"
    assert reasons[("badjson", 1)] == "malformed_json"
    assert ("good", 1) not in reasons and ("stillbad", 2) not in reasons
    status = {r.city: (r.status, r.attempt_used) for r in P.retry_outcome(parsed).collect()}
    assert status["good"] == ("ok", 1) and status["recover"] == ("recovered", 2)
    assert status["stillbad2"] == ("failed", None) and status["stillbad"] == ("recovered", 2)
    bronze = P.landing_to_bronze(landing, CFG)
    counts = {r.city: r["count"] for r in bronze.groupBy("city").count().collect()}
    assert counts == {"good": 3, "recover": 4, "stillbad": 2}


def test_every_rejected_shape_keeps_its_text(spark):
    whole = json.loads(_doc())
    rows = [("late", "C", 1, 3, NOW, _doc()),
            ("noscalar", "C", 2, 1, NOW, json.dumps({"hourly": whole["hourly"]})),
            (None, None, None, None, None, "{broken line")]
    parsed = P.parse_landing(spark.createDataFrame(rows, SCHEMA))
    got = {r.body: r.reason for r in P.quarantine(parsed, 2).collect()}
    assert got == {rows[0][5]: "late_attempt", rows[1][5]: "missing_scalar", rows[2][5]: "unreadable_landing"}


def test_decimal_numbers_are_kept(spark):
    d = json.loads(_doc())
    d["hourly"]["relative_humidity_2m"] = [55.5, 50, 49.25]
    d["hourly"]["weather_code"] = [3.0, 1, 2]
    b = P.landing_to_bronze(spark.createDataFrame([("a", "C", 1, 1, NOW, json.dumps(d))], SCHEMA), CFG)
    assert sorted((r.humidity_pct, r.weather_code) for r in b.collect()) == [(49.25, 2.0), (50.0, 1.0), (55.5, 3.0)]


def test_each_document_is_parsed_once(spark):
    parsed = P.parse_landing(spark.createDataFrame([("a", "C", 1, 1, NOW, _doc()), ("b", "C", 2, 1, NOW, None)], SCHEMA))
    for df in (P.quarantine(parsed), P.flatten(P.first_valid(parsed))):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [(r.city, r.reason) for r in P.quarantine(parsed).collect()] == [("b", "malformed_json")]
