"""Ingest queries: station dimension, payload landing, quarantine, retry,
backfill range and union."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from meteora.operators.silver import observed_between, to_silver
from meteora.plans import inputs as I
from meteora.plans import sql_fragments as Q
from meteora.plans.catalog import register
from meteora.plans.landing_fixture import events_landing
from meteora.schemas import SILVER_COLUMNS
from meteora.sources import payload as P
from meteora.sources.adapters import events_observations, station_dim
from meteora.sources.cities import CITY_ROWS, absent_stations, city_dim

_SILVER_OUT = [c for c in SILVER_COLUMNS if c != "ingested_at"]

_DOCS_SQL = """ev AS (
  SELECT user_id, event_id, event_type, ts, CAST(value AS DOUBLE) AS value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id // 64 AS doc_id
  FROM events
),
docs AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS city, 'g' || CAST(user_id % 5 AS VARCHAR) AS country,
         user_id, doc_id,
         arg_min(event_type, event_id) = 'error' AS f1,
         arg_min(event_type, event_id) = 'error' AND arg_min(k, event_id) < 20 AS f2
  FROM ev GROUP BY user_id, doc_id
),
outcome AS (
  SELECT city, country, user_id, doc_id,
         CASE WHEN NOT f1 THEN 1 WHEN NOT f2 THEN 2 END AS attempt_used,
         CASE WHEN f1 THEN 2 ELSE 1 END AS attempts,
         CASE WHEN NOT f1 THEN 'ok' WHEN NOT f2 THEN 'recovered' ELSE 'failed' END AS status,
         CASE doc_id % 3 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_hourly'
              ELSE 'length_mismatch' END AS bad_reason,
         f1, f2
  FROM docs
)"""


def _landing(spark, root):
    return events_landing(I.table(spark, root, "events"), I.QCFG)


@register("dim_lookup", """SELECT d.city, d.country, coalesce(c.readings, 0) AS readings
FROM (SELECT n.n_nationkey AS nationkey, n.n_name AS city, r.r_name AS country
      FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) d
LEFT JOIN (SELECT c.c_nationkey AS nationkey, count(*) AS readings
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey) c
  ON d.nationkey = c.nationkey""")
def dim_lookup_q(spark, root):
    """Station dimension with its reading count (stations without readings
    kept with 0). The lineitem side is aggregated to one row per nation key
    before it meets the dimension."""
    t = lambda n: I.table(spark, root, n)
    per_nation = (t("lineitem").select("l_orderkey")
                  .join(t("orders").select("o_orderkey", "o_custkey").hint("merge"),
                        F.col("l_orderkey") == F.col("o_orderkey"))
                  .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
                  .groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("readings")))
    dim = station_dim(t("nation"), t("region"))
    return (dim.join(per_nation, "nationkey", "left")
            .select("city", "country", F.coalesce("readings", F.lit(0)).alias("readings")))


@register("payload_quarantine", Q.with_(_DOCS_SQL) + """
SELECT city, country, doc_id, 1 AS attempt, bad_reason AS reason FROM outcome WHERE f1
UNION ALL
SELECT city, country, doc_id, 2 AS attempt, bad_reason AS reason FROM outcome WHERE f2""")
def payload_quarantine_q(spark, root):
    q = P.quarantine(P.parse_landing(_landing(spark, root)))
    return q.select("city", "country", "doc_id", "attempt", "reason")


@register("retry_first_success", Q.with_(_DOCS_SQL)
          + "SELECT city, country, doc_id, attempt_used, attempts, status FROM outcome")
def retry_first_success_q(spark, root):
    r = P.retry_outcome(P.parse_landing(_landing(spark, root)), I.QCFG.retry_attempts)
    return r.select("city", "country", "doc_id", "attempt_used", "attempts", "status")


_FLAT_COLS = ["city", "country", "latitude", "longitude", "timezone", "time", "temperature_c",
              "humidity_pct", "wind_speed_kmh", "precipitation_mm", "weather_code", "ingest_seq",
              "doc_id", "attempt"]


@register("payload_flatten", Q.with_(_DOCS_SQL) + """
SELECT o.city, o.country, CAST(o.user_id % 90 AS DOUBLE) AS latitude, CAST(o.user_id % 180 AS DOUBLE) AS longitude,
       'UTC' AS timezone, strftime(e.ts, '%Y-%m-%dT%H:%M') AS time,
       e.value AS temperature_c, CAST(100 - e.k AS DOUBLE) AS humidity_pct,
       CAST(e.k AS DOUBLE) AS wind_speed_kmh, e.value / 10 AS precipitation_mm,
       CAST(e.k AS DOUBLE) AS weather_code, CAST(o.doc_id * 10 + o.attempt_used AS BIGINT) AS ingest_seq,
       o.doc_id, o.attempt_used AS attempt
FROM ev e JOIN outcome o ON e.user_id = o.user_id AND e.doc_id = o.doc_id
WHERE o.attempt_used IS NOT NULL""")
def payload_flatten_q(spark, root):
    """Every hour of every document whose first valid attempt exists."""
    b = P.landing_to_bronze(_landing(spark, root), I.QCFG)
    return b.select(*_FLAT_COLS)


_BACKFILL_START, _BACKFILL_END = "2024-01-05", "2024-01-20"


@register("backfill_range", Q.with_(Q.OBS_A.replace(
    "FROM events)", f"FROM events WHERE ts >= TIMESTAMP '{_BACKFILL_START}' "
                    f"AND ts < TIMESTAMP '{_BACKFILL_END}' + INTERVAL 1 DAY)"),
    Q.silver("obs_a", "s")) + f"SELECT {', '.join(_SILVER_OUT)} FROM s")
def backfill_range_q(spark, root):
    """Historical batch bounded by inclusive start / end dates."""
    ev = I.table(spark, root, "events").filter(observed_between(F.col("ts"), _BACKFILL_START, _BACKFILL_END))
    return to_silver(events_observations(ev, I.QCFG), I.QCFG).select(*_SILVER_OUT)


@register("backfill_union", Q.with_(Q.OBS_A, Q.silver("obs_a", "s")) + f"SELECT {', '.join(_SILVER_OUT)} FROM s")
def backfill_union_q(spark, root):
    """History (to 2024-01-20) and the current batch (from 2024-01-15, a
    later ingest) appended to one Bronze, then de-duplicated: the overlap
    keeps the later ingest and the result equals one clean Silver."""
    ev = I.table(spark, root, "events")
    hist = events_observations(ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), I.QCFG)
    cur_cfg = I.QCFG.with_(now=I.QCFG.now + _dt.timedelta(hours=1))
    cur = events_observations(ev.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")), cur_cfg)
    return to_silver(hist.unionByName(cur), I.QCFG).select(*_SILVER_OUT)


@register("stations_without_data", """SELECT d.city, d.country FROM (
  SELECT n.n_nationkey AS nationkey, n.n_name AS city, r.r_name AS country
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) d
WHERE NOT EXISTS (
  SELECT 1 FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
  WHERE c.c_nationkey = d.nationkey AND o.o_orderdate < DATE '1992-01-08')""")
def stations_without_data_q(spark, root):
    """Stations of the dimension that a batch (the first days' orders) has
    no document for: the fetch report's left-anti join."""
    t = lambda n: I.table(spark, root, n)
    batch = (t("orders").filter(F.col("o_orderdate") < F.lit("1992-01-08").cast("date"))
             .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
             .select(F.col("c_nationkey").alias("nationkey")))
    return absent_stations(station_dim(t("nation"), t("region")), batch, "nationkey").select("city", "country")


_AWKWARD_SQL = _DOCS_SQL.replace("""CASE doc_id % 3 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_hourly'
              ELSE 'length_mismatch' END""", """CASE doc_id % 7 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_hourly'
              WHEN 2 THEN 'length_mismatch' WHEN 3 THEN 'missing_time' WHEN 4 THEN 'missing_scalar'
              WHEN 5 THEN 'malformed_json' ELSE 'unreadable_landing' END""")
_TEXT_SQL = """obs_t AS (
  SELECT o.city, o.country,
         TRY_CAST(CASE WHEN e.k % 10 <> 7 THEN strftime(e.ts, '%Y-%m-%d %H:%M:00') END AS TIMESTAMP) AS time,
         e.value AS temperature_c, CAST(100 - e.k AS DOUBLE) AS humidity_pct, CAST(e.k AS DOUBLE) AS wind_speed_kmh,
         e.value / 10 AS precipitation_mm, CAST(e.k AS DOUBLE) AS weather_code,
         -- the second attempt came later
         CAST(o.attempt_used AS BIGINT) * 1000000000000 + o.doc_id * 10 + o.attempt_used AS ingest_seq
  FROM ev e JOIN outcome o ON e.user_id = o.user_id AND e.doc_id = o.doc_id
  WHERE o.attempt_used IS NOT NULL
)"""


def _awkward(spark, root):
    return events_landing(I.table(spark, root, "events"), I.QCFG, awkward=True)


@register("payload_to_silver", Q.with_(_AWKWARD_SQL, _TEXT_SQL, Q.silver("obs_t", "s"))
          + f"SELECT {', '.join(_SILVER_OUT)} FROM s")
def payload_to_silver_q(spark, root):
    """JSON documents to Silver, times as text: unreadable times become NULL
    and one reading a station stays of them."""
    return to_silver(P.landing_to_bronze(_awkward(spark, root), I.QCFG), I.QCFG).select(*_SILVER_OUT)


@register("payload_quarantine_shapes", Q.with_(_AWKWARD_SQL) + """
SELECT reason, count(*) AS documents FROM (
  SELECT bad_reason AS reason FROM outcome WHERE f1 UNION ALL SELECT bad_reason FROM outcome WHERE f2
  UNION ALL SELECT 'late_attempt' FROM outcome WHERE f2) GROUP BY reason""")
def payload_quarantine_shapes_q(spark, root):
    """Every reason for quarantine, and how many landing rows have it."""
    q = P.quarantine(P.parse_landing(_awkward(spark, root)), I.QCFG.retry_attempts)
    return q.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


_LISTED = ", ".join("({}, '{}', '{}')".format(i, c.replace("'", "''"), k) for i, (c, k, *_) in enumerate(CITY_ROWS))


@register("absent_listed_stations", f"""SELECT city, country FROM (VALUES {_LISTED}) v(i, city, country)
WHERE i NOT IN (SELECT user_id // 2 FROM events WHERE user_id % 2 = 0)""")
def absent_listed_stations_q(spark, root):
    """Stations of the published list without a document in a batch, here
    one in which every second user is the station of half the number."""
    dim = city_dim(spark)
    listed = spark.createDataFrame([(2 * i, c, k) for i, (c, k, *_) in enumerate(CITY_ROWS)],
                                   "user_id long, city string, country string")
    batch = I.table(spark, root, "events").select("user_id").join(F.broadcast(listed), "user_id")
    return absent_stations(dim, batch, ["city", "country"]).select("city", "country")
