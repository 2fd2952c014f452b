"""Landing rows for the queries and tests: documents built from the
``events`` table, with outages decided by the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.numerics import stamp

DOC_BLOCK = 64  # event ids per document: bounds every document's size


def events_landing(events: DataFrame, cfg: PipelineConfig | None = None, awkward: bool = False) -> DataFrame:
    """Landing rows derived from ``events``: one document per (user, block of
    64 event ids), with simulated outages decided by the document's first
    event: type 'error' fails attempt 1 (and attempt 2 too when its k < 20);
    the failure shape cycles by doc_id % 3 through truncated JSON, missing
    ``hourly``, and a temperature array one element short. With ``awkward``
    the shapes cycle by doc_id % 7 and go on with missing ``time``, missing
    ``timezone``, no body and no attempt number, documents that failed twice
    have a valid third attempt, and times of events with k % 10 = 7 are no
    times."""
    cfg = cfg or PipelineConfig()
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = events.select(
        "user_id", "event_id", "event_type", k.alias("k"),
        (F.when(k % 10 == 7, F.concat(F.lit("about "), F.date_format("ts", "HH"))) if awkward else F.when(F.lit(False), ""))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias("t"),
        F.col("value").cast("double").alias("v"),
        F.floor(F.col("event_id") / DOC_BLOCK).cast("bigint").alias("doc_id"),
    )
    docs = rows.groupBy("user_id", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("event_id", "t", "v", "k", "event_type"))).alias("r"))
    r = F.col("r")
    temps = F.transform(r, lambda x: x["v"])
    hourly = F.struct(
        F.transform(r, lambda x: x["t"]).alias("time"),
        temps.alias("temperature_2m"),
        F.transform(r, lambda x: F.lit(100) - x["k"]).alias("relative_humidity_2m"),
        F.transform(r, lambda x: x["k"].cast("double")).alias("wind_speed_10m"),
        F.transform(r, lambda x: x["v"] / 10).alias("precipitation"),
        F.transform(r, lambda x: x["k"]).alias("weather_code"),
    )
    short_hourly = hourly.withField("temperature_2m", F.slice(temps, 1, F.size(temps) - 1))
    scal = [(F.col("user_id") % 90).cast("double").alias("latitude"),
            (F.col("user_id") % 180).cast("double").alias("longitude"), F.lit("UTC").alias("timezone")]
    good = F.to_json(F.struct(*scal, hourly.alias("hourly")))
    shape = F.col("doc_id") % (7 if awkward else 3)
    no_zone, no_time = F.struct(*scal[:2], hourly.alias("hourly")), F.struct(*scal, hourly.dropFields("time").alias("hourly"))
    bad = (F.when(shape == 0, F.substring(good, 1, F.floor(F.length(good) / 2).cast("int")))
           .when(shape == 1, F.to_json(F.struct(*scal)))
           .when(shape == 3, F.to_json(no_time)).when(shape == 4, F.to_json(no_zone)).when(shape >= 5, F.lit(None))
           .otherwise(F.to_json(F.struct(*scal, short_hourly.alias("hourly")))))
    first = r[0]
    fail1 = first["event_type"] == "error"
    fail2 = fail1 & (first["k"] < 20)
    base = docs.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("city"),
        F.concat(F.lit("g"), (F.col("user_id") % 5).cast("string")).alias("country"),
        "doc_id", shape.alias("shape"), fail1.alias("f1"), fail2.alias("f2"), good.alias("good"), F.when(fail1, bad).alias("bad"))
    # One pass: attempt 1 for every document, attempt 2 only after a failure.
    tries = F.when(F.col("f1"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    if awkward:
        tries = F.when(F.col("f2"), F.array(*map(F.lit, (1, 2, 3)))).otherwise(tries)
    x = base.select("*", F.explode(tries).alias("attempt"))
    failed = F.when(F.col("attempt") == 1, F.col("f1")).when(F.col("attempt") == 2, F.col("f2")).otherwise(False)
    number = F.when(~(failed & (F.col("shape") == 6) & F.lit(awkward)), F.col("attempt"))
    return x.select(
        "city", "country", "doc_id", number.cast("int").alias("attempt"),
        (stamp(cfg.now) + F.make_dt_interval(mins=F.col("attempt") - 1)).alias("ingested_at"),
        F.when(failed, F.col("bad")).otherwise(F.col("good")).alias("body"))
