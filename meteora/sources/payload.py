"""Payload landing: JSON documents → validated → Bronze rows.

A landing row is one fetch attempt of one document (city, doc_id, attempt,
ingested_at, body). Validation is a set of column predicates, so a bad
document is quarantined whole and the rest of the batch continues; the
retry rule ("first valid attempt wins, else still failed") is one
aggregation per document key.

A document is invalid when its JSON is malformed, ``hourly`` or
``hourly.time`` is missing, any hourly array is missing or shorter than
``time`` (longer arrays are cut to ``time``'s length), or latitude,
longitude or timezone is missing. Landing rows without a city, document or
attempt number (unreadable lines or file names) and valid attempts beyond
the retry limit go to quarantine too, with their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.operators.dedup import latest_by
from meteora.schemas import CORRUPT_COL, HOURLY_FIELDS, PAYLOAD

# fixed field map: payload hourly array → Bronze column
HOURLY_TO_BRONZE = [
    ("temperature_2m", "temperature_c", "double"),
    ("relative_humidity_2m", "humidity_pct", "double"),
    ("wind_speed_10m", "wind_speed_kmh", "double"),
    ("precipitation", "precipitation_mm", "double"),
    ("weather_code", "weather_code", "double"),
]


def parse_landing(landing: DataFrame) -> DataFrame:
    """Adds ``p`` (parsed document) and ``reason`` (NULL when valid)."""
    p = F.from_json("body", PAYLOAD, {"columnNameOfCorruptRecord": CORRUPT_COL, "mode": "PERMISSIVE"})
    # explode: a filter on ``reason`` pushed below a plain column parses once for each mention of ``p``
    df = landing.select("*", F.explode(F.array(p)).alias("p"))
    n = F.size("p.hourly.time")
    short = None
    for f in HOURLY_FIELDS[1:]:
        arr = F.col(f"p.hourly.{f}")
        cond = arr.isNull() | (F.size(arr) < n)
        short = cond if short is None else (short | cond)
    reason = (
        F.when(F.col("city").isNull() | F.col("doc_id").isNull() | F.col("attempt").isNull(), "unreadable_landing")
        .when(F.col("body").isNull() | F.col(f"p.{CORRUPT_COL}").isNotNull(), "malformed_json")
        .when(F.col("p.hourly").isNull(), "missing_hourly")
        .when(F.col("p.hourly.time").isNull(), "missing_time")
        .when(short, "length_mismatch")
        .when(F.col("p.latitude").isNull() | F.col("p.longitude").isNull() | F.col("p.timezone").isNull(),
              "missing_scalar")
    )
    return df.withColumn("reason", reason)


def quarantine(parsed: DataFrame, max_attempts: int = 2) -> DataFrame:
    late = F.when(F.col("attempt") > max_attempts, "late_attempt")
    return parsed.withColumn("reason", F.coalesce("reason", late)).filter(F.col("reason").isNotNull()).select(
        "city", "country", "doc_id", "attempt", "reason", "ingested_at", "body")


def retry_outcome(parsed: DataFrame, max_attempts: int = 2) -> DataFrame:
    """Per document: first valid attempt (≤ max_attempts) and a status of
    ok / recovered / failed."""
    a = F.col("attempt")
    ok_attempt = F.min(F.when(F.col("reason").isNull() & (a <= max_attempts), a))
    g = parsed.groupBy("city", "country", "doc_id").agg(
        ok_attempt.alias("attempt_used"), F.max(a).alias("attempts"))
    return g.withColumn(
        "status",
        F.when(F.col("attempt_used") == 1, "ok").when(F.col("attempt_used").isNotNull(), "recovered")
        .otherwise("failed"))


def first_valid(parsed: DataFrame, max_attempts: int = 2) -> DataFrame:
    """The first valid attempt of each document (documents never valid are
    absent: they stay in quarantine)."""
    v = parsed.filter(F.col("reason").isNull() & (F.col("attempt") <= max_attempts)) \
        .select("city", "country", "doc_id", (-F.col("attempt")).alias("_neg_attempt"),
                "attempt", "ingested_at", "p")
    return latest_by(v, ["city", "country", "doc_id"], ["_neg_attempt"]).drop("_neg_attempt")


def flatten(valid_docs: DataFrame) -> DataFrame:
    """i-th element of every hourly array + the document scalars → one
    Bronze row per hour; the number of rows follows ``hourly.time``."""
    h = "p.hourly"

    def row(t, i):
        fields = [t.alias("time")]
        for src, dst, typ in HOURLY_TO_BRONZE:
            fields.append(F.try_element_at(F.col(f"{h}.{src}"), i + 1).cast(typ).alias(dst))
        return F.struct(*fields)

    exploded = valid_docs.select(
        "city", "country", F.col("p.latitude").alias("latitude"),
        F.col("p.longitude").alias("longitude"), F.col("p.timezone").alias("timezone"),
        "ingested_at", "doc_id", "attempt",
        F.inline(F.transform(F.col(f"{h}.time"), row)),
    )
    return exploded.select(
        "city", "country", "latitude", "longitude", "timezone", "time",
        *[dst for _, dst, _ in HOURLY_TO_BRONZE], "ingested_at",
        (F.col("doc_id") * 10 + F.col("attempt")).cast("bigint").alias("ingest_seq"),
        "doc_id", "attempt",
    )


def landing_to_bronze(landing: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    cfg = cfg or PipelineConfig()
    return flatten(first_valid(parse_landing(landing), cfg.retry_attempts))
