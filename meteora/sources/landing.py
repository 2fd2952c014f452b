"""Landing-directory scans (the API fetcher writes here; HTTP is not part of
this library).

Two layouts are read:

* envelopes — JSON lines ``{"city", "country", "doc_id", "attempt",
  "ingested_at", "body"}`` where ``body`` is the raw payload text, so a
  malformed payload is still one landing row (and gets quarantined);
* documents — one raw payload per file under
  ``<root>/country=<c>/city=<name>/<doc_id>.<attempt>.json``; city and
  country come from partition discovery, ``ingested_at`` from the file's
  modification time.

Both can be bounded by an inclusive ingest-date range, which becomes a
filter on the file metadata / partition columns.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteora.schemas import CORRUPT_COL, LANDING


def _date_bounds(df: DataFrame, col: str, start: str | None, end: str | None) -> DataFrame:
    """Rows without a date (unreadable ones) stay, for quarantine."""
    if start:
        lo = F.lit(_dt.date.fromisoformat(start).isoformat()).cast("timestamp")
        df = df.filter(F.col(col).isNull() | (F.col(col) >= lo))
    if end:
        hi = F.lit((_dt.date.fromisoformat(end) + _dt.timedelta(days=1)).isoformat()).cast("timestamp")
        df = df.filter(F.col(col).isNull() | (F.col(col) < hi))
    return df


def _envelope_reader(reader):
    raw = T.StructField(CORRUPT_COL, T.StringType())
    return (reader.schema(T.StructType([*LANDING.fields, raw])).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL))


def _with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("body", F.coalesce(CORRUPT_COL, "body"))


def stream_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """The same as a file stream, without bounds."""
    return _with_text(_envelope_reader(spark.readStream).json(path)).select(*[f.name for f in LANDING.fields])


def read_envelopes(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                   observed: tuple[str, str] | None = None) -> DataFrame:
    """Envelopes, bounded by inclusive days of ingest (``start``, ``end``);
    ``observed`` prunes the folders of a layout partitioned by
    ``observed_date`` (rows without it stay). A line that is no envelope becomes a row with its text as ``body``
    and nothing else, which the parser sends to quarantine."""
    df = _with_text(_envelope_reader(spark.read).json(path))
    if observed and "observed_date" in df.columns:
        day = F.col("observed_date").cast("date")
        df = df.filter(day.isNull() | day.between(*(F.lit(d).cast("date") for d in observed)))
    return _date_bounds(df, "ingested_at", start, end).select(*[f.name for f in LANDING.fields])


def read_documents(spark: SparkSession, path: str, start: str | None = None,
                   end: str | None = None) -> DataFrame:
    """A file whose name is not ``<doc_id>.<attempt>.json`` has NULL for
    both and is quarantined by the parser."""
    raw = spark.read.option("wholetext", True).option("basePath", path).text(path)
    part = lambda i: F.nullif(F.regexp_extract(
        F.col("_metadata.file_name"), r"^(\d+)\.(\d+)\.json$", i), F.lit(""))
    df = raw.select(
        F.col("city").cast("string").alias("city"),
        F.col("country").cast("string").alias("country"),
        part(1).cast("bigint").alias("doc_id"),
        part(2).cast("int").alias("attempt"),
        F.col("_metadata.file_modification_time").alias("ingested_at"),
        F.col("value").alias("body"),
    )
    return _date_bounds(df, "ingested_at", start, end)
