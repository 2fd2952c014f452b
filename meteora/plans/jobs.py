"""Job functions: the hourly pipeline, the backfill, clustering and
forecasting runs. Each reads its inputs, writes each table once, and reads
written tables back for the next stage (a lineage cut on shared storage).
Driver actions are limited to one-row results (gate, counts, model choice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.numerics import stamp
from meteora.operators import anomalies as A
from meteora.operators import clustering as C
from meteora.operators import forecasting as FC
from meteora.operators import quality as QY
from meteora.operators.baselines import history_states, month_of
from meteora.operators.gold import city_ranking, gold_daily
from meteora.operators.dedup import latest_by
from meteora.operators.materialize import materialize
from meteora.operators.ranking import global_rank
from meteora.operators.runlog import RUNLOG_SCHEMA, cluster_size_metrics, forecast_run_log, metrics_long
from meteora.operators.silver import DEDUP_ORDER, observed_between, parse_time, silver_state, to_silver
from meteora.schemas import FEATURE_COLUMNS, RANKING_COLUMNS
from meteora.sinks import bucket_of, buckets_of, export_csv, overwrite_partitions, publish, touched_rows, write_table
from meteora.sources.cities import absent_stations, city_dim
from meteora.sources.payload import first_valid, flatten, parse_landing, quarantine
from meteora.streaming.incremental import upsert_silver_batch

BRONZE = "weather_bronze"
SILVER = "weather_silver"
DAILY = "weather_gold_daily"
RANKING = "weather_gold_city_ranking"
ANOMALIES = "weather_gold_anomalies"
CLUSTERS = "weather_gold_city_clusters"
FORECAST = "weather_gold_forecast"
QUARANTINE = "weather_quarantine"
ABSENT = "weather_absent_stations"
RUNLOG = "weather_run_log"


def _t(db: str, name: str) -> str:
    return f"{db}.{name}" if db else name


def batch_id(landing: DataFrame) -> str:
    """A name for the content of a landing batch, whatever its order."""
    h = F.xxhash64(*landing.columns)
    r = landing.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h)).alias("y")).first()
    return "-".join(f"{(v or 0) & (1 << 64) - 1:x}" for v in r)


def write_batch(df: DataFrame, name: str, batch: str, parts: tuple = ()) -> None:
    """Make ``df`` all that the table has of ``batch``: writing a batch again
    leaves one copy."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch = '{batch}')")
    overwrite_partitions(df.withColumn("batch", F.lit(batch)), name, ["batch", *parts], gather=False)


def ingest_landing(spark: SparkSession, landing: DataFrame, cfg: PipelineConfig, db: str = "",
                   observed: tuple[str, str] | None = None, batch: str | None = None,
                   stations: DataFrame | None = None) -> DataFrame:
    """Landing documents → quarantine and Bronze tables, and the stations of
    the list (``stations``, by default the published one) that the batch has
    no valid document of → the table of absent stations; returns the Bronze
    batch, one row per (city, time). ``observed`` bounds the days of
    observation (inclusive); rows without a readable time stay. Both tables
    are partitioned by ``batch`` (by default a name made from the content),
    Bronze by ingest day too; a batch that comes again replaces itself."""
    batch = batch or batch_id(landing)
    parsed = parse_landing(landing)
    write_batch(quarantine(parsed, cfg.retry_attempts), _t(db, QUARANTINE), batch)
    valid = first_valid(parsed, cfg.retry_attempts)
    dim = city_dim(spark) if stations is None else stations
    write_batch(absent_stations(dim, valid, ["city", "country"]).select("city", "country"), _t(db, ABSENT), batch)
    bronze = flatten(valid).drop("doc_id", "attempt")
    if observed:
        time = parse_time(bronze, cfg)
        bronze = bronze.filter(time.isNull() | observed_between(time, *observed))
    bronze = latest_by(bronze, ["city", "time"], DEDUP_ORDER).withColumn("ingest_date", F.to_date("ingested_at"))
    write_batch(bronze, _t(db, BRONZE), batch, ("ingest_date",))
    return spark.table(_t(db, BRONZE)).filter(F.col("batch") == batch).drop("batch", "ingest_date")


def rebuild_silver_gold(spark: SparkSession, cfg: PipelineConfig, db: str = "") -> dict:
    """Silver and the Gold tables from the whole Bronze table; returns the
    quality-gate rows (raises when the gate fails)."""
    from pyspark.sql import Observation

    bronze = spark.table(_t(db, BRONZE))
    gate = Observation("silver_gate")
    publish(to_silver(bronze, cfg).observe(gate, *QY.gate_metrics()), _t(db, SILVER))
    silver = spark.table(_t(db, SILVER))
    publish(gold_daily(silver), _t(db, DAILY))
    publish(city_ranking(silver), _t(db, RANKING))
    daily = spark.table(_t(db, DAILY))
    publish(A.anomalies(daily, cfg), _t(db, ANOMALIES))
    # Gate metrics were observed while Silver was written.
    rows = QY.checks_from_metrics(gate.get, cfg.quality_min_rows)
    QY.enforce_rows(rows)
    return {r["check"]: r for r in rows}


def run_hourly(spark: SparkSession, landing: DataFrame, cfg: PipelineConfig, db: str = "",
               batch: str | None = None, stations: DataFrame | None = None) -> dict:
    ingest_landing(spark, landing, cfg, db, batch=batch, stations=stations)
    return rebuild_silver_gold(spark, cfg, db)


def run_backfill(spark: SparkSession, landing_path: str, start: str, end: str,
                 cfg: PipelineConfig, db: str = "") -> dict:
    """Historical load: the observations of the inclusive days [start, end],
    whenever they were ingested → quarantine + Bronze append → rebuild. A
    landing folder partitioned by ``observed_date`` is pruned to those days."""
    from meteora.sources.landing import read_envelopes
    ingest_landing(spark, read_envelopes(spark, landing_path, observed=(start, end)), cfg, db, (start, end))
    return rebuild_silver_gold(spark, cfg, db)


def run_clustering(spark: SparkSession, cfg: PipelineConfig, db: str = "", csv_dir: str | None = None,
                   rule_labels: bool = False) -> C.SweepResult:
    """Sweep, label (hand map as published, or the centre rule for any k),
    write, log. ``rule_labels`` is ours and off by default."""
    daily = spark.table(_t(db, DAILY))
    res = C.kmeans_sweep(C.city_features(daily), cfg)
    final = (C.label_clusters_by_centres(res.clustered, res.model) if rule_labels
             else C.label_clusters(res.clustered, cfg))
    publish(C.sorted_table(final), _t(db, CLUSTERS))
    clusters = spark.table(_t(db, CLUSTERS))
    run_id = f"kmeans_k{res.best_k}"
    params = spark.createDataFrame(
        [(run_id, float(res.best_k), float(res.best_score), *[float(s) for _, s in res.scores])],
        ["run", "k", "best_silhouette_score", *[f"silhouette_k{k}" for k, _ in res.scores]])
    sizes = cluster_size_metrics(clusters).select(F.lit(run_id).alias("run_id"), F.lit(None).cast("string").alias("parent_run"),
                                                  F.lit("metric").alias("kind"), F.col("metric").alias("name"),
                                                  F.col("value").cast("string").alias("value"))
    # Centre coordinates in scaled units (k ≤ 8 rows from the fitted model):
    # temperature, humidity and precipitation, rounded to 3 dp.
    center_rows = spark.createDataFrame(
        [(run_id, None, "metric", f"center_{i}_{n}", str(round(float(c[j]), 3)))
         for i, c in enumerate(res.model.clusterCenters())
         for n, j in (("temp", 0), ("humidity", 2), ("precip", 4))],
        RUNLOG_SCHEMA)
    setup = clusters.agg(F.count(F.lit(1)).alias("cities_count")).select(
        F.lit(run_id).alias("run"), F.lit(",".join(FEATURE_COLUMNS)).alias("features"),
        F.lit("StandardScaler").alias("scaler"), "cities_count")
    log = metrics_long(setup, "run", None, "param").unionByName(metrics_long(params, "run", None, "metric")) \
        .unionByName(sizes).unionByName(center_rows)
    write_table(log.withColumn("logged_at", stamp(cfg.now)), _t(db, RUNLOG), mode="append")
    if csv_dir:
        export_csv(clusters, csv_dir)
    return res


def run_forecasting(spark: SparkSession, cfg: PipelineConfig, db: str = "") -> DataFrame:
    """Additive model per station (distributed), forecast table, run log with
    one child run per station and the succeeded / failed counts."""
    daily = spark.table(_t(db, DAILY))
    runs = FC.additive_model_runs(daily, cfg)
    runs_t = _t(db, FORECAST + "_runs")
    publish(runs, runs_t)
    runs = spark.table(runs_t)
    points = FC.run_points(runs)
    publish(FC.finish_points(points, cfg), _t(db, FORECAST))
    publish(FC.models_of(runs), _t(db, FORECAST + "_models"))
    run = "forecast_all_cities"
    log = forecast_run_log(run, cfg, daily, FC.forecast_metrics(daily, points))
    log = log.unionByName(metrics_long(FC.status_counts(runs).withColumn("run", F.lit(run)), "run", None, "metric"))
    errors = runs.filter(F.col("error").isNotNull()).select(
        F.concat(F.lit("forecast_"), F.col("city")).alias("run_id"), F.lit(run).alias("parent_run"),
        F.lit("error").alias("kind"), F.lit("error").alias("name"), F.col("error").alias("value"))
    log = log.unionByName(errors)
    write_table(log.withColumn("logged_at", stamp(cfg.now)), _t(db, RUNLOG), mode="append")
    return spark.table(_t(db, FORECAST))


# ---- incremental hourly run ------------------------------------------------

SILVER_INC = "weather_silver_by_day"
DAILY_INC = "weather_gold_daily_by_day"
LATEST_INC = "weather_latest_by_bucket"
GATE_INC = "weather_gate_by_day"
HISTORY_INC = "weather_history_states"


def run_hourly_incremental(spark: SparkSession, landing: DataFrame, cfg: PipelineConfig,
                           db: str = "", batch: str | None = None) -> dict:
    """Hourly run that merges a batch instead of rebuilding Silver.

    Bronze batch → Bronze; Silver gets the batch merged into the (day,
    bucket) partitions it touches; daily rows and the gate's counts are
    recomputed for those, the history states for their (month, bucket), and
    the latest readings for their buckets. Ranking reads the latest readings,
    anomalies read the history states. Results equal the full rebuild."""
    rows = ingest_landing(spark, landing, cfg, db, batch=batch)
    silver_t, daily_t = _t(db, SILVER_INC), _t(db, DAILY_INC)
    touched = upsert_silver_batch(spark, rows, silver_t, cfg)
    n = buckets_of(spark, silver_t, cfg.state_buckets)
    here = bucket_of("city", n)
    silver = touched_rows(spark.table(silver_t), touched, "day")
    daily = gold_daily(silver.drop("day", "bucket")).withColumn("day", F.col("date").cast("date"))
    overwrite_partitions(materialize(daily.withColumn("bucket", here)), daily_t, ["day", "bucket"], n)
    gate = silver.groupBy("day", "bucket").agg(*QY.gate_metrics())
    overwrite_partitions(materialize(gate), _t(db, GATE_INC), ["day", "bucket"], n)

    history_t = _t(db, HISTORY_INC)
    months = touched.select(month_of("day").alias("month"), "bucket").distinct()
    known = spark.table(daily_t).withColumn("month", month_of("day"))
    states = history_states(touched_rows(known, months, "month"), ["city", "country", "month", "bucket"])
    overwrite_partitions(materialize(states), history_t, ["month", "bucket"], n)

    latest_t = _t(db, LATEST_INC)
    new = silver_state(rows, cfg).withColumn("bucket", here)
    if spark.catalog.tableExists(latest_t):
        new = materialize(new)
        old = spark.table(latest_t).join(new.select("bucket").distinct(), "bucket", "left_semi")
        new = old.unionByName(new)
    latest = materialize(latest_by(new, ["city"], ["time", *DEDUP_ORDER]))
    overwrite_partitions(latest, latest_t, ["bucket"], n)

    ranking = global_rank(spark.table(latest_t).drop("bucket"), "temperature_c", "temp_rank").select(*RANKING_COLUMNS)
    publish(ranking, _t(db, RANKING))
    publish(A.anomalies_from_states(spark.table(history_t), cfg), _t(db, ANOMALIES))
    gate = spark.table(_t(db, GATE_INC)).agg(F.sum("total").alias("total"), F.sum("nulls").alias("nulls"),
                                             F.max("latest").alias("latest")).first().asDict()
    checks = QY.checks_from_metrics(gate, cfg.quality_min_rows)
    QY.enforce_rows(checks)
    return {r["check"]: r for r in checks}


def start_landing(spark: SparkSession, path: str, cfg: PipelineConfig, db: str = "", name: str = "landing",
                  available_now: bool = True):
    """File stream over a landing folder of envelopes. Every micro-batch is
    ingested under its own batch name, so one that is run again after a
    failure replaces itself: each file's documents land exactly once."""
    import os

    from meteora.session import checkpoint_dir
    from meteora.sources.landing import stream_envelopes

    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}

    def ingest(df: DataFrame, epoch: int) -> None:
        ingest_landing(df.sparkSession, df, cfg, db, batch=f"{name}-{epoch}")

    return (stream_envelopes(spark, path).writeStream.foreachBatch(ingest)
            .option("checkpointLocation", os.path.join(checkpoint_dir(spark), f"{name}_ingest"))
            .trigger(**trigger).start())
