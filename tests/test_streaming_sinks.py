import os

from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.operators.gold import gold_daily
from meteora.operators.silver import to_silver
from meteora.plans import jobs
from meteora.schemas import DAILY_COLUMNS
from meteora.sources.adapters import events_observations
from meteora.plans.landing_fixture import events_landing
from meteora.streaming.incremental import start_silver_and_daily
from tests.conftest import SF001
from tests.helpers import NOW

CFG = PipelineConfig(now=NOW, state_buckets=2)


def test_streams_match_batch(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    obs = events_observations(ev, CFG)
    bronze_dir = os.path.join(tmpdir_path, "bronze")
    cut = "2024-01-15"
    obs.filter(F.col("time") < cut).write.parquet(os.path.join(bronze_dir, "b1"))
    obs.filter(F.col("time") >= cut).write.parquet(os.path.join(bronze_dir, "b2"))
    silver_dir, daily_dir = os.path.join(tmpdir_path, "silver"), os.path.join(tmpdir_path, "daily")
    spark.conf.set("spark.sql.streaming.schemaInference", "true")
    q1, q2 = start_silver_and_daily(spark, bronze_dir + "/*", silver_dir, daily_dir, CFG, name="t1")
    q1.awaitTermination(120)
    q2.awaitTermination(120)
    s_stream = spark.read.parquet(silver_dir)
    s_batch = to_silver(obs, CFG)
    keys = lambda df: sorted((r.city, r.time) for r in df.select("city", "time").collect())
    assert keys(s_stream) == keys(s_batch)
    d_stream = spark.read.parquet(daily_dir)
    d_batch = gold_daily(s_batch)
    closed = d_stream.select("date").distinct().count()
    assert closed > 0
    last = d_batch.agg(F.max("date")).first()[0]
    import datetime as dt
    closed_days = d_batch.filter(F.col("date") < F.lit(last - dt.timedelta(days=3)))
    row = lambda df: {tuple(r) for r in df.select(*DAILY_COLUMNS).collect()}
    assert row(closed_days) <= row(d_stream) <= row(d_batch)  # every closed day, all columns


def test_jobs_round_trip(spark, tmpdir_path):
    db = "meteora_t"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/db'")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    cfg = CFG.with_(quality_min_rows=100, min_history_days=20)
    gate = jobs.run_hourly(spark, events_landing(ev, cfg), cfg, db)
    assert gate["row_count"]["passed"]
    assert spark.table(f"{db}.{jobs.SILVER}").count() > 0
    assert spark.table(f"{db}.{jobs.QUARANTINE}").count() > 0
    assert spark.table(f"{db}.{jobs.ABSENT}").count() == 100  # none of the list is among the events' users
    res = jobs.run_clustering(spark, cfg, db, csv_dir=os.path.join(tmpdir_path, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv")).count() == \
        spark.table(f"{db}.{jobs.CLUSTERS}").count()
    assert res.best_k >= cfg.k_min
    fc = jobs.run_forecasting(spark, cfg.with_(min_training_rows=20), db)
    assert fc.count() > 0
    assert spark.table(f"{db}.{jobs.RUNLOG}").count() > 0


def test_upsert_latest_wins(spark, tmpdir_path):
    import datetime as dt
    from meteora.streaming.incremental import start_silver_upsert, upsert_silver_batch
    from tests.helpers import bronze_rows, obs

    db = "meteora_u"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/udb'")
    table = f"{db}.silver_upsert"
    b1 = [obs("A", "2025-03-01T00:00", 1.0), obs("A", "2025-03-02T00:00", 2.0), obs("B", "2025-03-01T05:00", 3.0)]
    b2 = [obs("A", "2025-03-01T00:00", 9.0, ingested=NOW + dt.timedelta(hours=1)),
          obs("C", "2025-03-03T00:00", 4.0)]
    b3 = [obs("A", "2025-03-01T00:00", 5.0, ingested=NOW - dt.timedelta(hours=1))]  # late, older ingest
    for b in (b1, b2, b3):
        upsert_silver_batch(spark, bronze_rows(spark, b), table, CFG)
    got = {(r.city, str(r.time)): r.temperature_c for r in spark.table(table).collect()}
    assert got == {("A", "2025-03-01 00:00:00"): 9.0, ("A", "2025-03-02 00:00:00"): 2.0,
                   ("B", "2025-03-01 05:00:00"): 3.0, ("C", "2025-03-03 00:00:00"): 4.0}
    # the same through a file stream
    src = os.path.join(tmpdir_path, "ub")
    bronze_rows(spark, b1).write.parquet(os.path.join(src, "p1"))
    bronze_rows(spark, b2).write.parquet(os.path.join(src, "p2"))
    q = start_silver_upsert(spark, src + "/*", f"{db}.silver_upsert_s", CFG, name="u1")
    q.awaitTermination(180)
    got2 = {(r.city, str(r.time)): r.temperature_c for r in spark.table(f"{db}.silver_upsert_s").collect()}
    assert got2[("A", "2025-03-01 00:00:00")] == 9.0 and len(got2) == 4


def _body(times, temp=1.0, **hourly):
    import json
    n = len(times)
    h = {"time": times, "temperature_2m": [temp + i for i in range(n)], "relative_humidity_2m": [55.5] * n,
         "wind_speed_10m": [5.0] * n, "precipitation": [0.0] * n, "weather_code": [3.0] * n} | hourly
    return json.dumps({"latitude": 1.0, "longitude": 2.0, "timezone": "UTC", "hourly": h})


def test_backfill_bounds_the_observed_days(spark, tmpdir_path):
    import json
    from meteora.plans.jobs import run_backfill
    hours = lambda day: [f"{day}T{h:02d}:00" for h in range(24)]
    land = os.path.join(tmpdir_path, "land")
    rows = [("X", "2025-03-01", "2025-03-01"), ("Y", "2025-03-05", "2025-03-05"),
            ("Z", "2025-04-01", "2025-03-02"),  # observed inside, ingested later
            ("W", "2025-03-02", "2025-02-20")]  # ingested inside, observed before
    for city, ingested, observed in rows:
        folder = os.path.join(land, f"observed_date={observed}")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"{city}.jsonl"), "w") as fh:
            fh.write(json.dumps({"city": city, "country": "C", "doc_id": 1, "attempt": 1,
                                 "ingested_at": f"{ingested}T12:00:00", "body": _body(hours(observed))}) + "\n")
    db = "meteora_b"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/bdb'")
    gate = run_backfill(spark, land, "2025-03-01", "2025-03-05", CFG.with_(quality_min_rows=10), db)
    assert gate["row_count"]["observed"] == "72"
    assert {r.city for r in spark.table(f"{db}.weather_silver").collect()} == {"X", "Y", "Z"}
    assert {r.humidity_pct for r in spark.table(f"{db}.weather_silver").collect()} == {55.5}
    from meteora.sources.landing import read_envelopes
    p = read_envelopes(spark, land, observed=("2025-03-01", "2025-03-05"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in p and "observed_date" in p.split("PartitionFilters: [")[1][:300]


def test_incremental_equals_full_with_ties_bad_times_and_late_batches(spark, tmpdir_path):
    from meteora.sources.payload import landing_to_bronze
    schema = "city string, country string, doc_id long, attempt int, ingested_at timestamp, body string"
    t = ["2025-03-02T00:00", "2025-03-02T01:00"]
    batches = [
        [("A", "C", 5, 1, NOW, _body(t, 9.0)), ("B", "C", 1, 1, NOW, _body(["soon", "2025-03-01T03:00"], 4.0))],
        [("A", "C", 2, 1, NOW, _body(t, 1.0)),  # same stamp, lower sequence
         ("B", "C", 2, 1, NOW, _body(["never"], 8.0))],
        [("A", "C", 9, 1, NOW, _body(["2025-03-01T00:00"], 7.0))],  # a day before
    ]
    cfg = CFG.with_(quality_min_rows=1, min_history_days=1)
    db = "meteora_eq"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/eqdb'")
    for b in batches:
        gate = jobs.run_hourly_incremental(spark, spark.createDataFrame(b, schema), cfg, db)
    every = spark.createDataFrame([r for b in batches for r in b], schema)
    full = to_silver(landing_to_bronze(every, cfg), cfg)
    cols = [c for c in full.columns]
    rows = lambda df: sorted((tuple(map(str, r)) for r in df.select(*cols).collect()))
    got = spark.table(f"{db}.{jobs.SILVER_INC}")
    assert rows(got) == rows(full)
    assert got.filter("time IS NULL").count() == 1
    assert gate["row_count"]["observed"] == str(full.count())
    first = spark.table(f"{db}.{jobs.LATEST_INC}").filter("city = 'A'").collect()
    assert [(r.temperature_c, str(r.time)) for r in first] == [(10.0, "2025-03-02 01:00:00")]


def test_incremental_hourly_equals_full_rebuild(spark, tmpdir_path):
    from meteora.schemas import RANKING_COLUMNS
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    cfg = CFG.with_(quality_min_rows=10, min_history_days=20)
    db = "meteora_inc"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/idb'")
    cut = "2024-01-20"
    jobs.run_hourly_incremental(spark, events_landing(ev.filter(F.col("ts") < cut), cfg), cfg, db)
    later = cfg.with_(now=cfg.now.replace(hour=1))
    jobs.run_hourly_incremental(spark, events_landing(ev.filter(F.col("ts") >= cut), later), later, db)
    full = events_landing(ev, cfg)
    from meteora.sources.payload import landing_to_bronze
    silver = to_silver(landing_to_bronze(full, cfg).drop("doc_id", "attempt"), cfg)
    daily = gold_daily(silver)
    rows = lambda df, cols: sorted(tuple(r) for r in df.select(*cols).collect())
    assert rows(spark.table(f"{db}.{jobs.DAILY_INC}"), DAILY_COLUMNS) == rows(daily, DAILY_COLUMNS)
    from meteora.operators.gold import city_ranking
    rk = [c for c in RANKING_COLUMNS]
    assert rows(spark.table(f"{db}.{jobs.RANKING}"), rk) == rows(city_ranking(silver), rk)
    from meteora.operators import anomalies as A
    a_cols = ["city", "country", "date", "zscore_temp", "anomaly_type", "severity"]
    assert rows(spark.table(f"{db}.{jobs.ANOMALIES}"), a_cols) == rows(A.anomalies(daily, cfg), a_cols)


def test_a_batch_run_twice_leaves_one_copy(spark, tmpdir_path):
    db = "meteora_twice"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/twdb'")
    cfg = CFG.with_(quality_min_rows=1, min_history_days=1)
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    first = None
    for run in (jobs.run_hourly, jobs.run_hourly, jobs.run_hourly_incremental):
        run(spark, events_landing(ev, cfg), cfg, db)
        counts = [spark.table(f"{db}.{t}").count() for t in (jobs.BRONZE, jobs.QUARANTINE)]
        first = first or counts
        assert counts == first
    jobs.ingest_landing(spark, events_landing(ev, cfg).limit(0), cfg, db, batch="other")
    assert [spark.table(f"{db}.{t}").count() for t in (jobs.BRONZE, jobs.QUARANTINE)] == first


def test_landing_stream_ingests_each_file_once(spark, tmpdir_path):
    import json
    db, land = "meteora_land", os.path.join(tmpdir_path, "inbox")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/ldb'")
    os.makedirs(land)

    def drop(name, city, body):
        with open(os.path.join(land, name), "w") as fh:
            fh.write(json.dumps({"city": city, "country": "C", "doc_id": 1, "attempt": 1,
                                 "ingested_at": "2025-03-01T12:00:00", "body": body}) + "\nnot an envelope\n")

    def run():
        jobs.start_landing(spark, land, CFG, db, name="inbox1").awaitTermination(120)
        return (sorted(r.city for r in spark.table(f"{db}.{jobs.BRONZE}").collect()),
                spark.table(f"{db}.{jobs.QUARANTINE}").count())

    drop("a.jsonl", "A", _body(["2025-03-01T00:00"]))
    assert run() == (["A"], 1)
    assert run() == (["A"], 1)  # nothing new
    drop("b.jsonl", "B", _body(["2025-03-01T00:00", "2025-03-01T01:00"]))
    assert run() == (["A", "B", "B"], 2)
    # the last micro-batch again, as after a failure before its commit
    again = spark.read.schema("city string").json(land)
    assert again.count() == 4
    from meteora.sources.landing import read_envelopes
    jobs.ingest_landing(spark, read_envelopes(spark, os.path.join(land, "b.jsonl")), CFG, db, batch="inbox1-1")
    assert spark.table(f"{db}.{jobs.BRONZE}").count() == 3 and spark.table(f"{db}.{jobs.QUARANTINE}").count() == 2


def test_publish_keeps_the_old_table_on_failure_and_takes_a_new_schema(spark, tmpdir_path):
    import pytest
    from meteora.sinks import publish, write_table
    db = "meteora_pub"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/pdb'")
    name = f"{db}.t"
    write_table(spark.range(3), name)  # a plain table from before
    publish(spark.range(5), name)
    assert spark.table(name).count() == 5
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception):
        publish(broken, name)
    assert spark.table(name).count() == 5
    publish(spark.table(name).selectExpr("id AS key", "'x' AS value"), name)  # from itself, other columns
    assert spark.table(name).columns == ["key", "value"] and spark.table(name).count() == 5
    publish(spark.range(2), name)
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()]
    assert len(left) == 3  # the view, its table and the one before


def test_a_day_is_written_by_many_tasks(spark, tmpdir_path):
    from meteora.streaming.incremental import upsert_silver_batch
    from tests.helpers import bronze_rows, obs
    db = "meteora_day"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/ddb'")
    rows = [obs(f"s{i}", "2025-03-01T00:00", 1.0) for i in range(200)] + [obs("x", "never", 2.0)]
    upsert_silver_batch(spark, bronze_rows(spark, rows), f"{db}.s", CFG.with_(state_buckets=8))
    upsert_silver_batch(spark, bronze_rows(spark, rows[:1]), f"{db}.s", CFG.with_(state_buckets=64))  # keeps its 8
    t = spark.table(f"{db}.s")
    assert t.count() == 201 and t.select("bucket").distinct().count() == 8
    files = t.filter("day = DATE '2025-03-01'").select(F.input_file_name()).distinct().count()
    assert files == 8
    from meteora.sinks import touched_rows
    hit = touched_rows(t, spark.createDataFrame([("2025-03-01", 3)], "day string, bucket int")
                       .selectExpr("CAST(day AS DATE) AS day", "bucket"), "day")
    plan = hit._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1][:60]


def test_history_states_merge_and_subtract_exactly(spark):
    import datetime as dt
    from meteora.operators import anomalies as A
    from meteora.operators import baselines as B
    from tests.helpers import daily_rows
    rows = [(c, "C", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), round(0.1 * ((i * 37) % 101) - 3, 1), 0.1 * (i % 7), 1.5)
            for c in ("a", "b") for i in range(400)]
    rows += [("n", "C", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), [float("nan"), 1.0, None][i % 3], 2.0, None)
             for i in range(60)]
    daily = daily_rows(spark, rows)
    keys = ["city", "country", "month"]
    month = lambda d: d.withColumn("month", B.month_of("date"))
    states = B.history_states(month(daily), keys)
    whole = B.history_states(daily, ["city", "country"])
    stat = lambda s: sorted(map(str, B.statistics(s).select(
        "city", "history_days", *A._STATS).collect()))
    assert stat(B.merge_states(states)) == stat(whole)
    cut = F.col("date") < F.lit("2024-06-01").cast("timestamp_ntz")
    part = B.history_states(daily.filter(cut), ["city", "country"])
    rest = B.history_states(daily.filter(~cut), ["city", "country"]).drop("odd_temp", "odd_wind", "odd_precip")
    assert stat(B.subtract_states(whole, part)) == stat(rest)
    cfg = CFG.with_(min_history_days=30)
    for r, q in zip(*(d.orderBy("city").collect() for d in (
            B.statistics(B.merge_states(states)), A.baseline(daily, cfg))), strict=True):
        for c in A._STATS:
            assert (r[c] is None) == (q[c] is None) and (r[c] is None or str(r[c]) == str(q[c]) or abs(r[c] - q[c]) < 1e-9)
    cols = ["city", "country", "date", "zscore_temp", "zscore_wind", "anomaly_type", "severity"]
    low = cfg.with_(zscore_threshold=0.1)
    assert sorted(map(str, A.anomalies_from_states(states, low).select(*cols).collect())) == \
        sorted(map(str, A.anomalies(daily, low).select(*cols).collect()))


def test_corrections_account_for_every_row(spark, tmpdir_path):
    import datetime as dt
    from meteora.streaming import corrections as K
    from tests.helpers import bronze_rows, obs
    db = "meteora_cor"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmpdir_path}/cdb'")
    day = lambda d, h=0: f"2025-03-{d:02d}T{h:02d}:00"
    later = NOW + dt.timedelta(hours=1)
    batches = [
        [obs(c, day(d, h), d + h / 10, precip=h) for c in "ABC" for d in (1, 2, 9) for h in range(4)] + [obs("A", "soon", 1.0)],
        [obs("A", day(1), 30.0, ingested=later), obs("A", day(1), 30.0, ingested=later),  # a closed day, twice
         obs("B", day(1), 99.0, ingested=NOW - dt.timedelta(hours=1)),  # older than what is known
         obs("D", day(2), 5.0), obs("D", None, 5.0), obs("E", day(10), 7.0)],
        [obs("A", day(1), 30.0, country="K", ingested=NOW + dt.timedelta(hours=2))],  # the reading's country changes
    ]
    src = os.path.join(tmpdir_path, "cb")
    cfg = CFG.with_(state_buckets=4)
    for i, b in enumerate(batches):
        bronze_rows(spark, b).coalesce(1).write.parquet(os.path.join(src, f"p{i}"))
        K.start_corrected_daily(spark, src + "/*", db, cfg, name="cor1").awaitTermination(180)
    t = {x: spark.table(f"{db}.{x}") for x in (K.SILVER, K.DAILY, K.SIDE, K.CHANGES)}
    every = [r for b in batches for r in b]

    def right():
        for x in t:
            spark.catalog.refreshTable(f"{db}.{x}")
        now = {x: spark.table(f"{db}.{x}") for x in t}
        assert now[K.SILVER].count() + now[K.SIDE].count() == len(every)
        assert sorted(r.reason for r in now[K.SIDE].collect()) == ["no_time"] * 2 + ["superseded"] * 4
        batch = gold_daily(to_silver(bronze_rows(spark, every), cfg)).filter("date IS NOT NULL")
        rows = lambda df: sorted(map(str, df.select(*DAILY_COLUMNS).collect()))
        replayed = [r for r in now[K.CHANGES].collect()]
        live = {}
        for r in sorted(replayed, key=lambda r: (r.epoch, r.op)):  # + sorts before -
            if r.op == "-" and live.get((r.city, r.country, r.date), (None,))[0] != r.epoch:
                live.pop((r.city, r.country, r.date))
            elif r.op == "+":
                live[r.city, r.country, r.date] = (r.epoch, str(r[K.DAILY_COLUMNS[3]]))
        assert rows(now[K.DAILY]) == rows(batch)
        assert live.keys() == {(r.city, r.country, r.date) for r in batch.collect()}
        assert {(r.city, r.op) for r in replayed if r.late and r.epoch == 1} == {("A", "+"), ("A", "-"), ("D", "+")}

    right()
    K.correct_batch(spark, bronze_rows(spark, batches[2]), 2, db, cfg)  # run again after a failure
    right()
