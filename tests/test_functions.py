import math

from pyspark.sql import functions as F

from meteora.functions import condition_label, feels_like, round_half_up


def test_feels_like_edges(spark):
    df = spark.createDataFrame([(1, 20.0, 0.0), (2, -10.0, 30.0), (3, 5.0, None), (4, 5.0, -1.0)],
                               "id int, t double, v double")
    r = {x.id: x.f for x in df.select("id", feels_like("t", "v").alias("f")).collect()}
    assert r[1] == round(13.12 + 0.6215 * 20.0, 1)  # no wind terms
    assert r[2] == -19.5
    assert r[3] is None
    assert math.isnan(r[4])


def test_condition_labels_cover_all_codes(spark):
    df = spark.range(0, 100).select(F.col("id").alias("code")).union(spark.createDataFrame([(None,)], "code bigint"))
    r = {x.code: x.lab for x in df.select("code", condition_label("code").alias("lab")).collect()}
    assert r[0] == "Clear sky" and r[3] == "Overcast" and r[45] == "Foggy" and r[48] == "Foggy"
    assert r[55] == "Drizzle" and r[56] == "Unknown" and r[66] == "Unknown" and r[77] == "Unknown"
    assert r[80] == "Rain showers" and r[95] == "Thunderstorm" and r[None] == "Unknown"
    assert all(v is not None for v in r.values())


def test_round_half_up(spark):
    df = spark.createDataFrame([(1.005, 2), (-2.25, 1), (2.25, 1), (float("nan"), 1), (None, 1)], "x double, d int")
    got = [r[0] for r in df.select(
        F.when(F.col("d") == 2, round_half_up("x", 2)).otherwise(round_half_up("x", 1))).collect()]
    assert got[0] == 1.01 and got[1] == -2.3 and got[2] == 2.3
    assert math.isnan(got[3]) and got[4] is None


def test_scale_conf_sizes_partitions():
    from meteora.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 122880  # 30 TB / 256 MB
    assert int(scale_conf(10 ** 6, 8)["spark.sql.shuffle.partitions"]) == 24
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
