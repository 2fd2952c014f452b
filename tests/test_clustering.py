import datetime as dt

from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.weather import lookup_label
from meteora.operators import clustering as C
from tests.conftest import SF01
from tests.helpers import NOW, daily_rows

CFG = PipelineConfig(now=NOW)


def test_one_day_city_dropped(spark):
    d0 = dt.datetime(2025, 1, 1)
    rows = [("one", "C", d0, 10.0, 5.0, 1.0)] + [("many", "C", d0 + dt.timedelta(days=i), 10.0 + i, 5.0, 1.0)
                                                 for i in range(5)]
    f = C.city_features(daily_rows(spark, rows)).collect()
    assert [r.city for r in f] == ["many"]


def test_label_missing_key_is_null(spark):
    df = spark.createDataFrame([(0,), (5,)], "prediction int")
    got = {r.prediction: r.l for r in df.select("prediction",
                                                 lookup_label(F.col("prediction"), CFG.cluster_labels).alias("l")).collect()}
    assert got == {0: "Humid & Mild", 5: None}


def test_best_score_ties_go_to_the_lowest_k():
    assert C.best_of([(4, 0.4123), (3, 0.4123), (5, 0.4), (6, 0.4122)]) == (3, 0.4123)


def test_scoring_errors_surface(spark, monkeypatch):
    import pytest

    from meteora.plans import inputs as I

    def broken(assigned):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(C, "silhouette_score", broken)
    with pytest.raises(RuntimeError, match="executor lost"):
        C.kmeans_sweep(C.city_features(I.daily_a(spark, SF01)), CFG)


def test_ml_sweep_is_reproducible(spark):
    from meteora.plans import inputs as I
    feats = C.city_features(I.daily_a(spark, SF01))
    a = C.kmeans_sweep(feats, CFG)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = C.kmeans_sweep(feats, CFG)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a.scores == b.scores and a.best_k == b.best_k
    assert CFG.k_min <= a.best_k <= CFG.k_max


def test_centre_rule_labels_cover_every_cluster():
    labels = C.centre_rule_labels([[1.0, 0, 1.0, 0, 0], [-1.0, 0, 1.0, 0, 0], [0.5, 0, -0.2, 0, 0],
                                   [-2.0, 0, -1.0, 0, 0]])
    assert labels == {0: "Warm & Humid", 1: "Humid & Mild", 2: "Dry", 3: "Dry"}
