"""Station climate clustering.

Relational part (all Catalyst expressions, oracle-checkable):
  city_features → standardize → assign_nearest / silhouette / centers.
Model part (Spark ML): VectorAssembler → StandardScaler → KMeans sweep over
k, scored by ClusteringEvaluator, best k by rounded silhouette (lowest k on
ties), labels by literal map.

Small per-cluster statistics (k rows) reach the per-station rows as scalar
subqueries: Spark evaluates them once and inlines them, so there is no
cross join and nothing grows with the number of stations.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.numerics import round_half_up as rh
from meteora.functions.weather import lookup_label
from meteora.schemas import CLUSTER_COLUMNS, FEATURE_COLUMNS


def city_features(daily: DataFrame) -> DataFrame:
    """One row per (city, country) from the rounded daily values; rows with
    a NULL or NaN feature (e.g. one-day history → NULL stddev) are dropped."""
    return (
        daily.groupBy("city", "country")
        .agg(
            rh(F.avg("avg_temp_c"), 1).alias("mean_temp_c"),
            rh(F.stddev_samp("avg_temp_c"), 1).alias("temp_variability"),
            rh(F.avg("avg_humidity_pct"), 1).alias("mean_humidity"),
            rh(F.avg("avg_wind_speed_kmh"), 1).alias("mean_wind_kmh"),
            rh(F.avg("total_precipitation_mm"), 1).alias("mean_precip_mm"),
        )
        .dropna()
    )


def stable_layout(df: DataFrame, partitions: int, keys=("city", "country")) -> DataFrame:
    """Hash layout on the key, sorted inside each partition: the same rows
    in the same partitions whatever the upstream plan, so K-Means init and
    scaler sums repeat exactly between runs."""
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def station_partitions(n_rows: int, cfg: PipelineConfig) -> int:
    """Partitions for a one-row-per-station frame: proportional to the
    station count (a data property, so the layout stays deterministic)."""
    return max(1, -(-n_rows // cfg.stations_per_partition))


def scaled_name(c: str) -> str:
    return f"s_{c}"


def _sqdist(xs: list[Column], center) -> Column:
    acc = None
    for x, c in zip(xs, center):
        d = (x - F.lit(float(c))) * (x - F.lit(float(c)))
        acc = d if acc is None else acc + d
    return acc


def _nearest(scaled_cols: list[Column], centers: list[list[float]]):
    """(prediction, squared distance) expressions: nearest centre by squared
    Euclidean distance, lowest index on ties."""
    ds = [_sqdist(scaled_cols, ctr) for ctr in centers]
    best = F.least(*ds) if len(ds) > 1 else ds[0]
    pred = None
    for i, d in enumerate(ds):
        pred = F.when(d == best, F.lit(i)) if pred is None else pred.when(d == best, F.lit(i))
    return pred.cast("int"), best


def assign_nearest(scaled: DataFrame, centers: list[list[float]], cols=FEATURE_COLUMNS) -> DataFrame:
    """Nearest centre by squared Euclidean distance; lowest index on ties."""
    pred, best = _nearest([F.col(scaled_name(c)) for c in cols], centers)
    return scaled.withColumn("prediction", pred).withColumn("sq_distance", best)


def centers(assigned: DataFrame, cols=FEATURE_COLUMNS, pred: str = "prediction") -> DataFrame:
    """Cluster centres in scaled units plus sizes."""
    return assigned.groupBy(pred).agg(
        F.count(F.lit(1)).alias("size"),
        *[F.avg(scaled_name(c)).alias(f"center_{c}") for c in cols],
    )


def best_of(scores: list[tuple]) -> tuple:
    """The (k, score) with the best rounded score, the lowest k on ties."""
    return max(scores, key=lambda s: (s[1], -s[0]))


# ---- Spark ML sweep ---------------------------------------------------------

@dataclass
class SweepResult:
    scores: list  # [(k, rounded silhouette)]
    best_k: int
    best_score: float
    model: object
    scaled: DataFrame
    clustered: DataFrame


def ml_scaled(features: DataFrame, cfg: PipelineConfig) -> DataFrame:
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    from meteora.operators.materialize import materialize

    # Station-sized frame read by the scaler fit and every K-Means fit:
    # checkpoint it once (lineage cut on shared storage), then lay it out.
    feats = materialize(features)
    laid = stable_layout(feats, station_partitions(feats.count(), cfg))
    assembled = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features_raw").transform(laid)
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True)
    return scaler.fit(assembled).transform(assembled)


def scaled_columns(scaled: DataFrame) -> DataFrame:
    """The scaler's output as one column a feature, beside the vector."""
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array(F.col("features"))
    return scaled.select("*", *[F.get(v, F.lit(i)).alias(scaled_name(c)) for i, c in enumerate(FEATURE_COLUMNS)])


def silhouette_score(assigned: DataFrame) -> float:
    """Mean silhouette of an assignment by the sweep's evaluator."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    return ClusteringEvaluator(featuresCol="features").evaluate(assigned)


def kmeans_sweep(features: DataFrame, cfg: PipelineConfig, parallelism: int | None = None) -> SweepResult:
    """Fit K-Means for k in [k_min, k_max] on the cached scaled features,
    score each with the silhouette evaluator, keep the best rounded score
    (lowest k on ties). Fits run from a small thread pool; each fit is itself
    distributed. The chosen model is reused, not refitted."""
    from pyspark.ml.clustering import KMeans

    scaled = ml_scaled(features, cfg).cache()
    scaled.count()  # materialise before the fits run concurrently
    def fit(k):
        model = KMeans(featuresCol="features", k=k, seed=cfg.kmeans_seed).fit(scaled)
        assigned = model.transform(scaled)
        if assigned.select("prediction").distinct().count() < 2:
            return k, float("-inf"), model  # the silhouette needs two clusters
        return k, round(silhouette_score(assigned), cfg.silhouette_digits), model

    ks = list(range(cfg.k_min, cfg.k_max + 1))
    with ThreadPoolExecutor(max_workers=max(1, parallelism or len(ks))) as ex:
        fitted = list(ex.map(fit, ks))
    best_k, best_score = best_of([(k, s) for k, s, _ in fitted])
    model = next(m for k, _, m in fitted if k == best_k)
    if best_score == float("-inf"):
        raise ValueError("no k in the sweep could be scored (too few stations)")
    scaled.unpersist()
    clustered = model.transform(scaled)
    return SweepResult([(k, s) for k, s, _ in fitted], best_k, best_score, model, scaled, clustered)


def label_clusters(clustered: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Hand-written id → label map; ids outside the map get NULL."""
    return clustered.withColumn(
        "climate_cluster", lookup_label(F.col("prediction"), cfg.cluster_labels)
    ).select(*CLUSTER_COLUMNS)


def centre_rule_labels(centers, temp_idx: int = 0, humidity_idx: int = 2) -> dict:
    """Optional rule (ours) for any k: a centre's scaled temperature and
    humidity against the overall mean (0 in scaled units) pick one of the
    published label texts, so no cluster is left unlabelled when k exceeds
    the hand-written map. Warm+humid → "Warm & Humid", cool+humid →
    "Humid & Mild", dry otherwise."""
    out = {}
    for i, c in enumerate(centers):
        t, h = float(c[temp_idx]), float(c[humidity_idx])
        out[i] = "Warm & Humid" if (h >= 0 and t >= 0) else ("Humid & Mild" if h >= 0 else "Dry")
    return out


def label_clusters_by_centres(clustered: DataFrame, model) -> DataFrame:
    """Labels from ``centre_rule_labels`` of the fitted model's centres."""
    labels = centre_rule_labels(model.clusterCenters())
    return clustered.withColumn("climate_cluster", lookup_label(F.col("prediction"), labels)) \
        .select(*CLUSTER_COLUMNS)


def sorted_table(clusters: DataFrame) -> DataFrame:
    """The cluster table in its published order: label, then temperature."""
    return clusters.orderBy("climate_cluster", "mean_temp_c", "city", "country")
