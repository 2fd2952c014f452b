"""Clustering queries (adapter A: one station per user).

Oracle-checked keys use a fixed assignment — the nearest of literal centres
in scaled units — so every step after the features is deterministic SQL.
The Spark ML sweep itself is checked on rows only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.functions.numerics import round_half_up as rh
from meteora.functions.weather import lookup_label
from meteora.operators import clustering as C
from meteora.plans import inputs as I
from meteora.plans import sql_fragments as Q
from meteora.plans.catalog import register
from meteora.schemas import CLUSTER_COLUMNS, FEATURE_COLUMNS

_D = I.QCFG.stat_digits
# Literal centres in scaled units (ours). The first three are the fixed
# assignment; all eight drive the k sweep of the tie-break query.
CENTERS = [
    [1.0, 0.0, 1.0, 0.0, 0.0],
    [-1.0, 0.0, -1.0, 0.0, 0.0],
    [0.0, 1.0, 0.0, 1.0, 0.0],
    [0.0, -1.0, 0.0, -1.0, 0.0],
    [0.0, 0.0, 0.0, 0.0, 1.0],
    [0.0, 0.0, 0.0, 0.0, -1.0],
    [1.0, 1.0, -1.0, -1.0, 0.0],
    [-1.0, -1.0, 1.0, 1.0, 0.0],
]
FIXED = CENTERS[:3]
LABEL_CENTERS = CENTERS[:4]  # id 3 is outside the three-label map → NULL label
SN = [C.scaled_name(c) for c in FEATURE_COLUMNS]


def _features(spark, root):
    return C.city_features(I.daily_a(spark, root))


def _scaled(spark, root):
    """What the job's scaler makes of the features, a column each."""
    return C.scaled_columns(C.ml_scaled(_features(spark, root), I.QCFG))


# ---- SQL -------------------------------------------------------------------
_A_DAILY = [Q.OBS_A, Q.silver("obs_a", "s"), Q.daily("s", "g")]
_FEATS = f"""feats AS (
  SELECT * FROM (
    SELECT city, country,
           {Q.rh('avg(avg_temp_c)', 1)} AS mean_temp_c,
           {Q.rh('stddev_samp(avg_temp_c)', 1)} AS temp_variability,
           {Q.rh('avg(avg_humidity_pct)', 1)} AS mean_humidity,
           {Q.rh('avg(avg_wind_speed_kmh)', 1)} AS mean_wind_kmh,
           {Q.rh('avg(total_precipitation_mm)', 1)} AS mean_precip_mm
    FROM g GROUP BY city, country) t
  WHERE city IS NOT NULL AND country IS NOT NULL
    AND {' AND '.join(f'{c} IS NOT NULL AND NOT isnan({c})' for c in FEATURE_COLUMNS)}
)"""
_STATS = "fstats AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS sd_{c}" for c in FEATURE_COLUMNS) + " FROM feats)"
_SCALED = "scaled AS (SELECT city, country, " + ", ".join(
    f"CASE WHEN sd_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / sd_{c} END AS s_{c}" for c in FEATURE_COLUMNS
) + " FROM feats CROSS JOIN fstats)"


def _sql_dist(center):
    return " + ".join(f"(s_{c} - ({v!r})) * (s_{c} - ({v!r}))" for c, v in zip(FEATURE_COLUMNS, center))


def _sql_assign(name, src, centers):
    ds = [_sql_dist(c) for c in centers]
    least = f"least({', '.join(ds)})" if len(ds) > 1 else ds[0]
    case = "CASE " + " ".join(f"WHEN {d} = {least} THEN {i}" for i, d in enumerate(ds)) + " END"
    return f"{name} AS (SELECT *, CAST({case} AS INTEGER) AS prediction, {least} AS sq_distance FROM {src})"


def _sql_silhouette(name, src):
    t = ", ".join(f"sum(s_{c}) AS t_{c}" for c in FEATURE_COLUMNS)
    q = " + ".join(f"s_{c} * s_{c}" for c in FEATURE_COLUMNS)
    dot = " + ".join(f"p.s_{c} * cs.t_{c}" for c in FEATURE_COLUMNS)
    pq = " + ".join(f"p.s_{c} * p.s_{c}" for c in FEATURE_COLUMNS)
    return f"""{name}_cs AS (
  SELECT prediction AS id, count(*) AS n, {t}, sum({q}) AS q FROM {src} GROUP BY prediction
),
{name}_pd AS (
  SELECT p.city, p.country, p.prediction, cs.id, cs.n,
         ({pq}) + cs.q / cs.n - 2.0 * ({dot}) / cs.n AS d
  FROM {src} p CROSS JOIN {name}_cs cs
),
{name}_ab AS (
  SELECT city, country, prediction,
         max(CASE WHEN id = prediction THEN n END) AS own_n,
         max(CASE WHEN id = prediction THEN d * n / (n - 1) END) AS a,
         min(CASE WHEN id <> prediction THEN d END) AS b
  FROM {name}_pd GROUP BY city, country, prediction
),
{name} AS (
  SELECT city, country, prediction,
         CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1.0 - a / b
              WHEN a > b THEN b / a - 1.0 ELSE 0.0 END AS silhouette
  FROM {name}_ab
)"""


def _r(cols, round_cols):
    return ", ".join(f"{Q.rh(c, _D)} AS {c}" if c in round_cols else c for c in cols)


# ---- queries -----------------------------------------------------------------

@register("city_features", Q.with_(*_A_DAILY, _FEATS) + "SELECT * FROM feats")
def city_features_q(spark, root):
    return _features(spark, root)


@register("scaled_features", Q.with_(*_A_DAILY, _FEATS, _STATS, _SCALED)
          + f"SELECT {_r(['city', 'country', *SN], SN)} FROM scaled")
def scaled_features_q(spark, root):
    s = _scaled(spark, root)
    return s.select("city", "country", *[rh(c, _D).alias(c) for c in SN])


@register("nearest_center", Q.with_(*_A_DAILY, _FEATS, _STATS, _SCALED, _sql_assign("asg", "scaled", FIXED))
          + f"SELECT city, country, prediction, {Q.rh('sq_distance', _D)} AS sq_distance FROM asg")
def nearest_center_q(spark, root):
    a = C.assign_nearest(_scaled(spark, root), FIXED)
    return a.select("city", "country", "prediction", rh("sq_distance", _D).alias("sq_distance"))


@register("silhouette_fixed", Q.with_(*_A_DAILY, _FEATS, _STATS, _SCALED, _sql_assign("asg", "scaled", FIXED),
                                      _sql_silhouette("sil", "asg"))
          + f"SELECT {Q.rh('avg(silhouette)', _D)} AS silhouette, count(*) AS points FROM sil")
def silhouette_fixed_q(spark, root):
    a = C.assign_nearest(_scaled(spark, root), FIXED)
    score = rh(F.lit(C.silhouette_score(a)), _D)
    return a.agg(score.alias("silhouette"), F.count(F.lit(1)).alias("points"))


@register("cluster_centers", Q.with_(*_A_DAILY, _FEATS, _STATS, _SCALED, _sql_assign("asg", "scaled", FIXED))
          + "SELECT prediction, count(*) AS size, "
          + ", ".join(f"{Q.rh(f'avg(s_{c})', _D)} AS center_{c}" for c in FEATURE_COLUMNS)
          + " FROM asg GROUP BY prediction")
def cluster_centers_q(spark, root):
    c = C.centers(C.assign_nearest(_scaled(spark, root), FIXED))
    return c.select("prediction", "size", *[rh(f"center_{x}", _D).alias(f"center_{x}") for x in FEATURE_COLUMNS])


def _labels_sql():
    m = I.QCFG.cluster_labels
    return "CASE " + " ".join(f"WHEN prediction = {k} THEN '{v}'" for k, v in sorted(m.items())) + " ELSE NULL END"


_LABELLED_SQL = [*_A_DAILY, _FEATS, _STATS, _SCALED, _sql_assign("asg4", "scaled", LABEL_CENTERS),
                 f"lab AS (SELECT f.city, f.country, {', '.join('f.' + c for c in FEATURE_COLUMNS)}, "
                 f"a.prediction, {_labels_sql()} AS climate_cluster "
                 f"FROM feats f JOIN asg4 a ON f.city = a.city AND f.country = a.country)"]


def _labelled(spark, root):
    a = C.assign_nearest(_scaled(spark, root), LABEL_CENTERS)
    return (a.withColumn("climate_cluster", lookup_label(F.col("prediction"), I.QCFG.cluster_labels))
            .select(*CLUSTER_COLUMNS))


@register("cluster_labels", Q.with_(*_LABELLED_SQL) + "SELECT * FROM lab")
def cluster_labels_q(spark, root):
    """Map lookup over a four-centre assignment: id 3 has no label → NULL."""
    return _labelled(spark, root)


_SUMMARY_SQL = """SELECT climate_cluster, count(*) AS city_count,
       {t} AS avg_temp, {h} AS avg_humidity, {p} AS avg_precip
FROM {{clusters}} GROUP BY climate_cluster ORDER BY avg_temp DESC"""


@register("cluster_summary", Q.with_(*_LABELLED_SQL) + _SUMMARY_SQL.format(
    t=Q.rh("avg(mean_temp_c)", 1), h=Q.rh("avg(mean_humidity)", 1),
    p=Q.rh("avg(mean_precip_mm)", 1)).replace("{clusters}", "lab"))
def cluster_summary_q(spark, root):
    """SQL text over the cluster table (rounded averages per label)."""
    from meteora.operators.serving import cluster_summary
    return cluster_summary(spark, _labelled(spark, root))


@register("cluster_sizes", Q.with_(*_LABELLED_SQL)
          + "SELECT climate_cluster, 'cluster_size_' || replace(coalesce(climate_cluster, 'Unlabelled'), ' ', '_')"
            " AS metric, count(*) AS value FROM lab GROUP BY climate_cluster")
def cluster_sizes_q(spark, root):
    from meteora.operators.runlog import cluster_size_metrics
    return cluster_size_metrics(_labelled(spark, root))


def _sweep_sql():
    parts, names = [], []
    for k in range(I.QCFG.k_min, I.QCFG.k_max + 1):
        parts.append(_sql_assign(f"a{k}", "scaled", CENTERS[:k]))
        parts.append(_sql_silhouette(f"s{k}", f"a{k}"))
        names.append(f"SELECT {k} AS k, avg(silhouette) AS silhouette FROM s{k}")
    return parts, " UNION ALL ".join(names)


_SW_PARTS, _SW_UNION = _sweep_sql()


@register("argmax_tiebreak", Q.with_(*_A_DAILY, _FEATS, _STATS, _SCALED, *_SW_PARTS,
                                     f"sc AS ({_SW_UNION})",
                                     f"r AS (SELECT k, {Q.rh('silhouette', 4)} AS score_rounded FROM sc)")
          + "SELECT k AS best_k, score_rounded AS best_silhouette FROM r "
            "ORDER BY score_rounded DESC, k ASC LIMIT 1")
def argmax_tiebreak_q(spark, root):
    """Sweep k = 3..8 over literal-centre assignments; best rounded
    silhouette, lowest k on ties."""
    scaled = _scaled(spark, root).cache()
    try:
        scores = [(k, round(C.silhouette_score(C.assign_nearest(scaled, CENTERS[:k])), I.QCFG.silhouette_digits))
                  for k in range(I.QCFG.k_min, I.QCFG.k_max + 1)]
    finally:
        scaled.unpersist()
    return spark.createDataFrame([C.best_of(scores)], "best_k int, best_silhouette double")


@register("kmeans_sweep")
def kmeans_sweep_q(spark, root):
    """Spark ML sweep: (k, rounded silhouette, chosen) — rows only."""
    res = C.kmeans_sweep(_features(spark, root), I.QCFG)
    rows = [(k, s, k == res.best_k) for k, s in res.scores]
    return spark.createDataFrame(rows, "k int, silhouette double, chosen boolean")


@register("city_clusters")
def city_clusters_q(spark, root):
    """Gold cluster table from the best Spark ML model — rows only."""
    res = C.kmeans_sweep(_features(spark, root), I.QCFG)
    return C.label_clusters(res.clustered, I.QCFG)


_KS = range(I.QCFG.k_min, I.QCFG.k_max + 1)


@register("kmeans_sweep_facts", Q.with_(*_A_DAILY, _FEATS)
          + "SELECT k, (SELECT count(*) FROM feats) AS points, true AS scored, 1::BIGINT AS chosen_in_all "
            f"FROM (VALUES {', '.join(f'({k})' for k in _KS)}) v(k)")
def kmeans_sweep_facts_q(spark, root):
    """What holds for any fit: every k is scored in [-1, 1] over all points,
    one k is chosen and none scores higher."""
    feats = _features(spark, root)
    res = C.kmeans_sweep(feats, I.QCFG)
    top = max(s for _, s in res.scores)
    rows = [(k, -1 <= s <= 1, sum(1 for q, t in res.scores if q == res.best_k and t == top)) for k, s in res.scores]
    points = res.clustered.select(F.count(F.lit(1))).first()[0]
    return (spark.createDataFrame(rows, "k int, scored boolean, chosen_in_all long")
            .select("k", F.lit(points).alias("points"), "scored", "chosen_in_all"))


@register("city_clusters_facts", Q.with_(*_A_DAILY, _FEATS)
          + "SELECT city, country, mean_temp_c, true AS id_in_range, true AS nearest FROM feats")
def city_clusters_facts_q(spark, root):
    """Every station has one cluster id of the chosen model, that of its
    nearest centre."""
    res = C.kmeans_sweep(_features(spark, root), I.QCFG)
    centres = [[float(x) for x in c] for c in res.model.clusterCenters()]
    d = C.assign_nearest(C.scaled_columns(res.clustered.withColumnRenamed("prediction", "fitted")), centres)
    return d.select("city", "country", "mean_temp_c", F.col("fitted").between(0, res.best_k - 1).alias("id_in_range"),
                    (F.col("fitted") == F.col("prediction")).alias("nearest"))


@register("cluster_table_sorted", Q.with_(*_LABELLED_SQL) + """SELECT city, climate_cluster, mean_temp_c,
  row_number() OVER (PARTITION BY climate_cluster ORDER BY mean_temp_c, city, country)::BIGINT AS nth,
  dense_rank() OVER (ORDER BY climate_cluster NULLS FIRST)::BIGINT AS nth_cluster FROM lab""")
def cluster_table_sorted_q(spark, root):
    """The published two-key order, read off the rows as they come: the place
    of a row in its cluster and of the cluster in the table."""
    from pyspark.sql import Window
    came = C.sorted_table(_labelled(spark, root)).withColumn("_at", F.monotonically_increasing_id())
    heads = came.groupBy("climate_cluster").agg(F.min("_at").alias("_head"))  # a row for each label
    heads = heads.select(F.col("climate_cluster").alias("_label"), F.row_number().over(Window.orderBy("_head"))
                         .cast("long").alias("nth_cluster"))
    nth = F.row_number().over(Window.partitionBy("climate_cluster").orderBy("_at")).cast("long")
    return (came.join(F.broadcast(heads), F.col("climate_cluster").eqNullSafe(F.col("_label")))
            .select("city", "climate_cluster", "mean_temp_c", nth.alias("nth"), "nth_cluster"))
