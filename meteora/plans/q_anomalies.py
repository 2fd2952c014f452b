"""Anomaly queries: baseline, snapshot, z-scores, flags, final table."""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.functions.numerics import round_half_up as rh
from meteora.operators import anomalies as A
from meteora.plans import inputs as I
from meteora.plans import sql_fragments as Q
from meteora.plans.catalog import register
from meteora.schemas import ANOMALY_COLUMNS

_CFG_A = I.QCFG_A
_CFG_B15 = I.QCFG.with_(zscore_threshold=1.5)
_D = I.QCFG.stat_digits
_ANOM_OUT = [c for c in ANOMALY_COLUMNS if c != "detected_at"]

_B_DAILY = [Q.OBS_B, Q.silver("obs_b", "s"), Q.daily("s", "g")]
_A_DAILY = [Q.OBS_A, Q.silver("obs_a", "s"), Q.daily("s", "g")]

_BASE_STATS = ["hist_mean_temp", "hist_std_temp", "hist_mean_wind", "hist_std_wind",
               "hist_mean_precip", "hist_std_precip"]
_Z = ["zscore_temp", "zscore_wind", "zscore_precip"]


def _rounded_spark(df, cols):
    return [rh(c, _D).alias(c) if c in cols else F.col(c) for c in df.columns]


def _rounded_sql(cols_all, cols_round):
    return ", ".join(Q.rh(c, _D) + f" AS {c}" if c in cols_round else c for c in cols_all)


_BASE_COLS = ["city", "country", *_BASE_STATS, "history_days"]


@register("baseline", Q.with_(*_B_DAILY, Q.baseline("g", "b", I.QCFG.min_history_days))
          + f"SELECT {_rounded_sql(_BASE_COLS, _BASE_STATS)} FROM b")
def baseline_q(spark, root):
    b = A.baseline(I.daily_b(spark, root), I.QCFG)
    return b.select(*_rounded_spark(b, _BASE_STATS))


@register("today_snapshot", Q.with_(*_B_DAILY, Q.snapshot("g", "t")) + "SELECT * FROM t")
def today_snapshot_q(spark, root):
    return A.today_snapshot(I.daily_b(spark, root))


_ZCOLS = ["city", "country", "date", "today_temp", "today_wind", "today_precip",
          *_BASE_STATS, "history_days", *_Z]


@register("zscores", Q.with_(*_B_DAILY, Q.zscores("g", "z", I.QCFG.min_history_days))
          + f"SELECT {_rounded_sql(_ZCOLS, _BASE_STATS + _Z)} FROM z")
def zscores_q(spark, root):
    z = A.zscores(I.daily_b(spark, root), I.QCFG)
    return z.select(*_rounded_spark(z, _BASE_STATS + _Z))


@register("anomaly_flags", Q.with_(*_B_DAILY, Q.zscores("g", "z", I.QCFG.min_history_days),
                                   Q.flags("z", "f", 1.5))
          + "SELECT city, country, date, temp_anomaly, wind_anomaly, precip_anomaly, is_anomaly FROM f")
def anomaly_flags_q(spark, root):
    """All stations with history, flags at 1.5 sigma (NULL flags kept)."""
    f = A.anomaly_flags(A.zscores(I.daily_b(spark, root), _CFG_B15), _CFG_B15)
    return f.select("city", "country", "date", "temp_anomaly", "wind_anomaly",
                    "precip_anomaly", "is_anomaly")


@register("anomalies", Q.with_(*_A_DAILY, Q.zscores("g", "z", _CFG_A.min_history_days),
                               Q.flags("z", "f", _CFG_A.zscore_threshold), Q.anomalies("f", "a", 2.5))
          + "SELECT * FROM a")
def anomalies_q(spark, root):
    """Adapter A at the published 2.5 sigma, history floor 20 days."""
    return A.anomalies(I.daily_a(spark, root, _CFG_A), _CFG_A).select(*_ANOM_OUT)


@register("anomalies_b", Q.with_(*_B_DAILY, Q.zscores("g", "z", I.QCFG.min_history_days),
                                 Q.flags("z", "f", 1.5), Q.anomalies("f", "a", 1.5))
          + "SELECT * FROM a")
def anomalies_b_q(spark, root):
    """Adapter B at 1.5 sigma; severity keeps its own 2.5 / 3.5 cut-offs."""
    return A.anomalies(I.daily_b(spark, root, _CFG_B15), _CFG_B15).select(*_ANOM_OUT)


@register("top_anomalies", Q.with_(*_A_DAILY, Q.zscores("g", "z", _CFG_A.min_history_days),
                                   Q.flags("z", "f", 1.5), Q.anomalies("f", "a", 1.5))
          + "SELECT * FROM a ORDER BY zscore_temp DESC NULLS LAST, city LIMIT 20")
def top_anomalies_q(spark, root):
    """Preview of the anomaly table: first 20 by z desc (top-k report)."""
    cfg = _CFG_A.with_(zscore_threshold=1.5)
    a = A.anomalies(I.daily_a(spark, root, cfg), cfg).select(*_ANOM_OUT)
    return a.orderBy(F.col("zscore_temp").desc_nulls_last(), F.col("city")).limit(I.QCFG.preview_rows)
