"""Observation-derived columns: feels-like, condition text, z-scores,
anomaly type and severity."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteora.functions.numerics import _c, round_half_up, safe_div

# ---- fixed values: wind-chill polynomial coefficients ---------------------
WC_A, WC_B, WC_C, WC_D, WC_EXP = 13.12, 0.6215, 11.37, 0.3965, 0.16

# ---- fixed values: weather code -> condition text, first match wins --------
# (low, high, label), inclusive bounds; anything else (and NULL) is "Unknown".
CONDITION_RANGES = [
    (0, 0, "Clear sky"),
    (1, 1, "Mainly clear"),
    (2, 2, "Partly cloudy"),
    (3, 3, "Overcast"),
    (45, 48, "Foggy"),
    (51, 55, "Drizzle"),
    (61, 65, "Rain"),
    (71, 75, "Snow"),
    (80, 82, "Rain showers"),
    (95, 99, "Thunderstorm"),
]
UNKNOWN_CONDITION = "Unknown"


def feels_like(temp="temperature_c", wind="wind_speed_kmh") -> Column:
    """Wind-chill style apparent temperature, rounded to 1 dp. Applied at
    every temperature; wind 0 drops the wind terms, negative wind gives NaN,
    NULL gives NULL."""
    t, v = _c(temp), _c(wind)
    vp = F.pow(v, F.lit(WC_EXP))
    return round_half_up(F.lit(WC_A) + F.lit(WC_B) * t - F.lit(WC_C) * vp + F.lit(WC_D) * t * vp, 1)


def condition_label(code="weather_code") -> Column:
    code = _c(code)
    expr = None
    for lo, hi, label in CONDITION_RANGES:
        cond = (code == lo) if lo == hi else code.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(UNKNOWN_CONDITION)


def zscore(x, mean, std) -> Column:
    """(x - mean) / std; NULL when std is 0 or NULL."""
    return safe_div(_c(x) - _c(mean), _c(std))


def anomaly_type(z_temp, z_wind, z_precip, threshold: float) -> Column:
    """Hot > cold > windy > rainy. Low-wind / low-precip outliers get NULL."""
    zt, zw, zp = _c(z_temp), _c(z_wind), _c(z_precip)
    t_flag = F.abs(zt) > threshold
    w_flag = F.abs(zw) > threshold
    p_flag = F.abs(zp) > threshold
    return (
        F.when(t_flag & (zt > 0), "Unusually hot")
        .when(t_flag & (zt < 0), "Unusually cold")
        .when(w_flag & (zw > 0), "Unusually windy")
        .when(p_flag & (zp > 0), "Unusually rainy")
        .otherwise(F.lit(None).cast("string"))
    )


def severity(z_temp, z_wind, z_precip, extreme: float = 3.5, high: float = 2.5) -> Column:
    """Temperature first, then wind, then precipitation; the cut-offs are
    their own constants, not the flagging threshold."""
    expr = None
    for z in (_c(z_temp), _c(z_wind), _c(z_precip)):
        for cut, label in ((extreme, "Extreme"), (high, "High")):
            cond = F.abs(z) > cut
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(None).cast("string"))


def lookup_label(key, labels: dict) -> Column:
    """Literal map lookup; a key missing from the map yields NULL."""
    if not labels:
        return F.lit(None).cast("string")
    m = F.create_map([F.lit(x) for x in chain(*sorted(labels.items()))])
    return F.try_element_at(m, _c(key))
