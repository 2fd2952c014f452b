"""Seven-day temperature forecasts per station.

Three forms on the daily mean temperature, all distributed by station:

* ``trend_forecast`` — least squares line per station from the regr_*
  aggregates (one partial+final aggregation, no per-row join);
  interval ± z·σ_residual.
* ``seasonal_forecast`` — the trend plus the station's mean residual for the
  calendar month of each forecast day (window aggregates by station).
* ``additive_forecast`` — ``applyInPandas`` per station: piecewise-linear
  trend with changepoints plus yearly Fourier terms, the MAP fit of the
  additive model of Taylor & Letham (2018): Laplace prior on the changepoint
  deltas, normal priors on the rest, half-normal prior on the noise. The
  interval comes from sampled future trends. Each group is one station's
  daily series, bounded by the length of its history.
* ``score_models`` — forecasts from the stored model table alone, as array
  expressions: no refit and no Python.

Stations with fewer than ``min_training_rows`` days are skipped; a station
whose fit fails is reported as failed and the others continue.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.functions.numerics import round_half_up as rh
from meteora.functions.numerics import stamp
from meteora.schemas import FORECAST_COLUMNS


def interval_z(width: float) -> float:
    """Two-sided normal quantile for an interval of the given coverage."""
    return NormalDist().inv_cdf(0.5 + width / 2.0)


def _x(col: str = "date") -> Column:
    """Day number of a timestamp (days since 1970-01-01)."""
    return F.datediff(F.col(col).cast("date"), F.lit("1970-01-01").cast("date")).cast("double")


def series(daily: DataFrame) -> DataFrame:
    return daily.select("city", "country", "date", F.col("avg_temp_c").alias("y"))


def series_extent(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count_distinct("city").alias("cities"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("rows"),
    )


def eligibility(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Rows per station; eligible when at least ``min_training_rows``.
    Country is the station's first (earliest-day) country."""
    return (
        daily.groupBy("city")
        .agg(
            F.min_by("country", F.struct("date", "country")).alias("country"),
            F.count(F.lit(1)).alias("training_rows"),
        )
        .withColumn("eligible", F.col("training_rows") >= cfg.min_training_rows)
    )


def trend_coefficients(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Per eligible station: n, mean day, mean y, slope, residual σ, last day.
    σ² = (Syy − Sxy²/Sxx) / (n − 2) from the centred regression sums."""
    y, x = F.col("avg_temp_c"), _x("date")
    agg = daily.groupBy("city").agg(
        F.min_by("country", F.struct("date", "country")).alias("country"),
        F.count(F.lit(1)).alias("n"),
        F.regr_count(y, x).alias("n_xy"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_avgy(y, x).alias("mean_y"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
        F.max("date").alias("last_date"),
    )
    sse = F.greatest(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    sigma = F.sqrt(F.try_divide(sse, (F.col("n_xy") - 2).cast("double")))
    return (
        agg.filter(F.col("n") >= cfg.min_training_rows)
        .withColumn("sigma", sigma)
        .select("city", "country", "n", "mean_x", "mean_y", "slope", "sigma", "last_date")
    )


def _horizon(coef: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The next ``forecast_days`` days after each station's last day,
    whatever gaps lie inside the history."""
    days = F.sequence(F.lit(1), F.lit(cfg.forecast_days))
    return coef.withColumn("h", F.explode(days)).withColumn(
        "forecast_date", F.date_add(F.col("last_date").cast("date"), F.col("h")).cast("timestamp_ntz"))


def _finish(df: DataFrame, cfg: PipelineConfig, yhat: Column, low: Column, high: Column) -> DataFrame:
    return df.select(
        "forecast_date",
        rh(yhat, 1).alias("predicted_temp_c"),
        rh(low, 1).alias("predicted_low_c"),
        rh(high, 1).alias("predicted_high_c"),
        "city", "country",
        stamp(cfg.now).alias("generated_at"),
    ).select(*FORECAST_COLUMNS)


def trend_points(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """city, country, forecast_date with the unrounded ``yhat`` and half
    interval ``half``."""
    coef = trend_coefficients(daily, cfg).filter(F.col("slope").isNotNull())
    yhat = F.col("mean_y") + F.col("slope") * (_x("forecast_date") - F.col("mean_x"))
    return _horizon(coef, cfg).select(
        "city", "country", "forecast_date", yhat.alias("yhat"),
        (F.lit(interval_z(cfg.interval_width)) * F.col("sigma")).alias("half"))


def trend_forecast(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    y, half = F.col("yhat"), F.col("half")
    return _finish(trend_points(daily, cfg), cfg, y, y - half, y + half)


def seasonal_forecast(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Trend plus the mean residual of the forecast day's calendar month
    (0 for a month the station has never seen)."""
    y, x = F.col("avg_temp_c"), _x("date")
    # one row a station, so the line goes to the days and no window holds a whole series
    coef = trend_coefficients(daily, cfg).filter(F.col("slope").isNotNull())
    line = coef.select("city", "mean_x", "mean_y", "slope")
    resid = (
        daily.select("city", "date", "avg_temp_c").join(line, "city")
        .groupBy("city", F.month("date").alias("month"))
        .agg(F.avg(y - (F.col("mean_y") + F.col("slope") * (x - F.col("mean_x")))).alias("month_resid"))
    )
    h = _horizon(coef, cfg).withColumn("month", F.month("forecast_date"))
    j = h.join(resid, ["city", "month"], "left")
    yhat = (F.col("mean_y") + F.col("slope") * (_x("forecast_date") - F.col("mean_x"))
            + F.coalesce(F.col("month_resid"), F.lit(0.0)))
    half = F.lit(interval_z(cfg.interval_width)) * F.col("sigma")
    return _finish(j, cfg, yhat, yhat - half, yhat + half)


def forecast_metrics(daily: DataFrame, points: DataFrame) -> DataFrame:
    """Per station: last actual value, first forecast value, mean interval
    width over the horizon, each from unrounded ``points`` (city, country,
    forecast_date, yhat, half) and rounded to 2 dp."""
    last = daily.groupBy("city").agg(F.max_by("avg_temp_c", "date").alias("last_actual_temp"),
                                     F.count(F.lit(1)).alias("training_rows"))
    fm = points.groupBy("city", "country").agg(
        F.min_by("yhat", "forecast_date").alias("first_forecast_temp"),
        F.avg(2 * F.col("half")).alias("avg_uncertainty_c"),
    )
    return fm.join(last, "city").select(
        "city", "country", "training_rows",
        rh("last_actual_temp", 2).alias("last_actual_temp"),
        rh("first_forecast_temp", 2).alias("first_forecast_temp"),
        rh("avg_uncertainty_c", 2).alias("avg_uncertainty_c"),
    )


# ---- additive model (applyInPandas) ----------------------------------------

ADDITIVE_SCHEMA = ("city string, country string, forecast_date timestamp_ntz, yhat double, "
                   "yhat_lower double, yhat_upper double, status string, training_rows bigint, error string, "
                   "first_day date, last_day date, span_days double, y_scale double, changepoints array<double>, "
                   "coefficients array<double>, residual_var double")
MODEL_COLUMNS = ["city", "country", "training_rows", "status", "first_day", "last_day", "span_days", "y_scale",
                 "changepoints", "coefficients", "residual_var"]
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY_ORDER = 10
YEAR_DAYS = 365.25
#: Prior scales of the published model: base line, seasonality, noise; and
#: how many future trends are sampled for the interval.
BASE_SCALE, SEASON_SCALE, NOISE_SCALE = 5.0, 10.0, 0.5
TREND_SAMPLES = 1000


def l1_quadratic(s, c, lam):
    """argmin over d of d's d / 2 - c'd + lam * sum|d|, by an active set:
    signs are guessed, the quadratic is solved for them, and a step that
    would change a sign stops at the best crossing. Exact up to rounding;
    ``s`` is positive definite."""
    import numpy as np

    n = len(c)
    d, sign = np.zeros(n), np.zeros(n)
    tol = 1e-10 * max(1.0, float(np.abs(c).max(initial=0.0)))
    value = lambda x: x @ s @ x / 2 - c @ x + lam * np.abs(x).sum()
    for _ in range(50 * (n + 1)):
        g = s @ d - c
        off = np.where(sign == 0, np.abs(g) - lam, -np.inf)
        j = int(off.argmax()) if n else 0
        on = np.flatnonzero(sign)
        settled = not len(on) or np.abs(g[on] + lam * sign[on]).max() <= tol
        if settled:
            if not n or off[j] <= tol:
                return d
            sign[j] = -np.sign(g[j])
            on = np.flatnonzero(sign)
        new = d.copy()
        new[on] = np.linalg.solve(s[np.ix_(on, on)], c[on] - lam * sign[on])
        cross = on[(np.sign(d[on]) != 0) & (np.sign(new[on]) != np.sign(d[on]))]
        steps = [1.0, *sorted(d[cross] / (d[cross] - new[cross]))]
        best = min((value(x), i) for i, x in enumerate(d + t * (new - d) for t in steps))[1]
        moved = d + steps[best] * (new - d)
        if best:
            moved[cross[np.abs(moved[cross]) <= 1e-14 * (1 + np.abs(d[cross]))]] = 0.0
        d = moved
        sign = np.where(np.abs(d) > 1e-14, np.sign(d), 0.0)
        d[sign == 0] = 0.0
    return d


def map_fit(X, y, base: int, deltas: int, laplace: float, base_scale: float, season_scale: float,
            noise_scale: float, solve=l1_quadratic):
    """(coefficients, noise variance) of the posterior mode: columns are
    ``base`` line terms, ``deltas`` changepoint terms with a Laplace prior,
    then seasonal terms. For a given noise the other columns are eliminated,
    which leaves a quadratic with an L1 term in the deltas; the noise follows
    in closed form, and both alternate until the noise stands still."""
    import numpy as np

    n, k = X.shape
    is_delta = np.zeros(k, bool)
    is_delta[base:base + deltas] = True
    ridge = np.full(k, 1.0 / season_scale ** 2)
    ridge[:base] = 1.0 / base_scale ** 2
    gram, xy, yy = X.T @ X, X.T @ y, float(y @ y)
    var = max(float(np.var(y)), 1e-12)
    beta = np.zeros(k)
    for _ in range(100):
        A = gram[np.ix_(~is_delta, ~is_delta)] + var * np.diag(ridge[~is_delta])
        B = gram[np.ix_(~is_delta, is_delta)]
        rest = np.linalg.solve(A, np.column_stack([B, xy[~is_delta]]))
        S = gram[np.ix_(is_delta, is_delta)] - B.T @ rest[:, :-1]
        S = (S + S.T) / 2 + 1e-12 * max(1.0, float(np.trace(S))) * np.eye(deltas)
        beta[is_delta] = solve(S, xy[is_delta] - B.T @ rest[:, -1], var / laplace)
        beta[~is_delta] = rest[:, -1] - rest[:, :-1] @ beta[is_delta]
        sse = max(yy - 2 * beta @ xy + beta @ gram @ beta, 0.0)
        # mode of n log(s) + sse / 2s^2 + s^2 / 2noise_scale^2 in s^2
        w = noise_scale ** -2
        new = (-n + np.sqrt(n * n + 4 * w * sse)) / (2 * w)
        new = max(float(new), 1e-12)
        if abs(new - var) <= 1e-9 * var:
            break
        var = new
    return beta, var


def make_additive_fn(cfg: PipelineConfig):
    """Build the per-station function for ``applyInPandas``: the horizon's
    rows of one fit, the first of them with the model artefact, or one row
    with the reason of the failure. Everything it needs is captured in the
    closure, so executors need no package install."""
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    horizon, min_rows, width = cfg.forecast_days, cfg.min_training_rows, cfg.interval_width
    prior = cfg.changepoint_prior_scale
    n_cp, cp_range, order, year, samples = N_CHANGEPOINTS, CHANGEPOINT_RANGE, YEARLY_ORDER, YEAR_DAYS, TREND_SAMPLES
    scales, mode = (BASE_SCALE, SEASON_SCALE, NOISE_SCALE), map_fit

    def design(t, cps, day):
        import numpy as np

        cols = [np.ones_like(t), t]
        cols += [np.maximum(t - c, 0.0) for c in cps]
        for k in range(1, order + 1):
            ang = 2.0 * np.pi * k * day / year
            cols += [np.sin(ang), np.cos(ang)]
        return np.column_stack(cols)

    def fit(pdf):
        import numpy as np
        import pandas as pd

        ds = pd.to_datetime(pdf["date"]).to_numpy(dtype="datetime64[D]")
        day = ds.astype("int64").astype(float)
        y = pdf["y"].to_numpy(dtype=float)
        n = len(y)
        t0, span = day[0], max(day[-1] - day[0], 1.0)
        t = (day - t0) / span
        scale = max(np.nanmax(np.abs(y)), 1e-9)
        ys = y / scale
        ok = ~np.isnan(ys)
        if not np.isfinite(scale) or not ok.any():
            raise FloatingPointError("no finite values")
        cps = np.quantile(t[: max(int(np.ceil(n * cp_range)), 2)],
                          np.linspace(0, 1, n_cp + 2)[1:-1])
        beta, var = mode(design(t, cps, day)[ok], ys[ok], 2, len(cps), prior, *scales)
        if not (np.all(np.isfinite(beta)) and np.isfinite(var)):
            raise FloatingPointError("non-finite fit")
        return dict(day=day, t=t, t0=t0, span=span, scale=scale, cps=cps, beta=beta, s2=var)

    def trend_shifts(rng, m, ft):
        """Sampled departures of the future trend from its last slope: new
        changepoints come at the rate of the old ones, with Laplace deltas
        of the old ones' mean size."""
        import numpy as np

        deltas = m["beta"][2:2 + len(m["cps"])]
        size = float(np.mean(np.abs(deltas))) if len(deltas) else 0.0
        ahead = max(float(ft[-1] - 1.0), 0.0)
        counts = rng.poisson(len(deltas) * ahead, samples)
        most = int(counts.max(initial=0))
        at = 1.0 + rng.uniform(0.0, max(ahead, 1e-12), (samples, most))
        delta = rng.laplace(0.0, size + 1e-8, (samples, most)) * (np.arange(most) < counts[:, None])
        return (delta[:, :, None] * np.maximum(ft - at[:, :, None], 0.0)).sum(1)

    def forecast_rows(pdf, city, country, n, m):
        import zlib

        import numpy as np
        import pandas as pd

        fday = m["day"][-1] + np.arange(1, horizon + 1, dtype=float)
        ft = (fday - m["t0"]) / m["span"]
        yhat = design(ft, m["cps"], fday) @ m["beta"]
        rng = np.random.default_rng(zlib.crc32(f"{city}".encode()))  # reruns agree
        paths = yhat + trend_shifts(rng, m, ft) + rng.normal(0.0, np.sqrt(m["s2"]), (samples, horizon))
        low, high = np.quantile(paths, [0.5 - width / 2, 0.5 + width / 2], axis=0)
        low, high = np.minimum(low, yhat), np.maximum(high, yhat)
        scale = m["scale"]
        return pd.DataFrame({
            "city": city, "country": country,
            "forecast_date": pd.to_datetime(fday.astype("int64").astype("datetime64[D]")),
            "yhat": yhat * scale, "yhat_lower": low * scale,
            "yhat_upper": high * scale, "status": "ok", "training_rows": n,
        })

    def run(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("date")
        city, country, n = pdf["city"].iloc[0], pdf["country"].iloc[0], len(pdf)

        def status_row(status, error=None):
            return pd.DataFrame([dict(city=city, country=country, status=status, training_rows=n, error=error,
                                      forecast_date=pd.NaT, yhat=np.nan, yhat_lower=np.nan, yhat_upper=np.nan,
                                      first_day=None, last_day=None, span_days=np.nan, y_scale=np.nan,
                                      changepoints=None, coefficients=None, residual_var=np.nan)])

        if n < min_rows:
            return status_row("skipped")
        try:
            m = fit(pdf)
            out = forecast_rows(pdf, city, country, n, m)
            if not np.all(np.isfinite(out[["yhat", "yhat_lower", "yhat_upper"]].to_numpy())):
                raise FloatingPointError("non-finite forecast")
        except (ArithmeticError, ValueError, np.linalg.LinAlgError) as e:
            # one station's data must not stop the others; its reason is kept
            return status_row("failed", f"{type(e).__name__}: {e}")
        first = lambda value, none: [value] + [none] * (len(out) - 1)
        date = lambda day: first(pd.Timestamp(int(day), unit="D").date(), None)
        return out.assign(
            error=None, first_day=date(m["t0"]), last_day=date(m["day"][-1]),
            span_days=first(float(m["span"]), np.nan), y_scale=first(float(m["scale"]), np.nan),
            changepoints=first([float(c) for c in m["cps"]], None),
            coefficients=first([float(b) for b in m["beta"]], None), residual_var=first(float(m["s2"]), np.nan))

    return run


def score_models(models: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """city, country, forecast_date, yhat of the horizon behind each stored
    model's last day, from the artefact alone: the design row is built and
    multiplied with the coefficients by array expressions."""
    days = F.sequence(F.lit(1), F.lit(cfg.forecast_days))
    h = models.withColumn("h", F.explode(days)).withColumn("_day", F.date_add("last_day", F.col("h")))
    t = F.datediff("_day", "first_day") / F.col("span_days")
    day = _x("_day")
    angles = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(YEARLY_ORDER)), lambda k: F.array(
        F.sin(2.0 * F.pi() * k * day / YEAR_DAYS), F.cos(2.0 * F.pi() * k * day / YEAR_DAYS))))
    bends = F.transform("changepoints", lambda c: F.greatest(t - c, F.lit(0.0)))
    row = F.concat(F.array(F.lit(1.0), t), bends, angles)
    dot = F.aggregate(F.zip_with(row, F.col("coefficients"), lambda x, b: x * b), F.lit(0.0), lambda acc, x: acc + x)
    return h.select("city", "country", F.col("_day").cast("timestamp_ntz").alias("forecast_date"),
                    (dot * F.col("y_scale")).alias("yhat"))


def held_out_coverage(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One row: stations fitted without their last ``forecast_days`` days,
    how many of the days held out have a forecast, and the share of those
    that lies in the interval."""
    last = daily.groupBy("city").agg(F.max("date").alias("_last"))
    d = daily.join(last, "city")
    cut = F.date_sub(F.col("_last").cast("date"), cfg.forecast_days)
    before = d.filter(F.col("date").cast("date") <= cut).drop("_last")
    after = d.filter(F.col("date").cast("date") > cut).select("city", F.col("date").alias("forecast_date"), "avg_temp_c")
    points = run_points(additive_model_runs(before, cfg))
    both = points.join(after, ["city", "forecast_date"])
    inside = F.col("avg_temp_c").between(F.col("yhat_lower"), F.col("yhat_upper"))
    return both.agg(F.count_distinct("city").alias("stations"), F.count(F.lit(1)).alias("days"),
                    F.avg(inside.cast("double")).alias("coverage"))


def models_of(runs: DataFrame) -> DataFrame:
    """Per-station model artefact out of ``additive_model_runs``:
    changepoints, coefficients (intercept, slope, changepoint deltas, Fourier
    pairs), residual variance."""
    return runs.filter(F.col("first_day").isNotNull()).select(*MODEL_COLUMNS)


def additive_models(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return models_of(additive_model_runs(daily, cfg))


def additive_model_runs(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """All per-station outcomes: 7 forecast rows for ``ok`` stations, one
    status row for ``skipped`` / ``failed`` ones.

    Stations below the row floor are filtered out before the Python step
    (their ``skipped`` rows come from the eligibility aggregate), so only
    stations that will be fitted are shipped to pandas."""
    e = eligibility(daily, cfg)
    fit_keys = e.filter("eligible").select("city")
    s = series(daily).join(fit_keys, "city", "left_semi")
    fitted = s.groupBy("city").applyInPandas(make_additive_fn(cfg), ADDITIVE_SCHEMA)
    skipped = e.filter(~F.col("eligible")).select(
        "city", "country", F.lit(None).cast("timestamp_ntz").alias("forecast_date"),
        F.lit(None).cast("double").alias("yhat"), F.lit(None).cast("double").alias("yhat_lower"),
        F.lit(None).cast("double").alias("yhat_upper"), F.lit("skipped").alias("status"),
        F.col("training_rows").cast("bigint").alias("training_rows"))
    return fitted.unionByName(skipped, allowMissingColumns=True)


def run_points(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == "ok").withColumn("half", (F.col("yhat_upper") - F.col("yhat_lower")) / 2)


def additive_forecast(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return finish_points(run_points(additive_model_runs(daily, cfg)), cfg)


def finish_points(points: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Forecast table rows of ``run_points``."""
    return _finish(points, cfg, F.col("yhat"), F.col("yhat_lower"), F.col("yhat_upper"))


def status_counts(runs: DataFrame) -> DataFrame:
    """Succeeded / failed / skipped station counts (skipped count in neither
    of the first two)."""
    per = runs.groupBy("city").agg(F.first("status").alias("status"))
    return per.agg(
        F.count_if(F.col("status") == "ok").alias("cities_succeeded"),
        F.count_if(F.col("status") == "failed").alias("cities_failed"),
        F.count_if(F.col("status") == "skipped").alias("cities_skipped"),
    )


def trend_status(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Status per station for the trend model: skipped below the row floor,
    failed when the slope is undefined (one distinct day), else ok."""
    e = eligibility(daily, cfg)
    c = trend_coefficients(daily, cfg).select("city", "slope")
    j = e.join(c, "city", "left")
    return j.select(
        "city", "country", "training_rows",
        F.when(~F.col("eligible"), "skipped").when(F.col("slope").isNull(), "failed")
        .otherwise("ok").alias("status"))


def forecast_label(col: str = "predicted_temp_c") -> Column:
    """Point label text, e.g. '12.5°C'."""
    return F.concat(F.col(col).cast("string"), F.lit("°C"))

