import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from meteora.config import PipelineConfig
from meteora.operators import forecasting as FC
from tests.helpers import NOW, daily_rows

CFG = PipelineConfig(now=NOW)
D0 = dt.datetime(2024, 1, 1)


def _series(city, n, gap_every=None):
    rows, day = [], 0
    for i in range(n):
        if gap_every and i and i % gap_every == 0:
            day += 3
        rows.append((city, "C", D0 + dt.timedelta(days=day), 10.0 + 0.05 * i + (i % 7) * 0.3, 5.0, 1.0))
        day += 1
    return rows


def test_row_floor(spark):
    d = daily_rows(spark, _series("s59", 59) + _series("s60", 60))
    got = {r.city for r in FC.trend_forecast(d, CFG).collect()}
    assert got == {"s60"}
    st = FC.status_counts(FC.trend_status(d, CFG)).first()
    assert (st.cities_succeeded, st.cities_failed, st.cities_skipped) == (1, 0, 1)


def test_gap_days_still_seven_future_days(spark):
    rows = _series("g", 80, gap_every=10)
    last = max(r[2] for r in rows)
    d = daily_rows(spark, rows)
    for f in (FC.trend_forecast(d, CFG), FC.seasonal_forecast(d, CFG), FC.additive_forecast(d, CFG)):
        days = sorted(r.forecast_date for r in f.collect())
        assert days == [last + dt.timedelta(days=h) for h in range(1, 8)]


def test_interval_contains_prediction(spark):
    d = daily_rows(spark, _series("a", 400) + _series("b", 120))
    for f in (FC.trend_forecast(d, CFG), FC.additive_forecast(d, CFG)):
        bad = f.filter(~((F.col("predicted_low_c") <= F.col("predicted_temp_c"))
                         & (F.col("predicted_temp_c") <= F.col("predicted_high_c")))).count()
        assert bad == 0
        assert f.count() == 14


def test_additive_failure_isolated(spark):
    rows = _series("ok", 90) + [("bad", "C", D0 + dt.timedelta(days=i), float("nan"), 5.0, 1.0) for i in range(90)]
    runs = {r.city: r.status for r in FC.additive_model_runs(daily_rows(spark, rows), CFG).collect()}
    assert runs["ok"] == "ok" and runs["bad"] == "failed"


def test_additive_model_artefact(spark):
    rows = _series("m", 120) + _series("short", 10)
    models = FC.additive_models(daily_rows(spark, rows), CFG).collect()
    assert [m.city for m in models] == ["m"]
    m = models[0]
    assert m.status == "ok" and m.training_rows == 120
    assert len(m.changepoints) == FC.N_CHANGEPOINTS
    assert len(m.coefficients) == 2 + FC.N_CHANGEPOINTS + 2 * FC.YEARLY_ORDER
    assert m.residual_var >= 0


def test_l1_solver_meets_the_optimality_conditions():
    rng = np.random.default_rng(3)
    for n, lam in ((1, 0.1), (5, 0.5), (25, 0.05), (25, 3.0), (40, 20.0)):
        x = rng.normal(size=(200, n)).cumsum(0) / 20  # strongly correlated, as hinges are
        s, c = x.T @ x + 1e-9 * np.eye(n), x.T @ rng.normal(size=200)
        d = FC.l1_quadratic(s, c, lam)
        g = s @ d - c
        tol = 1e-6 * max(1, np.abs(c).max())
        assert np.all(np.abs(g) <= lam + tol)
        assert np.all(np.abs(g[d != 0] + lam * np.sign(d[d != 0])) <= tol)


def _bent(n=1800, at=720, before=0.02, after=-0.02, seed=1):
    rng = np.random.default_rng(seed)
    i = np.arange(n)
    y = 10 + before * i + (after - before) * np.maximum(i - at, 0) + rng.normal(0, 0.3, n)
    return [("bent", "C", D0 + dt.timedelta(days=int(k)), float(v), 5.0, 1.0) for k, v in zip(i, y)]


def test_laplace_prior_finds_planted_changepoints(spark):
    m = FC.additive_models(daily_rows(spark, _bent()), CFG).first()
    cps, deltas = np.array(m.changepoints) * m.span_days, np.array(m.coefficients[2:2 + FC.N_CHANGEPOINTS])
    strong = np.abs(deltas) > 0.1 * np.abs(deltas).max()
    assert (deltas == 0).sum() >= FC.N_CHANGEPOINTS // 2  # ridge leaves no delta at zero
    assert strong.sum() <= 4 and np.abs(cps[strong] - 720).max() <= 75
    planted = -0.04 * m.span_days / m.y_scale
    assert abs(deltas[strong].sum() - planted) < 0.15 * abs(planted)
    # the same posterior with a normal prior spreads the bend over all of them
    X, y = np.random.default_rng(0).normal(size=(50, 6)).cumsum(0), np.arange(50.0)
    ridge = FC.map_fit(X, y, 1, 3, 0.05, 5, 10, 0.5, solve=lambda s, c, lam: np.linalg.solve(s + lam * np.eye(3), c))[0]
    assert np.all(ridge != 0)


def test_interval_covers_what_was_planted(spark):
    rows, rng = [], np.random.default_rng(2)
    for c in range(12):
        y = 15 + 8 * np.sin(2 * np.pi * np.arange(800) / 365.25) + rng.normal(0, 1.0, 800)
        rows += [(f"s{c}", "C", D0 + dt.timedelta(days=i), float(v), 5.0, 1.0) for i, v in enumerate(y)]
    r = FC.held_out_coverage(daily_rows(spark, rows), CFG).first()
    assert (r.stations, r.days) == (12, 84) and 0.68 <= r.coverage <= 0.92


def test_scores_of_stored_models_equal_the_fit(spark):
    runs = FC.additive_model_runs(daily_rows(spark, _bent() + _series("g", 90, gap_every=10) + _series("s", 9)), CFG)
    runs = spark.createDataFrame(runs.collect(), runs.schema)
    fit = {(r.city, r.forecast_date): r.yhat for r in FC.run_points(runs).collect()}
    got = {(r.city, r.forecast_date): r.yhat for r in FC.score_models(FC.models_of(runs), CFG).collect()}
    assert got.keys() == fit.keys() and len(got) == 14
    assert all(abs(got[k] - fit[k]) <= 1e-9 * max(1, abs(fit[k])) for k in fit)
    assert FC.score_models(FC.models_of(runs), CFG)._jdf.queryExecution().toString().count("Python") == 0
