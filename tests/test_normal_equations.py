"""F1 with linear growth by normal equations, F3 by rolling origins."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.operators import forecast as fc
from marketlens.operators import normal_equations as ne


def _train(spark, n=500, tickers=("A", "B")):
    rng = np.random.default_rng(4)
    days = pd.bdate_range("2021-01-04", periods=n)
    rows = []
    for i, t in enumerate(tickers):
        x = np.arange(n)
        y = 100 * (i + 1) + 0.05 * x + 4 * np.sin(2 * np.pi * days.dayofyear / 365.25) + rng.normal(0, 0.5, n)
        rows += [(t, d.date(), float(v), "GBP" if i else "USD") for d, v in zip(days, y)]
    rows += [(tickers[0], dt.date(2020, 1, 1), None, "USD"), ("none", dt.date(2021, 1, 4), None, "USD")]
    return spark.createDataFrame(rows, "ticker string, ds date, y double, currency_code string")


def _numpy_fit(rows, model):
    """The same ridge regression on the same terms, from the rows themselves."""
    x, y = np.array([[r[f"x_{n}"] for n in model.names] for r in rows]), np.array([r.y for r in rows])
    scale = max(np.abs(y).max(), 1e-9)
    ys, noise = y / scale, max(np.var(y / scale), 1e-12) * 0.1
    for _ in range(2):
        root = np.sqrt(model.penalty(noise))
        beta = np.linalg.lstsq(np.vstack([x, np.diag(root)]), np.concatenate([ys, np.zeros(len(root))]), rcond=None)[0]
        noise = max(np.mean((ys - x @ beta) ** 2), 1e-12)
    return beta * scale, np.sqrt(noise) * scale


@pytest.mark.parametrize("model", [ne.LinearGrowth(), ne.LinearGrowth(n_changepoints=2, yearly_order=1, weekly_order=0)])
def test_normal_equations_equal_a_numpy_fit(spark, model):
    train = _train(spark)
    featured = ne.with_features(fc.model_input(train, 0), model).cache()
    got = {r.ticker: r for r in ne.coefficients(ne.normal_sums(featured, model), model).collect()}
    assert set(got) == {"A", "B"}
    for t in got:
        rows = featured.where((F.col("ticker") == t) & F.col("y").isNotNull()).collect()
        beta, sigma = _numpy_fit(rows, model)
        x = np.array([[r[f"x_{n}"] for n in model.names] for r in rows])
        assert np.allclose(x @ np.array(got[t].beta), x @ beta, rtol=1e-6)
        assert abs(got[t].sigma - sigma) < 1e-4 * sigma


def test_forecast_follows_trend_and_season_and_covers_the_data(spark):
    out = ne.linear_growth_forecast(_train(spark), periods=30)
    assert out.columns == [f.name for f in fc.FORECAST.fields]
    rows = out.where("ticker != 'none' and ds >= '2021-01-04'").toPandas()
    past = rows[~rows["is_future"]]
    err = (past["y"] - past["yhat"]).abs()
    inside = ((past["y"] >= past["yhat_lower"]) & (past["y"] <= past["yhat_upper"])).mean()
    assert err.mean() < 0.6 and 0.9 < inside < 1
    future = rows[rows["is_future"]]
    assert len(future) > 30 and future["yhat"].notna().all()
    width = (future["yhat_upper"] - future["yhat_lower"]).groupby(future["ticker"]).apply(lambda s: s.is_monotonic_increasing)
    assert width.all()


def test_the_sums_are_one_aggregate_and_no_series_meets_in_python(spark):
    plan = ne.linear_growth_forecast(_train(spark))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" in plan


def test_one_observation_and_flat_series(spark):
    train = spark.createDataFrame([("one", dt.date(2024, 1, 2), 5.0, None),
                                   *[("flat", dt.date(2024, 1, 1) + dt.timedelta(days=i), 7.0, "GBP") for i in range(40)]],
                                  "ticker string, ds date, y double, currency_code string")
    out = ne.linear_growth_forecast(train, periods=5).where("y is not null").collect()
    assert all(abs(r.yhat - r.y) < 1e-3 for r in out) and {r.ticker for r in out} == {"one", "flat"}


def _brute_errors(rows, initial, period, horizon, smooth):
    out = {}
    for t in {r[0] for r in rows}:
        own = sorted((d, y) for name, d, y, _ in rows if name == t and y is not None)
        if not own:
            continue
        first, last = own[0][0], own[-1][0]
        found = {}
        cut = last - dt.timedelta(days=horizon)
        while cut >= first + dt.timedelta(days=initial):
            known = [(d.toordinal(), y) for d, y in own if d <= cut]
            slope, intercept = np.polyfit([d for d, _ in known], [y for _, y in known], 1)
            for d, y in own:
                if cut < d <= cut + dt.timedelta(days=horizon):
                    found.setdefault((d - cut).days, []).append(abs(y - intercept - slope * d.toordinal()))
            cut -= dt.timedelta(days=period)
        for h, e in found.items():
            near = [x for k, v in found.items() if h - smooth < k <= h for x in v]
            out[t, h] = (len(e), np.mean(e), np.mean(near))
    return out


@pytest.mark.parametrize("initial,period,horizon", [(200, 30, 45), (365, 7, 20), (100, 60, 10), (5000, 1, 1)])
def test_rolling_origin_errors_equal_brute_force(spark, initial, period, horizon):
    train = _train(spark, 420)
    got = ne.origin_errors(train, "2021-01-01", initial, period, horizon, smooth=5).collect()
    want = _brute_errors([tuple(r) for r in train.collect()], initial, period, horizon, 5)
    assert {(r.ticker, r.horizon) for r in got} == set(want)
    for r in got:
        n, mae, near = want[r.ticker, r.horizon]
        assert r.n == n and abs(r.mae - mae) < 1e-6 and abs(r.mae_smooth - near) < 1e-6


def test_cutoffs_need_positive_days(spark):
    with pytest.raises(ValueError):
        ne.cutoffs(_train(spark, 10), 10, 0, 5)
