"""F1-F6 semantic invariants (the model has no SQL form)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from helpers import weekdays
from marketlens.operators import forecast as fc
from marketlens.sources.holidays import holiday_dimension
from pyspark.sql import functions as F


def _series(spark, kind="trend_season", n=700, seed=0, tickers=("A",), code="GBP"):
    rng = np.random.default_rng(seed)
    rows = []
    for t in tickers:
        for i, x in enumerate(weekdays("2018-01-01", n)):
            day = dt.date.fromisoformat(x)
            doy = day.timetuple().tm_yday
            if kind == "flat":
                y = 50.0
            else:
                y = 100 + 0.05 * i + 8 * np.sin(2 * np.pi * doy / 365.25) + rng.normal(0, 0.5)
            rows.append((t, day, float(y), code))
    return spark.createDataFrame(rows, "ticker string, ds date, y double, currency_code string")


LIN = fc.ModelParams(growth="linear")
LOG = fc.ModelParams(growth="logistic", cap=400.0, floor=0.0)


@pytest.mark.parametrize("params", [LIN, LOG], ids=["linear", "logistic"])
def test_forecast_shape_and_bounds(spark, params):
    train = _series(spark, tickers=("A", "B"))
    out = fc.forecast(train, 30, params).toPandas()
    assert list(out.columns) == [f.name for f in fc.FORECAST.fields]
    fut = out[out.is_future]
    assert len(fut) == 2 * 22 or len(fut) == 2 * 21 or len(fut) == 2 * 20
    assert (pd.to_datetime(fut.ds).dt.weekday <= 4).all()
    assert (out.yhat_lower <= out.yhat + 1e-9).all() and (out.yhat <= out.yhat_upper + 1e-9).all()
    if params.growth == "logistic":
        assert (out.trend >= params.floor).all() and (out.trend <= params.cap).all()


def test_forecast_deterministic(spark):
    train = _series(spark)
    a = fc.forecast(train, 20, LOG).orderBy("ds").toPandas()
    b = fc.forecast(train, 20, LOG).orderBy("ds").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_recovers_trend_and_season(spark):
    train = _series(spark, n=900)
    out = fc.forecast(train, 0, LIN).toPandas()
    resid = out.y - out.yhat
    assert float(np.sqrt(np.mean(resid ** 2))) < 1.0  # noise sd is 0.5


@pytest.mark.parametrize("params", [LIN, LOG], ids=["linear", "logistic"])
def test_holdout_beats_last_value(spark, params):
    train = _series(spark, n=800, seed=3)
    g = fc.grid_search(train, [{"changepoint_prior_scale": 0.05,
                                "seasonality_prior_scale": 10.0}], holdout=60,
                       base=params).first()
    assert g.holdout_mae <= g.last_value_mae


def test_flat_series_and_cap_below_data(spark):
    out = fc.forecast(_series(spark, "flat", n=100), 10,
                      fc.ModelParams(growth="logistic", cap=40.0, floor=0.0)).toPandas()
    assert np.isfinite(out.yhat).all() and (out.trend <= 40.0).all()


def test_holidays_follow_currency(spark):
    gb = _series(spark, n=300, tickers=("G",), code="GBP")
    hk = _series(spark, n=300, tickers=("H",), code="HKD")
    us = _series(spark, n=300, tickers=("U",), code="EUR")
    cal = fc.future_calendar(gb.unionByName(hk).unionByName(us), 10)
    got = {(r.ticker, str(r.ds)): r.holiday for r in cal.where("holiday is not null").collect()}
    assert got[("G", "2018-12-26")] == "Boxing Day"
    assert got[("G", "2018-03-30")] == "Good Friday"  # Easter 2018 was 1 April
    assert got[("H", "2018-10-01")] == "National Day"
    assert got[("U", "2018-11-22")] == "Thanksgiving"
    assert got[("U", "2018-05-28")] == "Memorial Day"
    assert ("U", "2018-12-26") not in got
    assert got[("H", "2018-12-26")] == "The first weekday after Christmas Day"
    # 2018-11-11 was a Sunday: observed on Monday 12th (US)
    assert got[("U", "2018-11-12")] == "Veterans Day (observed)"


def test_grid_search_one_row_per_ticker(spark):
    train = _series(spark, n=300, tickers=("A", "B"))
    out = fc.grid_search(train, holdout=20, base=LIN).collect()
    assert sorted(r.ticker for r in out) == ["A", "B"]
    assert all(r.grid_id in range(len(fc.DEFAULT_GRID)) for r in out)


def test_grid_takes_any_parameter_and_limits(spark):
    train = _series(spark, n=200)
    limits = spark.createDataFrame([("A", 300.0, 0.0)], "ticker string, cap double, floor double")
    out = fc.grid_search(train, [{"growth": "linear"}, {"growth": "logistic", "yearly_order": 3}],
                         base=LOG, limits=limits).first()
    assert out.n_holdout == 20 and out.holdout_mae >= 0 and "growth" in out.params


@pytest.mark.parametrize("growth", ["flat", "bogus"])
def test_unknown_growth_is_refused(growth):
    with pytest.raises(ValueError, match="growth"):
        fc.ModelParams(growth=growth)


def test_observations_beyond_the_cap_are_kept(spark):
    rows = [("A", dt.date.fromisoformat(x), float(100 + 20 * np.sin(2 * np.pi * i / 260)), "GBP")
            for i, x in enumerate(weekdays("2015-01-01", 1040))]
    train = spark.createDataFrame(rows, "ticker string, ds date, y double, currency_code string")
    out = fc.forecast(train, 0, fc.ModelParams(growth="logistic", cap=110.0, floor=0.0)).toPandas()
    assert float((out.y - out.yhat).abs().mean()) < 0.5


def test_ticker_without_prices_keeps_its_calendar(spark):
    train = spark.createDataFrame([("A", dt.date(2024, 1, 2), None, "GBP")],
                                  "ticker string, ds date, y double, currency_code string")
    out = fc.forecast(train, 5, LIN).toPandas()
    assert len(out) > 1 and out.yhat.isna().all()


def test_published_holidays(spark):
    years = spark.range(2009, 2025).select(F.col("id").alias("year"))
    got = {(r.country, str(r.date)): r.holiday for r in holiday_dimension(years).collect()}
    assert got[("US", "2010-12-31")] == "New Year's Day (observed)"
    for day in ("2012-06-04", "2012-06-05", "2020-05-08", "2022-06-02", "2022-06-03", "2022-09-19", "2023-05-08"):
        assert ("GB", day) in got, day
    for day in ("2012-05-28", "2020-05-04", "2022-05-30"):
        assert ("GB", day) not in got, day
    for day in ("2013-02-13", "2018-02-16", "2018-04-05", "2021-04-06", "2022-02-01", "2023-09-30", "2024-10-11"):
        assert ("HK", day) in got, day


def test_linear_trend_and_scores(spark):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), 10.0 + 2.0 * i, "GBP")
            for i in range(50)]
    train = spark.createDataFrame(rows, "ticker string, ds date, y double, currency_code string")
    lt = fc.linear_trend(train, "2020-01-01").first()
    assert lt.slope == pytest.approx(2.0) and lt.intercept == pytest.approx(10.0)
    s = fc.score(train, fc.linear_forecast(train, "2020-01-01", 5)).first()
    assert s.mae == pytest.approx(0.0, abs=1e-9)
