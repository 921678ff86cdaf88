"""F1 for linear growth by normal equations, and F3 by rolling origins.

The linear model y = trend + yearly and weekly season + holidays is a ridge
regression, so all a fit needs from a ticker's history are the sums X'X, X'y
and y'y.  They are one JVM aggregate that combines before its shuffle: a
ticker's series may be of any length and is never collected.  One row per
ticker is then solved, in batches of tickers, and the predictions are a dot
product per calendar row, again in the JVM.

The rolling-origin check takes the linear trend (F6) as of several cutoffs of
each ticker: running regressions in one window, looked up at the cutoffs, and
errors by days ahead.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .forecast import model_input

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class LinearGrowth:
    """Changepoints lie evenly over the first `changepoint_range` of a history."""

    n_changepoints: int = 8
    changepoint_range: float = 0.8
    yearly_order: int = 4
    weekly_order: int = 2
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    interval_width: float = 0.95

    @property
    def names(self) -> list[str]:
        out = ["one", "t", *[f"bend{k}" for k in range(1, self.n_changepoints + 1)]]
        for kind, order in (("year", self.yearly_order), ("week", self.weekly_order)):
            out += [f"{f}_{kind}{k}" for k in range(1, order + 1) for f in ("sin", "cos")]
        return [*out, "holiday"]

    @property
    def bends(self) -> list[float]:
        n = self.n_changepoints
        return [self.changepoint_range * k / (n + 1) for k in range(1, n + 1)]

    @property
    def trend_terms(self) -> int:
        return 2 + self.n_changepoints

    def penalty(self, noise: float) -> np.ndarray:
        """Ridge weights: the noise over each term's prior variance."""
        season = 2 * (self.yearly_order + self.weekly_order)
        scales = ([self.changepoint_prior_scale] * self.n_changepoints
                  + [self.seasonality_prior_scale] * season + [self.holidays_prior_scale])
        return np.array([1e-8, 1e-8, *[noise / s**2 for s in scales]]) + 1e-10


def with_features(rows: DataFrame, model: LinearGrowth) -> DataFrame:
    """Calendar rows with `span`, the days of the ticker's history, `ahead`, the
    days after it, and a column `x_<name>` per term of the model.  Tickers
    without an observation have no rows."""
    seen = rows.where(F.col("y").isNotNull() & ~F.col("is_future"))
    ends = seen.groupBy("ticker").agg(F.min("ds").alias("_first"), F.max("ds").alias("_last"))
    df = rows.join(ends, "ticker").withColumn("span", F.greatest(F.datediff("_last", "_first"), F.lit(1)).cast("double"))
    df = (df.withColumn("x_one", F.lit(1.0)).withColumn("x_t", F.datediff("ds", "_first") / F.col("span"))
            .withColumn("ahead", F.greatest(F.datediff("ds", "_last"), F.lit(0)).cast("double")))
    days = F.datediff("ds", F.to_date(F.lit("1970-01-01"))).cast("double")
    new: dict[str, Column] = {}
    for k, s in enumerate(model.bends, 1):
        new[f"x_bend{k}"] = F.greatest(F.col("x_t") - F.lit(s), F.lit(0.0))
    for kind, period, order in (("year", 365.25, model.yearly_order), ("week", 7.0, model.weekly_order)):
        for k in range(1, order + 1):
            angle = days * F.lit(2.0 * math.pi * k / period)
            new[f"x_sin_{kind}{k}"], new[f"x_cos_{kind}{k}"] = F.sin(angle), F.cos(angle)
    new["x_holiday"] = F.col("holiday").isNotNull().cast("double")
    return df.withColumns(new).drop("_first", "_last")


def normal_sums(featured: DataFrame, model: LinearGrowth) -> DataFrame:
    """Per ticker: `n`, `top` (greatest |y|), `yy`, `xy` (X'y) and `xx`, the upper
    triangle of X'X row by row."""
    x = [F.col(f"x_{n}") for n in model.names]
    p = len(x)
    seen = featured.where(F.col("y").isNotNull() & ~F.col("is_future"))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = seen.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs("y")).alias("top"), F.sum(F.col("y") * F.col("y")).alias("yy"),
        *[F.sum(x[i] * F.col("y")).alias(f"_b{i}") for i in range(p)],
        *[F.sum(x[i] * x[j]).alias(f"_a{i}_{j}") for i, j in pairs])
    return sums.select("ticker", "n", "top", "yy", F.array(*[f"_b{i}" for i in range(p)]).alias("xy"),
                       F.array(*[f"_a{i}_{j}" for i, j in pairs]).alias("xx"))


def solve(n: float, top: float, yy: float, xy, xx, model: LinearGrowth) -> tuple[np.ndarray, float]:
    """(coefficients, residual deviation) from the sums, in the units of y.

    Two rounds: the noise in the penalties is a tenth of the variance of y
    first, and then that of the residuals."""
    p = len(xy)
    a = np.zeros((p, p))
    a[np.triu_indices(p)] = xx
    a = a + np.triu(a, 1).T
    scale = max(float(top), 1e-9)
    b, total = np.asarray(xy, dtype=float) / scale, float(yy) / scale**2
    mean = b[0] / n
    noise = max(total / n - mean * mean, 1e-12) * 0.1
    for _ in range(2):
        beta = np.linalg.solve(a + np.diag(model.penalty(noise)), b)
        noise = max((total - 2 * beta @ b + beta @ a @ beta) / n, 1e-12)
    return beta * scale, math.sqrt(noise) * scale


def coefficients(sums: DataFrame, model: LinearGrowth) -> DataFrame:
    """(ticker, beta, sigma): one small system per row, in batches of tickers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [solve(r.n, r.top, r.yy, r.xy, r.xx, model) for r in batch.itertuples()]
            yield pd.DataFrame({"ticker": batch["ticker"], "beta": [b for b, _ in out], "sigma": [s for _, s in out]})

    return sums.mapInPandas(run, "ticker string, beta array<double>, sigma double")


def _dot(names: list[str], beta: str, first: int = 0) -> Column:
    out = F.lit(0.0)
    for i, n in enumerate(names, first):
        out = out + F.col(f"x_{n}") * F.col(beta)[i]
    return out


def linear_growth_forecast(train: DataFrame, periods: int = 90, model: LinearGrowth = LinearGrowth(),
                           default_country: str = "US") -> DataFrame:
    """F1 with linear growth: prediction, interval and trend of every ticker's
    history and `periods` days after it (same columns as `forecast`).  The
    interval is the normal one of the residuals, widening with the days ahead."""
    featured = with_features(model_input(train, periods, default_country), model)
    fitted = coefficients(normal_sums(featured, model), model)
    z = NormalDist().inv_cdf(0.5 + model.interval_width / 2)
    names, k = model.names, model.trend_terms
    df = featured.join(fitted, "ticker").withColumn("trend", _dot(names[:k], "beta"))
    df = df.withColumn("yhat", F.col("trend") + _dot(names[k:], "beta", k))
    half = F.lit(z) * F.col("sigma") * F.sqrt(1.0 + F.col("ahead") / F.col("span"))
    return df.select("ticker", "ds", "y", "yhat", (F.col("yhat") - half).alias("yhat_lower"),
                     (F.col("yhat") + half).alias("yhat_upper"), "trend", "is_future")


# ------------------------------------------------------------ rolling origins --

def cutoffs(train: DataFrame, initial: int, period: int, horizon: int) -> DataFrame:
    """(ticker, k, cutoff): from `horizon` days before a ticker's last
    observation back, every `period` days, while at least `initial` days of
    history lie before."""
    if min(initial, period, horizon) < 1:
        raise ValueError("initial, period and horizon must be at least one day")
    ends = train.where(F.col("y").isNotNull()).groupBy("ticker").agg(F.min("ds").alias("first"), F.max("ds").alias("last"))
    room = F.datediff("last", "first") - horizon - initial
    back = ends.where(room >= 0).withColumn("k", F.explode(F.sequence(F.lit(0), F.floor(room / period).cast("int"))))
    return back.select("ticker", "k", F.date_sub("last", F.lit(horizon) + F.col("k") * period).alias("cutoff"))


def trend_as_of(train: DataFrame, cuts: DataFrame, origin: str) -> DataFrame:
    """(ticker, k, cutoff, slope, intercept): the linear trend of the history up
    to each cutoff.  Running regressions over a ticker's days, one window; the
    cutoffs are sorted in among them, so no history is repeated per cutoff."""
    x = F.datediff("ds", F.to_date(F.lit(origin))).cast("double")
    seen = train.where(F.col("y").isNotNull()).select("ticker", "ds", "y", x.alias("x"), F.lit(None).cast("int").alias("k"))
    marks = cuts.select("ticker", F.col("cutoff").alias("ds"), F.lit(None).cast("double").alias("y"),
                        F.lit(None).cast("double").alias("x"), "k")
    # By day, and of one day the observation first: a cutoff sees its own day.
    upto = (Window.partitionBy("ticker").orderBy("ds", F.col("k").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = seen.unionByName(marks).select("ticker", "k", F.col("ds").alias("cutoff"),
                                         F.regr_slope("y", "x").over(upto).alias("slope"),
                                         F.regr_intercept("y", "x").over(upto).alias("intercept"))
    return run.where(F.col("k").isNotNull())


def origin_errors(train: DataFrame, origin: str, initial: int, period: int, horizon: int, smooth: int = 7) -> DataFrame:
    """F3 + A8: errors of the linear trend by days ahead of its cutoff, over all
    cutoffs of a ticker: `n`, `mae`, `rmse`, `mape`, and `mae_smooth` over the
    last `smooth` days ahead.

    A day can lie ahead of horizon / period cutoffs at most; their numbers
    follow from the dates, so cutoffs and days meet in an equality join.
    """
    cuts = cutoffs(train, initial, period, horizon)
    fits = trend_as_of(train, cuts, origin)
    last = cuts.where("k = 0").select("ticker", F.date_add("cutoff", horizon).alias("_last"))
    seen = train.where(F.col("y").isNotNull()).join(last, "ticker")
    to_end = F.datediff("_last", "ds")
    low = F.greatest(F.lit(0), F.ceil((to_end + 1 - horizon) / period).cast("int"))
    high = F.floor(to_end / period).cast("int")
    days = seen.where(low <= high).select("ticker", "ds", "y", F.explode(F.sequence(low, high)).alias("k"))
    x = F.datediff("ds", F.to_date(F.lit(origin))).cast("double")
    err = days.join(fits, ["ticker", "k"]).select(
        "ticker", F.datediff("ds", "cutoff").alias("horizon"), "y",
        (F.col("y") - F.col("intercept") - F.col("slope") * x).alias("e"))
    by = err.groupBy("ticker", "horizon").agg(
        F.count("e").alias("n"), F.sum(F.abs("e")).alias("_abs"), F.sum(F.col("e") * F.col("e")).alias("_sq"),
        F.sum(F.abs("e") / F.greatest(F.abs("y"), F.lit(np.finfo(float).eps))).alias("_share"))
    near = Window.partitionBy("ticker").orderBy("horizon").rangeBetween(-(smooth - 1), Window.currentRow)
    return by.select("ticker", "horizon", "n", F.try_divide("_abs", "n").alias("mae"),
                     F.sqrt(F.try_divide("_sq", "n")).alias("rmse"), F.try_divide("_share", "n").alias("mape"),
                     F.try_divide(F.sum("_abs").over(near), F.sum("n").over(near)).alias("mae_smooth"))
