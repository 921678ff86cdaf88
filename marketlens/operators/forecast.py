"""Per-ticker forecasting.

Spark does the relational work - training window, future calendar, holiday
join, linear baseline, scoring, choosing the best grid point - and a grouped
map fits one small numpy model per (ticker[, grid point]).  A group is one
ticker's daily series, so its size is bounded by the number of calendar days
(bars are unique on (ticker, date), rule Q1), never by the data volume.

The model follows the published decomposable form y = trend + yearly season
+ holidays (Taylor & Letham, "Forecasting at Scale", 2018): a piecewise
trend with potential changepoints over the first 80% of history, Fourier
terms of order 10 (and weekly terms of order 3), one effect per holiday, Gaussian priors as ridge
penalties.  `logistic` growth bends the trend between floor and cap and is
fitted by damped Gauss-Newton.  Intervals come from the residual quantile,
so the output is deterministic.
"""

from __future__ import annotations

import json
import sys
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import is_weekday
from ..schemas import FORECAST
from ..sources.holidays import country_for_currency, holiday_table

# The grouped-map functions run in Python workers that need not have this
# package installed: ship this module's code with the closures.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


GROWTHS = ("logistic", "linear")


@dataclass(frozen=True)
class ModelParams:
    growth: str = "logistic"
    cap: float = 1000.0
    floor: float = 0.0
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    yearly_order: int = 10
    weekly_order: int = 3
    interval_width: float = 0.95

    def __post_init__(self):
        if self.growth not in GROWTHS:
            raise ValueError(f"unknown growth {self.growth!r}; known are {GROWTHS}")
        if self.growth == "logistic" and not self.cap > self.floor:
            raise ValueError("cap must exceed floor")


# ---------------------------------------------------------------- Spark side --

def training_frame(master: DataFrame, start_date: str, tickers: list[str] | None = None,
                   price: str = "close") -> DataFrame:
    """L2 + L3: rows strictly after `start_date`, optionally some tickers.

    The model's y is the native close.  A ticker's currency comes along for
    the holiday rule (A10: a column of the instrument dimension).
    """
    df = master.where(F.col("date") > F.to_date(F.lit(start_date)))
    if tickers is not None:
        df = df.where(F.col("ticker").isin(tickers))
    return df.select("ticker", F.col("date").alias("ds"), F.col(price).alias("y"), "currency_code")


def linear_trend(train: DataFrame, origin: str) -> DataFrame:
    """least-squares line y = intercept + slope * (days since origin)."""
    x = F.datediff("ds", F.to_date(F.lit(origin))).cast("double")
    return train.groupBy("ticker").agg(
        F.count("y").alias("n"),
        F.regr_slope("y", x).alias("slope"),
        F.regr_intercept("y", x).alias("intercept"))


def _calendar_rows(train: DataFrame, periods: int, default_country: str) -> DataFrame:
    """History rows (with y) plus `periods` future days per ticker, weekdays
    only, each with its country's holiday.

    Training rows are unique on (ticker, ds) (rule Q1), so history rows are
    taken as they are and only the per-ticker summary (one row per ticker)
    feeds the future days; no join brings y back.  The holiday table is of fixed
    size, so its broadcast is bounded.
    """
    # A ticker has one currency (A10, rule Q5); of several, the future days
    # follow the greatest, so they are never doubled.
    per = (train.groupBy("ticker")
                .agg(F.max("ds").alias("_last"), F.max("currency_code").alias("_code")))
    hist = train.select("ticker", "ds", "y", F.lit(False).alias("is_future"),
                        F.col("currency_code").alias("_code"))
    fut = per.select("ticker",
                     F.explode(F.sequence(F.date_add("_last", 1),
                                          F.date_add("_last", periods))).alias("ds"),
                     F.lit(None).cast("double").alias("y"), F.lit(True).alias("is_future"),
                     "_code")
    cal = hist.unionByName(fut) if periods > 0 else hist
    cal = cal.where(is_weekday("ds"))
    cal = cal.withColumn("country", country_for_currency(F.col("_code"), default_country))
    hol = holiday_table(train.sparkSession)
    cal = cal.join(F.broadcast(hol), (cal["country"] == hol["country"]) & (cal["ds"] == hol["date"]),
                   "left").drop(hol["country"]).drop("date")
    return cal.select("ticker", "ds", "y", "is_future", "country", "holiday")


def future_calendar(train: DataFrame, periods: int = 90,
                    default_country: str = "US") -> DataFrame:
    """F4 + F5 + L1: history dates plus `periods` daily dates, weekdays only,
    each with the holiday of the ticker's country (GBP -> GB, HKD -> HK)."""
    return _calendar_rows(train, periods, default_country).drop("y")


def model_input(train: DataFrame, periods: int = 90, default_country: str = "US") -> DataFrame:
    """Calendar rows with the observed y attached (NULL in the future)."""
    return _calendar_rows(train, periods, default_country)


def forecast(train: DataFrame, periods: int = 90, params: ModelParams = ModelParams(),
             default_country: str = "US", limits: DataFrame | None = None) -> DataFrame:
    """F1 + P11: fit every ticker at once and predict history + future.

    `limits` (ticker, cap, floor) overrides the cap and floor per ticker.
    """
    rows = with_limits(model_input(train, periods, default_country), limits)
    p = asdict(params)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return fit_predict(pdf, **own_limits(p, pdf))

    return rows.groupBy("ticker").applyInPandas(fit, schema=FORECAST)


def with_limits(rows: DataFrame, limits: DataFrame | None) -> DataFrame:
    """The cap and floor of each ticker, where a table gives them."""
    if limits is None:
        return rows
    return rows.join(limits.select("ticker", "cap", "floor"), "ticker", "left")


def own_limits(p: dict, pdf: pd.DataFrame) -> dict:
    """The parameters with a ticker's own cap and floor."""
    q = dict(p)
    for k in ("cap", "floor"):
        if k in pdf.columns and pdf[k].notna().any():
            q[k] = float(pdf[k].dropna().iloc[0])
    return q


def holdout_split(rows: DataFrame, holdout: int) -> DataFrame:
    """number a ticker's observations from the latest; the last `holdout`
    of them are held out (column `is_holdout`), whatever the series' length."""
    latest = Window.partitionBy("ticker").orderBy(F.desc("ds"))
    seen = rows.where(F.col("y").isNotNull())
    return seen.withColumn("is_holdout", F.row_number().over(latest) <= holdout)


def score(actuals: DataFrame, fcst: DataFrame) -> DataFrame:
    """F2 + J4 + A8 + A9: join actuals to predictions on (ticker, ds) and
    score each ticker (MAPE is a fraction)."""
    a = actuals.select("ticker", "ds", F.col("y").alias("_y"))
    j = a.join(fcst.select("ticker", "ds", "yhat"), ["ticker", "ds"], "inner")
    err = F.abs(F.col("_y") - F.col("yhat"))
    return j.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err).alias("mae"),
        F.avg(err / F.greatest(F.abs("_y"), F.lit(np.finfo(float).eps))).alias("mape"))


def linear_forecast(train: DataFrame, origin: str, periods: int = 90,
                    default_country: str = "US") -> DataFrame:
    """F6 applied on the F4 calendar: yhat of the linear baseline."""
    coef = linear_trend(train, origin)
    cal = future_calendar(train, periods, default_country)
    x = F.datediff("ds", F.to_date(F.lit(origin))).cast("double")
    return cal.join(coef, "ticker").select(
        "ticker", "ds", "is_future", (F.col("intercept") + F.col("slope") * x).alias("yhat"))


# The default search grid (prior scales, as in common practice).
DEFAULT_GRID = [
    {"changepoint_prior_scale": c, "seasonality_prior_scale": s}
    for c in (0.01, 0.1, 0.5) for s in (1.0, 10.0)
]


def grid_search(train: DataFrame, grid: list[dict] | None = None, holdout: int = 20,
                base: ModelParams = ModelParams(), default_country: str = "US",
                limits: DataFrame | None = None) -> DataFrame:
    """every (ticker, grid point) fitted in parallel, scored on the last
    `holdout` observations, best point per ticker kept.

    Each series row is repeated once per grid point (the grid is a small
    fixed list) and grouped by (ticker, grid_id) for the fit alone.  The split,
    the errors (A8), the naive baseline and the choice of the winner are Spark
    aggregates.  A grid point may set any model parameter; the winner's are
    returned as JSON.  Tickers with too few observations to fit keep a row
    with null errors.
    """
    grid = grid or DEFAULT_GRID
    points = [asdict(ModelParams(**dict(asdict(base), **g))) for g in grid]
    split = holdout_split(with_limits(model_input(train, 0, default_country), limits), holdout)
    rep = split.withColumn("grid_id", F.explode(F.array(*[F.lit(i) for i in range(len(grid))])))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return fit_holdout(pdf, **own_limits(points[int(pdf["grid_id"].iloc[0])], pdf))

    fitted = rep.groupBy("ticker", "grid_id").applyInPandas(
        fit, schema="ticker string, grid_id int, ds date, y double, is_holdout boolean, yhat double, last double")
    held = F.col("is_holdout")
    scores = fitted.groupBy("ticker", "grid_id").agg(
        F.sum((~held).cast("long")).alias("n_train"), F.sum(held.cast("long")).alias("n_holdout"),
        F.avg(F.when(held, F.abs(F.col("y") - F.col("yhat")))).alias("holdout_mae"),
        F.avg(F.when(held, F.abs(F.col("y") - F.col("last")))).alias("last_value_mae"))
    told = F.element_at(F.array(*[F.lit(json.dumps(g, sort_keys=True)) for g in grid]), F.col("grid_id") + 1)
    scores = scores.withColumn("params", told)
    w = Window.partitionBy("ticker").orderBy(F.asc_nulls_last("holdout_mae"), "grid_id")
    best = scores.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
    names = train.select("ticker").distinct()
    return names.join(best, "ticker", "left").select(
        "ticker", "grid_id", "params", "n_train", "n_holdout", "holdout_mae", "last_value_mae")


# --------------------------------------------------------------- numpy side --

def _design(days: np.ndarray, t: np.ndarray, cps: np.ndarray, hol: list, names: list,
            order: int, weekly: int = 0):
    trend = [np.ones_like(t), t] + [np.maximum(t - s, 0.0) for s in cps]
    seas = []
    for period, n in ((365.25, order), (7.0, weekly)):
        for k in range(1, n + 1):
            ang = 2.0 * np.pi * k * days / period
            seas += [np.sin(ang), np.cos(ang)]
    parts, codes = np.unique([h or "" for h in hol], return_inverse=True)
    member = np.array([[n in p.split(", ") for n in names] for p in parts], dtype=float)
    hols = list(member[codes].T) if names else []
    xt = np.column_stack(trend)
    xf = np.column_stack(seas + hols) if (seas or hols) else np.zeros((len(t), 0))
    return xt, xf


def _penalty(n_cp: int, n_seas: int, n_hol: int, p: dict, noise: float) -> np.ndarray:
    lam = [1e-8, 1e-8] + [noise / p["changepoint_prior_scale"] ** 2] * n_cp
    lam += [noise / p["seasonality_prior_scale"] ** 2] * n_seas
    lam += [noise / p["holidays_prior_scale"] ** 2] * n_hol
    return np.array(lam)


def _ridge(x: np.ndarray, y: np.ndarray, lam: np.ndarray) -> np.ndarray:
    a = x.T @ x + np.diag(lam + 1e-10)
    return np.linalg.solve(a, x.T @ y)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _fit(ys, xt, xf, lam, growth):
    """Returns a predictor f(xt, xf) -> (yhat_scaled, trend_scaled)."""
    x = np.hstack([xt, xf])
    if growth == "linear":
        beta = _ridge(x, ys, lam)
        kt = xt.shape[1]
        return lambda a, b: (np.hstack([a, b]) @ beta, a @ beta[:kt])
    # logistic: ys in (0, 1); start from a line through the logit
    kt = xt.shape[1]
    yc = np.clip(ys, 0.02, 0.98)
    theta = _ridge(xt, np.log(yc / (1 - yc)), lam[:kt])
    beta = np.zeros(xf.shape[1])
    params = np.concatenate([theta, beta])
    mu = 1e-3

    def loss(pr):
        r = ys - (_sigmoid(xt @ pr[:kt]) + xf @ pr[kt:])
        return r @ r + pr @ (lam * pr)

    cur = loss(params)
    for _ in range(60):
        g = _sigmoid(xt @ params[:kt])
        r = ys - (g + xf @ params[kt:])
        jac = np.hstack([(g * (1 - g))[:, None] * xt, xf])
        a = jac.T @ jac + np.diag(lam) + mu * np.eye(len(params))
        step = np.linalg.solve(a, jac.T @ r - lam * params)
        cand = params + step
        new = loss(cand)
        if new < cur:
            params, mu = cand, max(mu / 3, 1e-9)
            if cur - new < 1e-12 * max(cur, 1.0):
                cur = new
                break
            cur = new
        else:
            mu *= 4
            if mu > 1e6:
                break
    th, be = params[:kt], params[kt:]
    return lambda a, b: (_sigmoid(a @ th) + b @ be, _sigmoid(a @ th))


def _prepare(pdf: pd.DataFrame, p: dict):
    pdf = pdf.sort_values("ds").reset_index(drop=True)
    ds = pd.to_datetime(pdf["ds"])
    days = (ds - pd.Timestamp("1970-01-01")).dt.days.to_numpy(dtype=float)
    return pdf, days


def _model(hist_days, hist_y, hist_hol, p: dict):
    """Fit on history; returns predict(days, holidays) -> (yhat, trend) in y units."""
    d0, d1 = hist_days.min(), hist_days.max()
    span = max(d1 - d0, 1.0)
    t = (hist_days - d0) / span
    n = len(t)
    n_cp = min(p["n_changepoints"], max(int(n * p["changepoint_range"]) - 1, 0))
    cps = (np.quantile(t[: max(int(np.ceil(n * p["changepoint_range"])), 1)],
                       np.linspace(0, 1, n_cp + 2)[1:-1]) if n_cp > 0 else np.array([]))
    names = sorted({x for h in hist_hol if h is not None for x in str(h).split(", ")})
    logistic = p["growth"] == "logistic"
    if logistic:
        lo, hi = float(p["floor"]), float(p["cap"])
        if not hi > lo:  # a ticker's own limits
            raise ValueError("cap must exceed floor")
        scale, shift = hi - lo, lo
    else:
        scale, shift = max(float(np.max(np.abs(hist_y))), 1e-9), 0.0
    ys = (hist_y - shift) / scale
    xt, xf = _design(hist_days, t, cps, list(hist_hol), names, p["yearly_order"],
                     p["weekly_order"])
    n_seas = 2 * (p["yearly_order"] + p["weekly_order"])
    noise = max(float(np.var(ys)), 1e-12) * 0.1
    lam = _penalty(len(cps), n_seas, len(names), p, noise)
    f = _fit(ys, xt, xf, lam, p["growth"])
    resid = ys - f(xt, xf)[0]
    lam = _penalty(len(cps), n_seas, len(names), p, max(float(np.var(resid)), 1e-12))
    f = _fit(ys, xt, xf, lam, p["growth"])
    fitted = f(xt, xf)[0] * scale + shift
    width = float(np.quantile(np.abs(hist_y - fitted), p["interval_width"])) if n else 0.0

    def predict(days, hol):
        tt = (days - d0) / span
        a, b = _design(days, tt, cps, list(hol), names, p["yearly_order"], p["weekly_order"])
        yh, tr = f(a, b)
        horizon = np.maximum(days - d1, 0.0)
        q = width * np.sqrt(1.0 + horizon / max(span, 1.0))
        return yh * scale + shift, tr * scale + shift, q

    return predict


def fit_predict(pdf: pd.DataFrame, **p) -> pd.DataFrame:
    """One ticker: fit on rows with y, predict every calendar row."""
    out_cols = [f.name for f in FORECAST.fields]
    if pdf.empty:
        return pd.DataFrame(columns=out_cols)
    pdf, days = _prepare(pdf, p)
    has_y = pdf["y"].notna().to_numpy() & ~pdf["is_future"].to_numpy(dtype=bool)
    if has_y.sum() == 0:  # nothing to fit: the calendar with no prediction
        return pdf.assign(yhat=np.nan, yhat_lower=np.nan, yhat_upper=np.nan, trend=np.nan)[out_cols]
    hol = pdf["holiday"].where(pdf["holiday"].notna(), None).tolist()
    predict = _model(days[has_y], pdf["y"].to_numpy(dtype=float)[has_y],
                     [h for h, k in zip(hol, has_y) if k], p)
    yhat, trend, q = predict(days, hol)
    return pd.DataFrame({
        "ticker": pdf["ticker"], "ds": pdf["ds"], "y": pdf["y"].astype(float),
        "yhat": yhat, "yhat_lower": yhat - q, "yhat_upper": yhat + q,
        "trend": trend, "is_future": pdf["is_future"].astype(bool)})[out_cols]


def fit_holdout(pdf: pd.DataFrame, **p) -> pd.DataFrame:
    """Fit on the rows that are not held out and predict all; `last` repeats
    the last training value.  Under three training rows nothing is predicted."""
    pdf, days = _prepare(pdf, p)
    kept = ~pdf["is_holdout"].to_numpy(dtype=bool)
    y = pdf["y"].to_numpy(dtype=float)
    yhat, last = np.full(len(pdf), np.nan), np.nan
    if kept.sum() >= 3:
        hol = pdf["holiday"].where(pdf["holiday"].notna(), None).tolist()
        yhat = _model(days[kept], y[kept], [h for h, k in zip(hol, kept) if k], p)(days, hol)[0]
        last = y[kept][-1]
    return pd.DataFrame({"ticker": pdf["ticker"], "grid_id": pdf["grid_id"], "ds": pdf["ds"], "y": y,
                         "is_holdout": ~kept, "yhat": yhat, "last": last})
