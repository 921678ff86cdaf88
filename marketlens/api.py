"""Job-level entry points with the shape of the source's two classes.

`MarketETL` loads landing files into tables (full refresh, incremental
update, FX tables); `MarketExplorer` builds the enriched frame once and
returns the data behind every report.  Both are thin compositions of the
operators and never loop over tickers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import dims, enrich, forecast as fc, incremental, reshape, series
from .operators.reports import yearly_report
from .schemas import BAR_COLUMNS, FINANCIALS, HOLDERS, NEWS
from .sinks import tables
from .sources import landing
from .session import checkpoint_root
from .streaming.new_bars import stored_bars


@dataclass
class LandingPaths:
    bars: str
    currency: str
    fx: list[str]
    holders: str | None = None
    financials: str | None = None
    news: str | None = None
    fmt: str = "parquet"


class MarketETL:
    """Landing files -> stored tables."""

    def __init__(self, spark: SparkSession, paths: LandingPaths, base: str = "GBP"):
        self.spark, self.paths, self.base = spark, paths, base

    def history(self) -> DataFrame:
        return landing.read_bars(self.spark, self.paths.bars, self.paths.fmt)

    def full_refresh(self, root: str, tickers: list[str] | None = None) -> None:
        """K5 + K8: replace every table in one pass over all tickers.  The new set
        is written beside the old one and shows all at once (`tables.publish`).

        Tables without a landing path this time end up empty.  `tickers` are
        listed in the master table even when they have no history."""
        p, s = self.paths, self.spark
        hist = self.history()
        asked = s.createDataFrame([(t,) for t in tickers], "ticker string") if tickers else None
        out = {"stock_history": hist.withColumn("year", F.year("date")),
               "stocks_master": dims.ticker_master(hist, asked)}
        if p.holders:
            out["major_share_holders"] = landing.read_holders(s, p.holders, p.fmt)
        if p.financials:
            out["financials"] = landing.read_financial_statements(s, p.financials, fmt=p.fmt)
        if p.news:
            out["news"] = landing.read_news(s, p.news, p.fmt)
        tables.publish(out, root, {"stock_history": ["year"]},
                       {"major_share_holders": HOLDERS, "financials": FINANCIALS, "news": NEWS})

    def update_history(self, root: str, end: str | None = None) -> None:
        """Store the days the table lacks, late ones included, and replace
        corrected ones; only the increment's years are read."""
        path = tables.current_path(self.spark, root, "stock_history")
        if path is None:  # nothing was published yet: an empty table to load into
            tables.publish({"stock_history": stored_bars(self.spark, f"{root}/none")}, root, {"stock_history": ["year"]})
            path = tables.current_path(self.spark, root, "stock_history")
        tables.store_bars(stored_bars(self.spark, path), path, incremental.one_per_day(self.history(), end))

    def stored_history(self, root: str) -> DataFrame:
        """The stored bars, read with their schema ("0700" stays text)."""
        return stored_bars(self.spark, tables.current_path(self.spark, root, "stock_history")).select(*BAR_COLUMNS)

    def table(self, root: str, name: str) -> DataFrame:
        """A stored table of the set that was published last."""
        return tables.read_published(self.spark, root, name)

    def exchange_rate_tables(self, root: str, rows_per_task: int = 1_000_000) -> None:
        """G8 + G9: date dimension and ticker x FX table."""
        cur = landing.read_currency(self.spark, self.paths.currency, self.paths.fmt)
        fx = dims.scope_fx(landing.read_fx(self.spark, self.paths.fx, self.paths.fmt), cur,
                           self.base)
        tables.publish({"date_dimension": dims.date_dimension(fx),
                        "exchange_table": dims.exchange_table(cur, fx, rows_per_task)}, root)


class MarketExplorer:
    """The enriched master frame and the data behind each report."""

    def __init__(self, spark: SparkSession, bars: DataFrame, currency: DataFrame,
                 fx: DataFrame, base: str = "GBP", materialize: bool = False):
        self.spark = spark
        master = enrich.enrich_prices(bars, currency, fx, base)
        if materialize:
            # Several reports reuse the frame: cut the lineage once, in the
            # cluster's shared checkpoint folder (survives lost executors).
            checkpoint_root(spark)
            master = master.checkpoint(eager=True)
        self.master = master
        self.bars = bars

    def fx_coverage(self) -> DataFrame:
        return enrich.fx_coverage(self.master)

    def stock_price(self, log: bool = False, preset: str = "all") -> DataFrame:
        return series.sort_for_report(series.price_series(self.master, log=log, preset=preset))

    def trade_volume(self) -> DataFrame:
        return series.sort_for_report(series.volume_series(self.master))

    def volatility(self, nbins: int = 200) -> DataFrame:
        r = series.daily_returns(self.master.select("ticker", "date", "close"))
        return series.return_histogram(r, nbins=nbins)

    def cumulative_returns(self, tickers: list[str] | None = None) -> DataFrame:
        """Long form; with a ticker list, the wide `Close_<ticker>` form."""
        long = series.cumulative_returns(self.master)
        if tickers is None:
            return long
        return reshape.pivot_measure(long, "cumulative_return", tickers, prefix="Close")

    def rolling_average(self, preset: str = "all") -> DataFrame:
        return series.sort_for_report(series.rolling_report(self.master, preset=preset))

    def yearly(self) -> DataFrame:
        return yearly_report(self.spark, self.bars)

    def future_trend(self, tickers: list[str] | None = None, start_date: str = "2021-05-01",
                     periods: int = 90, country_name: str = "US", cap: float = 1000.0,
                     floor: float = 0.0, growth: str = "logistic",
                     interval_width: float = 0.95, limits: DataFrame | None = None) -> DataFrame:
        """F1; `limits` (ticker, cap, floor) gives tickers their own."""
        train = fc.training_frame(self.master, start_date, tickers)
        params = fc.ModelParams(growth=growth, cap=cap, floor=floor,
                                interval_width=interval_width)
        return fc.forecast(train, periods, params, country_name, limits)

    def future_trend_grid_search(self, tickers: list[str] | None = None,
                                 start_date: str = "2021-05-01", grid: list[dict] | None = None,
                                 holdout: int = 20, country_name: str = "US",
                                 cap: float = 1000.0, floor: float = 0.0,
                                 growth: str = "logistic", limits: DataFrame | None = None) -> DataFrame:
        train = fc.training_frame(self.master, start_date, tickers)
        base = fc.ModelParams(growth=growth, cap=cap, floor=floor)
        return fc.grid_search(train, grid, holdout, base, country_name, limits)

    def forecast_errors(self, forecast: DataFrame, start_date: str = "2021-05-01") -> DataFrame:
        """MAE and MAPE of a forecast against the observed closes."""
        train = fc.training_frame(self.master, start_date)
        return fc.score(train, forecast.where(~F.col("is_future")))
