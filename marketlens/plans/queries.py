"""The registered queries: fixture -> operators -> a result DataFrame.

Each callable takes (spark, sf_dir) and returns a lazy DataFrame over the
whole input tables.  Computed columns are aliased to the names used by the
SQL oracle.  Means computed as (exact decimal sum) / count are left as they
are: both engines produce the same double.  Results of floating-point
algorithms whose summation order differs between engines (regressions,
error scores, bin edges) are rounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import money
from ..operators import dims, enrich, forecast as fc, incremental, normal_equations as ne, quality, reports, reshape, series
from ..operators.normalize import normalize_bars, one_per_key, union_all
from ..schemas import NEWS_TIME_KEY
from ..session import checkpoint_root
from ..sinks import tables
from ..sinks.tables import column_ddl
from ..sources import fixtures as fx, landing
from ..streaming.new_bars import load_new_bars, stored_bars

# Parameters of the fixture forecasts (fixture prices reach ~105,000, so the
# logistic cap is scaled to the data, not the 1,000 default).
FORECAST_START = "1999-01-01"
FORECAST_PERIODS = 90
# Rolling origins: days of history before the first cutoff, between cutoffs, ahead.
CUTOFFS = (365, 30, 60)
# Buckets of the co-located tables.
BUCKETS = 8
FORECAST_PARAMS = fc.ModelParams(growth="logistic", cap=150_000.0, floor=0.0)


def _r(c, places: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, places)


# ---- shared building blocks ---------------------------------------------------

def dense_master(spark, sf) -> DataFrame:
    """The enriched master frame of the dense (three-ticker) universe."""
    return enrich.enrich_prices(fx.dense_bars(spark, sf), fx.flag_currency(spark),
                                fx.dense_fx(spark, sf))


def wide_master(spark, sf) -> DataFrame:
    return enrich.enrich_prices(fx.wide_bars(spark, sf), fx.wide_currency(spark, sf),
                                fx.wide_fx(spark, sf))


def _folder(spark, name: str) -> str:
    """A new folder for a table that a query stores and reads, in the shared folder."""
    return f"{checkpoint_root(spark)}/queries/{name}-{uuid.uuid4().hex}"


def _train(spark, sf):
    return fc.training_frame(dense_master(spark, sf), FORECAST_START)


# ---- queries ------------------------------------------------------------------

def q_daily_bars(spark, sf):
    return fx.dense_bars(spark, sf)


def q_yearly_report(spark, sf):
    return reports.yearly_report(spark, fx.dense_bars(spark, sf))


def q_currency_lookup(spark, sf):
    return dims.currency_dimension(fx.wide_currency(spark, sf))


def q_fx_pairs(spark, sf):
    return dims.fx_pairs(fx.wide_currency(spark, sf))


def q_fx_rates(spark, sf):
    return dims.scope_fx(fx.dense_fx(spark, sf), fx.dense_currency(spark, sf))


def _enriched_out(df):
    return df.select("ticker", "date", "open", "high", "low", "close", "volume", "dividends",
                     "currency_code", "fx_close", "rate",
                     money("converted_close").alias("converted_close"),
                     F.col("day").cast("bigint").alias("day"))


def q_enriched_prices(spark, sf):
    return _enriched_out(dense_master(spark, sf))


def q_fx_coverage(spark, sf):
    df = enrich.fx_coverage(dense_master(spark, sf))
    return df.select("total_rows", "missing_rate_rows", "unconverted_rows",
                     _r("missing_rate_pct").alias("missing_rate_pct"))


def q_date_dimension(spark, sf):
    return dims.date_dimension(fx.dense_fx(spark, sf))


def q_exchange_table(spark, sf):
    return dims.exchange_table(fx.dense_currency(spark, sf), fx.dense_fx(spark, sf))


def _price(df):
    return df.select("ticker", "date", money("converted_close").alias("converted_close"))


def q_price_series(spark, sf):
    return _price(series.price_series(dense_master(spark, sf)))


def q_price_range_6m(spark, sf):
    return _price(series.price_series(dense_master(spark, sf), preset="6m"))


def q_price_range_ytd(spark, sf):
    return _price(series.price_series(dense_master(spark, sf), preset="ytd"))


def q_volume_series(spark, sf):
    return series.volume_series(dense_master(spark, sf))


def q_daily_returns(spark, sf):
    df = series.daily_returns(dense_master(spark, sf).select("ticker", "date", "close"))
    return df.select("ticker", "date", "close", "daily_return")


def q_daily_returns_chunked(spark, sf):
    df = series.daily_returns_chunked(dense_master(spark, sf).select("ticker", "date", "close"))
    return df.select("ticker", "date", "close", "daily_return")


def q_return_histogram(spark, sf):
    r = series.daily_returns(dense_master(spark, sf).select("ticker", "date", "close"))
    h = series.return_histogram(r)
    return h.select("ticker", "bin", _r("bin_start", 9).alias("bin_start"),
                    _r("bin_end", 9).alias("bin_end"), "count")


def q_cumulative_returns(spark, sf):
    return series.cumulative_returns(dense_master(spark, sf))


def _tickers(df) -> list[str]:
    """The pivot's column list: one column per ticker there is (a wide table
    has as many columns as tickers, so the list is as bounded as its schema)."""
    return [r[0] for r in df.select("ticker").distinct().orderBy("ticker").collect()]


def q_cumulative_returns_wide(spark, sf):
    long = series.cumulative_returns(dense_master(spark, sf))
    return reshape.pivot_measure(long, "cumulative_return", sorted(fx.FLAG_CURRENCY), prefix="Close")


def q_cumulative_returns_duplicates(spark, sf):
    """W4 over repeated (ticker, date): every line is a bar of its own."""
    df = series.cumulative_returns(fx.line_bars(spark, sf))
    return df.withColumn("cumulative_return", _r("cumulative_return", 9))


def q_cumulative_returns_wide_universe(spark, sf):
    return series.cumulative_returns(wide_master(spark, sf))


def _ma_out(df, windows):
    return df.select("ticker", "date", money("converted_close").alias("converted_close"),
                     *[f"ma{n}" for n, _ in windows])


def q_rolling_means(spark, sf):
    m = dense_master(spark, sf).select("ticker", "date", "converted_close")
    return _ma_out(series.rolling_means(m, "converted_close"), series.ROLLING_WINDOWS)


def q_rolling_means_chunked(spark, sf):
    """W2 in the chunked layout on the dense universe, where every ticker
    holds a third of all rows; small chunks force the halo path."""
    m = dense_master(spark, sf).select("ticker", "date", "converted_close")
    return _ma_out(series.rolling_means_chunked(m, "converted_close", chunk_rows=1500),
                   series.ROLLING_WINDOWS)


def q_rolling_average_report(spark, sf):
    return _ma_out(series.rolling_report(dense_master(spark, sf)), series.ROLLING_WINDOWS)


def q_rolling_means_wide_universe(spark, sf):
    m = wide_master(spark, sf).select("ticker", "date", "converted_close")
    return _ma_out(series.rolling_means(m, "converted_close"), series.ROLLING_WINDOWS)


def q_wide_to_long(spark, sf):
    bars = fx.dense_bars(spark, sf)
    wide = reshape.long_to_wide(bars, _tickers(fx.line_bars(spark, sf)))
    return reshape.wide_to_long(wide).select("ticker", "date", "open", "high", "low", "close",
                                             "volume", "dividends")


def q_financials_by_date(spark, sf):
    long = fx.financials_long(spark, sf)
    metrics = sorted(m for _, m in fx.FINANCIAL_METRICS)
    # A date column no line falls in stays empty and gives no row.
    dates = [f"{y}-12-31" for y in fx.STATEMENT_YEARS]
    statement = reshape.statement_wide(long, dates)
    return reshape.transpose_financials(statement, metrics).select("ticker", "date", *metrics)


def q_holders(spark, sf):
    from ..sources.landing import name_holders
    return name_holders(fx.holders_raw(spark, sf))


def q_news_items(spark, sf):
    return reshape.explode_news(fx.news_payloads(spark, sf))


def q_ticker_master(spark, sf):
    return dims.ticker_master(fx.dense_bars(spark, sf))


def q_last_update(spark, sf):
    return incremental.last_update(fx.dense_bars(spark, sf))


def q_incremental_new_bars(spark, sf):
    bars = fx.dense_bars(spark, sf)
    split = F.to_date(F.lit(fx.SPLIT_DATE))
    target, incoming = bars.where(F.col("date") <= split), bars.where(F.col("date") >= split)
    return incremental.new_bars(target, incoming)


def q_max_string_lengths(spark, sf):
    sup = fx.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nat = F.broadcast(fx.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    reg = F.broadcast(fx.table(spark, sf, "region").select("r_regionkey", "r_name"))
    dim = (sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"], "left")
              .join(reg, nat["n_regionkey"] == reg["r_regionkey"], "left")
              .select("s_suppkey", "s_name", "s_acctbal", "n_name", "r_name"))
    return column_ddl(dim)


def q_quality_report(spark, sf):
    return quality.quality_report(fx.dense_bars(spark, sf), fx.dense_fx(spark, sf),
                                  fx.flag_currency(spark))


def q_quality_report_wide(spark, sf):
    return quality.quality_report(fx.wide_bars(spark, sf), fx.wide_fx(spark, sf),
                                  fx.wide_currency(spark, sf))


def q_quality_violations(spark, sf):
    """The rules on bars, rates and currencies that break each of them."""
    bars, rates = fx.dense_bars(spark, sf), fx.dense_fx(spark, sf)
    bars = bars.withColumn("close", F.when(F.dayofmonth("date") == 2, -F.col("close")).otherwise(F.col("close")))
    bars = bars.unionByName(bars.where(F.dayofmonth("date") == 1))
    rates = rates.unionByName(rates.where(F.dayofmonth("date") == 15))
    codes = fx.dense_currency(spark, sf)
    second = codes.where(F.col("ticker") == "A").withColumn("currency_code", F.lit("usd"))
    return quality.quality_report(bars, rates, codes.unionByName(second))


def q_enriched_prices_wide(spark, sf):
    return _enriched_out(wide_master(spark, sf))


def q_daily_returns_wide(spark, sf):
    df = series.daily_returns(wide_master(spark, sf).select("ticker", "date", "close"))
    return df.select("ticker", "date", "close", "daily_return")


def q_return_histogram_wide(spark, sf):
    r = series.daily_returns(wide_master(spark, sf).select("ticker", "date", "close"))
    h = series.return_histogram(r)
    return h.select("ticker", "bin", _r("bin_start", 9).alias("bin_start"),
                    _r("bin_end", 9).alias("bin_end"), "count")


def q_linear_trend_wide(spark, sf):
    lt = fc.linear_trend(fc.training_frame(wide_master(spark, sf), FORECAST_START), FORECAST_START)
    return lt.select("ticker", "n", _r("slope").alias("slope"), _r("intercept", 4).alias("intercept"))


def q_exchange_table_wide(spark, sf):
    return dims.exchange_table(fx.wide_currency(spark, sf), fx.wide_fx(spark, sf))


def q_price_range_1m(spark, sf):
    return _price(series.price_series(dense_master(spark, sf), preset="1m"))


def q_price_range_1y(spark, sf):
    return _price(series.price_series(dense_master(spark, sf), preset="1y"))


def q_price_log(spark, sf):
    """The base-ten logarithm of the native close."""
    logs = series.price_series(dense_master(spark, sf), value="close", log=True)
    return logs.select("ticker", "date", _r("close", 9).alias("log_close"))


def q_rolling_average_6m(spark, sf):
    return _ma_out(series.rolling_report(dense_master(spark, sf), preset="6m"), series.ROLLING_WINDOWS)


def q_incremental_overlap(spark, sf):
    """S5 where the landing files overlap (every new bar comes twice) and one
    ticker is new, with days from before the others' last load."""
    bars = fx.dense_bars(spark, sf)
    split = F.to_date(F.lit(fx.SPLIT_DATE))
    target = bars.where((F.col("date") <= split) & (F.col("ticker") != fx.LATE_TICKER))
    again = bars.where(F.col("date") >= split)
    return incremental.new_bars(target, bars.unionByName(again))


def q_fx_overlap(spark, sf):
    """Rates of two loads: the later load's rate replaces the earlier one's."""
    first = fx.dense_fx(spark, sf).withColumn("_load", F.lit(1))
    second = (first.where(F.dayofmonth("date") % 2 == 0)
              .withColumn("close", F.col("close") * 2).withColumn("_load", F.lit(2)))
    return one_per_key(first.unionByName(second), ["from_currency", "to_currency", "date"], ["_load"])


def q_bars_from_text(spark, sf):
    """P1, P2, P5-P7 on text: names, dates, numbers and unreadable volumes."""
    return normalize_bars(fx.text_bars(spark, sf))


def q_news_feed_keys(spark, sf):
    """N1 on payloads that name the publish time as the feed does."""
    return reshape.explode_news(fx.news_payloads(spark, sf, NEWS_TIME_KEY))


def q_currency_units(spark, sf):
    """The dimension with prices of one region quoted in pence."""
    raw = fx.wide_currency(spark, sf)
    pence = F.when(F.col("currency_code") == "gbp", F.lit("GBp")).otherwise(F.col("currency_code"))
    return dims.with_unit_factor(raw.withColumn("currency_code", pence))


def q_linear_trend(spark, sf):
    lt = fc.linear_trend(_train(spark, sf), FORECAST_START)
    return lt.select("ticker", "n", _r("slope").alias("slope"), _r("intercept").alias("intercept"))


def q_future_calendar(spark, sf):
    return fc.future_calendar(_train(spark, sf), FORECAST_PERIODS)


def q_forecast(spark, sf):
    return fc.forecast(_train(spark, sf), FORECAST_PERIODS, FORECAST_PARAMS)


def q_forecast_frame(spark, sf):
    """What SQL can check of F1: every ticker and day, the observed prices, and
    that the prediction lies inside its interval."""
    f = fc.forecast(_train(spark, sf), FORECAST_PERIODS, FORECAST_PARAMS)
    inside = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return f.select("ticker", "ds", "y", "is_future", F.coalesce(inside, F.lit(False)).alias("inside"))


def q_forecast_holdout_split(spark, sf):
    return fc.holdout_split(fc.model_input(_train(spark, sf), 0), 20).select("ticker", "ds", "is_holdout")


def q_forecast_scores(spark, sf):
    train = _train(spark, sf)
    pred = fc.linear_forecast(train, FORECAST_START, FORECAST_PERIODS)
    s = fc.score(train, pred)
    return s.select("ticker", "n", _r("mae").alias("mae"), _r("mape").alias("mape"))


def q_forecast_grid_best(spark, sf):
    return fc.grid_search(_train(spark, sf), base=FORECAST_PARAMS)


def q_forecast_normal_sums(spark, sf):
    """The sums that F1 with linear growth is solved from, per observation: every
    entry of X'X and X'y."""
    model = ne.LinearGrowth()
    featured = ne.with_features(fc.model_input(_train(spark, sf), 0), model)
    sums = ne.normal_sums(featured, model)
    names = F.array(*[F.lit(n) for n in model.names])
    places = [(i, j) for i in range(len(model.names)) for j in range(i, len(model.names))]
    pairs = F.array(*[F.struct(F.lit(model.names[i]).alias("a"), F.lit(model.names[j]).alias("b")) for i, j in places])
    xx = F.transform(F.arrays_zip(pairs.alias("at"), F.col("xx").alias("v")), lambda z: F.struct(
        z["at"]["a"].alias("a"), z["at"]["b"].alias("b"), F.round(z["v"] / F.col("n"), 6).alias("value")))
    xy = F.transform(F.arrays_zip(names.alias("at"), F.col("xy").alias("v")), lambda z: F.struct(
        z["at"].alias("a"), F.lit("y").alias("b"), F.round(z["v"] / F.col("n"), 4).alias("value")))
    return sums.select("ticker", "n", F.inline(F.concat(xx, xy)))


def q_forecast_linear_growth(spark, sf):
    """F1 with linear growth, solved from the normal equations."""
    return ne.linear_growth_forecast(_train(spark, sf), FORECAST_PERIODS)


def q_forecast_linear_growth_wide(spark, sf):
    """The same for one ticker per supplier."""
    train = fc.training_frame(wide_master(spark, sf), FORECAST_START)
    return ne.linear_growth_forecast(train, FORECAST_PERIODS)


def q_forecast_cutoffs(spark, sf):
    return ne.cutoffs(_train(spark, sf), *CUTOFFS).select("ticker", "k", "cutoff")


def q_forecast_origin_errors(spark, sf):
    """errors of the linear trend at rolling origins, by days ahead."""
    e = ne.origin_errors(_train(spark, sf), FORECAST_START, *CUTOFFS)
    return e.select("ticker", "horizon", "n", _r("mae", 4).alias("mae"), _r("rmse", 4).alias("rmse"),
                    _r("mape").alias("mape"), _r("mae_smooth", 4).alias("mae_smooth"))


def _stored_with_gaps(spark, sf):
    """Bars up to the split date, stored by year, without the gap days."""
    bars = fx.dense_bars(spark, sf)
    split = F.to_date(F.lit(fx.SPLIT_DATE))
    path = _folder(spark, "gaps")
    kept = bars.where((F.col("date") <= split) & (F.dayofmonth("date") != fx.GAP_DAY))
    tables.write_table(kept.withColumn("year", F.year("date")), path, "append", ["year"])
    return path, bars.where(F.col("date") > F.add_months(split, -fx.LATE_MONTHS))


def q_incremental_late_days(spark, sf):
    """S5 + J5 on a stored table with gap days: an increment that reaches back
    brings days that the target lacks, behind its last ones, and days it has."""
    path, incoming = _stored_with_gaps(spark, sf)
    return incremental.new_bars(stored_bars(spark, path), incoming)


def q_incremental_until(spark, sf):
    """The same increment up to a day."""
    path, incoming = _stored_with_gaps(spark, sf)
    return incremental.new_bars(stored_bars(spark, path), incoming, end=fx.UNTIL)


def q_incremental_corrections(spark, sf):
    """The stored table after a load with late and corrected days."""
    path, incoming = _stored_with_gaps(spark, sf)
    corrected = incoming.withColumn("close", F.when(F.dayofmonth("date") == fx.CORRECTED_DAY, F.col("close") * 2)
                                    .otherwise(F.col("close")))
    tables.store_bars(stored_bars(spark, path), path, incremental.one_per_day(corrected))
    return stored_bars(spark, path).drop("year")


def q_stream_loads(spark, sf):
    """Three stream runs over landing files, the second with late days, the
    third with corrected ones; the stored table."""
    bars = fx.dense_bars(spark, sf)
    landing_at, target = _folder(spark, "landing"), _folder(spark, "streamed")
    late = F.dayofmonth("date") == fx.GAP_DAY
    doubled = bars.where(F.dayofmonth("date") == fx.CORRECTED_DAY).withColumn("close", F.col("close") * 2)
    for i, rows in enumerate((bars.where(~late), bars.where(late | (F.dayofmonth("date") < 3)), doubled)):
        rows.write.parquet(f"{landing_at}/{i}")
        load_new_bars(spark, f"{landing_at}/*", target, checkpoint=f"{target}-state")
    return stored_bars(spark, target).drop("year")


def q_last_update_footers(spark, sf):
    """S9 + K6: last dates from the footers of a table partitioned by ticker."""
    path = _folder(spark, "by-ticker")
    tables.write_table(fx.dense_bars(spark, sf), path, "append", ["ticker"])
    return incremental.last_update_from_files(spark, path)


def q_colocated_series(spark, sf):
    """K8 + J1 + W1 + W2 on tables bucketed by ticker: no exchange after the scans."""
    names = {}
    for name, df in (("bars", fx.wide_bars(spark, sf)), ("currency", fx.wide_currency(spark, sf))):
        path = _folder(spark, name)
        names[name] = path.rsplit("/", 1)[1].replace("-", "_")
        tables.save_bucketed(df, names[name], BUCKETS, path=path)
    joined = enrich.attach_currency(spark.table(names["bars"]), spark.table(names["currency"]))
    df = series.daily_returns(joined.select("ticker", "date", "close", "currency_code"))
    return series.rolling_means(df, "close", ((50, 25), (200, 100))).select(
        "ticker", "date", "close", "currency_code", "daily_return", "ma50", "ma200")


def q_published_refresh(spark, sf):
    """K5 + K8: a set published twice, the second refresh with later bars."""
    bars, root = fx.dense_bars(spark, sf), _folder(spark, "db")
    split = F.to_date(F.lit(fx.SPLIT_DATE))
    for part in (bars.where(F.col("date") <= split), bars):
        tables.publish({"stock_history": part.withColumn("year", F.year("date")), "stocks_master": dims.ticker_master(part)},
                       root, {"stock_history": ["year"]})
    last = tables.read_published(spark, root, "stock_history").drop("year")
    return last.join(tables.read_published(spark, root, "stocks_master"), "ticker")


def q_yearly_view(spark, sf):
    """S10 + K7: the yearly report as a view over a stored table, through SQL."""
    path = _folder(spark, "history")
    name = "stock_history_" + path.rsplit("-", 1)[1]
    tables.write_table(fx.dense_bars(spark, sf), path, "append", ["ticker"])
    spark.read.parquet(path).createOrReplaceTempView(name)
    reports.create_yearly_view(spark, landing.read_table(spark, name), f"yearly_{name}")
    return spark.sql(f"SELECT year, ticker, avg_open, avg_close, avg_high, avg_low FROM yearly_{name}")


def q_wide_file(spark, sf):
    """A bulk file with a column per ticker and measure, read as bars."""
    path = _folder(spark, "wide")
    reshape.long_to_wide(fx.dense_bars(spark, sf), list(fx.FLAG_CURRENCY)).write.parquet(path)
    return landing.read_wide_bars(spark, path)


def q_rates_union(spark, sf):
    """Rates of three landing folders, one without a low and a high."""
    rates = fx.dense_fx(spark, sf)
    parts = [rates.where(F.col("from_currency") == c) for c in fx.STATUS_CURRENCY.values()]
    return union_all([*parts[:2], parts[2].drop("low", "high")])


def q_price_series_sorted(spark, sf):
    """O1: the price report by date, then ticker."""
    return _price(series.sort_for_report(series.price_series(dense_master(spark, sf))))


def q_exchange_table_hot(spark, sf):
    """J3 where one code has nine tenths of the tickers, cut by its measured size."""
    hot = F.when(F.substring("ticker", -1, 1) == "7", F.col("currency_code")).otherwise(F.lit("usd"))
    currency = fx.wide_currency(spark, sf).withColumn("currency_code", hot)
    return dims.exchange_table(currency, fx.wide_fx(spark, sf), rows_per_task=20_000)


def q_news_open_keys(spark, sf):
    """News items with keys that no schema names, typed when they are read."""
    more = {"sentiment": F.pmod("page_id", F.lit(7)) / 4, "place": F.concat(F.lit("p"), F.pmod("page_id", F.lit(3)))}
    path = _folder(spark, "news")
    reshape.news_variants(fx.news_payloads(spark, sf, more=more)).write.parquet(path)
    return reshape.variant_fields(spark.read.parquet(path), "item", {
        "title": "string", "sentiment": "double", "place": "string", "absent": "string"})


def q_financials_open_items(spark, sf):
    """S3: statements with line items that no schema names."""
    path = _folder(spark, "statements")
    reshape.statement_variants(fx.financials_long(spark, sf)).write.parquet(path)
    return reshape.variant_fields(spark.read.parquet(path), "items", {
        "extended_price": "double", "tax": "double", "goodwill": "double"})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_bars": q_daily_bars,
    "yearly_report": q_yearly_report,
    "currency_lookup": q_currency_lookup,
    "fx_pairs": q_fx_pairs,
    "fx_rates": q_fx_rates,
    "enriched_prices": q_enriched_prices,
    "fx_coverage": q_fx_coverage,
    "date_dimension": q_date_dimension,
    "exchange_table": q_exchange_table,
    "price_series": q_price_series,
    "price_range_6m": q_price_range_6m,
    "price_range_ytd": q_price_range_ytd,
    "volume_series": q_volume_series,
    "daily_returns": q_daily_returns,
    "daily_returns_chunked": q_daily_returns_chunked,
    "return_histogram": q_return_histogram,
    "cumulative_returns": q_cumulative_returns,
    "cumulative_returns_wide": q_cumulative_returns_wide,
    "rolling_means": q_rolling_means,
    "rolling_means_chunked": q_rolling_means_chunked,
    "rolling_average_report": q_rolling_average_report,
    "rolling_means_wide_universe": q_rolling_means_wide_universe,
    "wide_to_long": q_wide_to_long,
    "financials_by_date": q_financials_by_date,
    "holders": q_holders,
    "news_items": q_news_items,
    "ticker_master": q_ticker_master,
    "last_update": q_last_update,
    "incremental_new_bars": q_incremental_new_bars,
    "incremental_late_days": q_incremental_late_days,
    "incremental_until": q_incremental_until,
    "incremental_corrections": q_incremental_corrections,
    "stream_loads": q_stream_loads,
    "last_update_footers": q_last_update_footers,
    "colocated_series": q_colocated_series,
    "published_refresh": q_published_refresh,
    "yearly_view": q_yearly_view,
    "wide_file": q_wide_file,
    "rates_union": q_rates_union,
    "price_series_sorted": q_price_series_sorted,
    "exchange_table_hot": q_exchange_table_hot,
    "news_open_keys": q_news_open_keys,
    "financials_open_items": q_financials_open_items,
    "max_string_lengths": q_max_string_lengths,
    "quality_report": q_quality_report,
    "linear_trend": q_linear_trend,
    "future_calendar": q_future_calendar,
    "forecast": q_forecast,
    "forecast_scores": q_forecast_scores,
    "forecast_grid_best": q_forecast_grid_best,
    "forecast_frame": q_forecast_frame,
    "forecast_holdout_split": q_forecast_holdout_split,
    "forecast_normal_sums": q_forecast_normal_sums,
    "forecast_linear_growth": q_forecast_linear_growth,
    "forecast_linear_growth_wide": q_forecast_linear_growth_wide,
    "forecast_cutoffs": q_forecast_cutoffs,
    "forecast_origin_errors": q_forecast_origin_errors,
    "enriched_prices_wide": q_enriched_prices_wide,
    "daily_returns_wide": q_daily_returns_wide,
    "return_histogram_wide": q_return_histogram_wide,
    "cumulative_returns_wide_universe": q_cumulative_returns_wide_universe,
    "cumulative_returns_duplicates": q_cumulative_returns_duplicates,
    "quality_report_wide": q_quality_report_wide,
    "quality_violations": q_quality_violations,
    "linear_trend_wide": q_linear_trend_wide,
    "exchange_table_wide": q_exchange_table_wide,
    "price_range_1m": q_price_range_1m,
    "price_range_1y": q_price_range_1y,
    "price_log": q_price_log,
    "rolling_average_6m": q_rolling_average_6m,
    "incremental_overlap": q_incremental_overlap,
    "fx_overlap": q_fx_overlap,
    "bars_from_text": q_bars_from_text,
    "news_feed_keys": q_news_feed_keys,
    "currency_units": q_currency_units,
}
