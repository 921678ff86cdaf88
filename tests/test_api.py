"""Job-level API over landing files built from the driver tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import bars
from marketlens.api import LandingPaths, MarketETL, MarketExplorer
from marketlens.functions.text import fixed2, joined_names
from marketlens.operators import forecast as fc
from marketlens.sources import fixtures as fx


def _landing(spark, root):
    b = fx.dense_bars(spark, SF_SMALL)
    b.where("date <= '2000-12-31'").write.parquet(f"{root}/bars1")
    b.where("date >= '2000-12-31'").write.parquet(f"{root}/bars2")
    fx.dense_currency(spark, SF_SMALL).write.parquet(f"{root}/currency")
    f = fx.dense_fx(spark, SF_SMALL)
    for code in ("GBP", "HKD", "EUR"):
        f.where(F.col("from_currency") == code).write.parquet(f"{root}/fx_{code}")
    fx.news_payloads(spark, SF_SMALL).write.parquet(f"{root}/news")
    return b


def test_etl_full_refresh_update_and_fx_tables(spark, scratch):
    b = _landing(spark, scratch)
    fxp = [f"{scratch}/fx_{c}" for c in ("GBP", "HKD", "EUR")]
    out = f"{scratch}/db"
    etl = MarketETL(spark, LandingPaths(f"{scratch}/bars1", f"{scratch}/currency", fxp,
                                        news=f"{scratch}/news"))
    etl.full_refresh(out)
    etl.full_refresh(out)  # a re-run replaces, never duplicates
    assert etl.table(out, "stocks_master").count() == 3
    n1 = etl.table(out, "stock_history").count()
    assert n1 == b.where("date <= '2000-12-31'").count()
    assert etl.table(out, "news").count() > 0
    upd = MarketETL(spark, LandingPaths(f"{scratch}/bars2", f"{scratch}/currency", fxp))
    upd.update_history(out)
    upd.update_history(out)  # idempotent
    hist = upd.stored_history(out)
    assert hist.count() == b.count()
    assert hist.groupBy("ticker", "date").count().where("count > 1").count() == 0
    etl.exchange_rate_tables(out)
    assert etl.table(out, "exchange_table").count() == fx.dense_fx(spark, SF_SMALL).count()
    dd = etl.table(out, "date_dimension")
    assert dd.count() == dd.select("date_key").distinct().count()


def test_explorer_reports(spark):
    ex = MarketExplorer(spark, fx.dense_bars(spark, SF_SMALL), fx.dense_currency(spark, SF_SMALL),
                        fx.dense_fx(spark, SF_SMALL), materialize=True)
    price = ex.stock_price().collect()
    assert [r.date for r in price] == sorted(r.date for r in price)
    assert ex.trade_volume().count() == ex.master.count()
    assert ex.volatility().agg(F.sum("count")).first()[0] > 0
    wide = ex.cumulative_returns(["A", "N", "R"])
    assert wide.columns == ["date", "Close_A", "Close_N", "Close_R"]
    assert ex.yearly().count() > 0
    assert ex.rolling_average().count() >= 0
    f = ex.future_trend(start_date="1999-01-01", periods=10, cap=150000.0)
    assert f.where("is_future").count() > 0
    err = ex.forecast_errors(f, "1999-01-01").collect()
    assert len(err) == 3 and all(r.mae >= 0 for r in err)


def test_per_ticker_cap(spark):
    train = bars(spark, [("A", f"2024-01-{d:02d}", 50.0 + d) for d in range(1, 29)]) \
        .select("ticker", F.col("date").alias("ds"), F.col("close").alias("y"),
                F.lit("USD").alias("currency_code"))
    limits = spark.createDataFrame([("A", 60.0, 40.0)], "ticker string, cap double, floor double")
    out = fc.forecast(train, 5, fc.ModelParams(growth="logistic", cap=1000.0),
                      limits=limits).toPandas()
    assert (out.trend <= 60.0).all() and (out.trend >= 40.0).all()


def test_text_helpers(spark):
    r = spark.range(1).select(fixed2(F.lit(10.256)).alias("a"), fixed2(F.lit(3)).alias("b")).first()
    assert (r.a, r.b) == ("10.26", "3.00")
    names = spark.createDataFrame([(["IAG.L", "AF.PA", "IAG.L"],)], "t array<string>")
    assert names.select(joined_names("t")).first()[0] == "AF.PA IAG.L"
