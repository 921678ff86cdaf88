"""R1-R4, N1, S1-S8, holders, financials."""

import json

from pyspark.sql import functions as F

from helpers import d, bars
from marketlens.functions.text import flat_name
from marketlens.operators import reshape
from marketlens.sources import landing


def test_ticker_with_dot_gets_flat_column(spark):
    b = bars(spark, [("0293.HK", "2024-01-08", 5.0), ("IAG.L", "2024-01-08", 1.5)])
    w = reshape.pivot_measure(b, "close", ["0293.HK", "IAG.L"], prefix="Close")
    assert w.columns == ["date", "Close_0293_HK", "Close_IAG_L"]
    assert flat_name("Close", "AF.PA") == "Close_AF_PA"


def test_pivot_then_unstack_is_identity(spark):
    b = bars(spark, [("A", "2024-01-08", 1.0), ("B", "2024-01-08", 2.0),
                     ("A", "2024-01-09", 3.0)])
    wide = reshape.long_to_wide(b, ["A", "B"])
    back = reshape.wide_to_long(wide)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, b.select(
        "date", "ticker", "open", "high", "low", "close", "volume", "dividends").collect()))


def test_empty_news_list_and_missing_time(spark):
    items = [{"uuid": "1", "title": "t", "publisher": "p", "link": "l", "type": "STORY"},
             {"uuid": "2", "title": "u", "publisher": "p", "link": "m", "type": "STORY",
              "provider_publish_time": 1700000000}]
    df = spark.createDataFrame([("A", json.dumps(items)), ("B", "[]"), ("C", None)],
                               "ticker string, payload string")
    out = {r.uuid: r for r in reshape.explode_news(df).collect()}
    assert set(out) == {"1", "2"}
    assert out["1"].provider_publish_time is None
    assert out["2"].provider_publish_time == 1700000000


def test_transpose_financials(spark):
    st = spark.createDataFrame([("A", "revenue", 10.0, 20.0), ("A", "cost", 1.0, None)],
                               "ticker string, metric string, `2023-12-31` double, `2022-12-31` double")
    out = {str(r.date): r for r in reshape.transpose_financials(st, ["cost", "revenue"]).collect()}
    assert out["2023-12-31"].revenue == 10.0 and out["2022-12-31"].cost is None


def test_holders_positional_columns(spark):
    raw = spark.createDataFrame([("0.15%", "% of Shares Held by All Insider", "IAG.L")],
                                "_c0 string, _c1 string, _c2 string")
    r = landing.name_holders(raw).first()
    assert (r.ticker, r.percent, r.percent_value) == ("IAG.L", "0.15%", 0.15)


def test_read_bars_csv_normalises(spark, scratch):
    path = f"{scratch}/bars.csv"
    with open(path, "w") as fh:
        fh.write("Date,Open,High,Low,Close,Volume,Dividends,Stock\n")
        fh.write("2024-01-08,1,2,0.5,1.5,100,0,IAG.L\n")
        fh.write("2024-01-09,1,2,0.5,abc,100,0,IAG.L\n")
        fh.write(",1,2,0.5,1.5,100,0,IAG.L\n")
    schema = "Date string, Open string, High string, Low string, Close string, " \
             "Volume string, Dividends string, Stock string"
    raw = spark.read.option("header", "true").schema(schema).csv(path)
    from marketlens.operators.normalize import normalize_bars
    out = normalize_bars(raw).orderBy("date").collect()
    assert len(out) == 2 and out[0].ticker == "IAG.L" and out[1].close is None
    assert out[0].volume == 100


def test_read_wide_bars(spark, scratch):
    b = bars(spark, [("A", "2024-01-08", 1.0), ("B", "2024-01-09", 2.0)])
    reshape.long_to_wide(b, ["A", "B"]).write.parquet(f"{scratch}/wide")
    out = landing.read_wide_bars(spark, f"{scratch}/wide")
    assert out.count() == 2 and set(out.columns) >= {"ticker", "date", "close"}


def test_read_fx_unions_paths(spark, scratch):
    for code in ("USD", "EUR"):
        spark.createDataFrame([(code, "GBP", "2024-01-08", 1.0, 0.5, 0.4, 0.6)],
                              "from_currency string, to_currency string, date string, "
                              "open double, close double, low double, high double") \
            .withColumn("date", F.to_date("date")).write.parquet(f"{scratch}/fx_{code}")
    out = landing.read_fx(spark, [f"{scratch}/fx_USD", f"{scratch}/fx_EUR"])
    assert sorted(r.from_currency for r in out.collect()) == ["EUR", "USD"]


def test_read_bars_csv_by_header_name(spark, scratch):
    path = f"{scratch}/landing"
    import os
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as fh:
        fh.write("Date,Open,High,Low,Close,Volume,Dividends,Stock\n")
        fh.write("2024-01-08,1,2,0.5,1.5,100,0,IAG.L\n")
        fh.write("2024-01-09,1,2,0.5,NaN,100,0,IAG.L\n")
    out = landing.read_bars(spark, path, fmt="csv").orderBy("date").collect()
    assert [(r.ticker, str(r.date), r.close, r.volume) for r in out] == [
        ("IAG.L", "2024-01-08", 1.5, 100), ("IAG.L", "2024-01-09", None, 100)]


def test_read_fx_csv_by_header_name(spark, scratch):
    path = f"{scratch}/fx"
    import os
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as fh:
        fh.write("Date,Open,Close,Low,High,FromCurrency,ToCurrency\n")
        fh.write("2024-01-08,0.1,0.11,0.09,0.12,hkd,gbp\n")
    r = landing.read_fx(spark, [path], fmt="csv").first()
    assert (r.from_currency, r.to_currency, str(r.date), r.close) == ("HKD", "GBP", "2024-01-08", 0.11)


def test_read_wide_bars_and_statements_csv(spark, scratch):
    import os
    os.makedirs(f"{scratch}/w")
    with open(f"{scratch}/w/p.csv", "w") as fh:
        fh.write("date,A_close,A_open,B_close\n2024-01-08,1.5,1.0,\n2024-01-09,,,2.5\n")
    out = {(r.ticker, str(r.date)): r.close
           for r in landing.read_wide_bars(spark, f"{scratch}/w", fmt="csv").collect()}
    assert out == {("A", "2024-01-08"): 1.5, ("B", "2024-01-09"): 2.5}
    os.makedirs(f"{scratch}/s")
    with open(f"{scratch}/s/p.csv", "w") as fh:
        fh.write("ticker,metric,2023-12-31,2022-12-31\nA,revenue,10,20\n")
    st = landing.read_financial_statements(spark, f"{scratch}/s", ["revenue"], fmt="csv")
    assert sorted((str(r.date), r.revenue) for r in st.collect()) == [
        ("2022-12-31", 20.0), ("2023-12-31", 10.0)]


def test_wide_file_with_title_case_measures(spark, scratch):
    from marketlens.sources.landing import read_wide_bars
    wide = spark.createDataFrame([("2024-01-08", 1.5, 100, 7.0), ("2024-01-09", None, None, 8.0)],
                                 "Date string, `IAG.L_Close` double, `IAG.L_Volume` long, `AF.PA_Close` double")
    wide.write.parquet(f"{scratch}/wide")
    got = {(r.ticker, str(r.date)): (r.close, r.volume) for r in read_wide_bars(spark, f"{scratch}/wide").collect()}
    assert got == {("IAG.L", "2024-01-08"): (1.5, 100), ("AF.PA", "2024-01-08"): (7.0, None),
                   ("AF.PA", "2024-01-09"): (8.0, None)}


def test_wide_file_without_measures_is_refused(spark):
    import pytest
    with pytest.raises(ValueError, match="measure"):
        reshape.wide_to_long(spark.createDataFrame([("2024-01-08", 1.0)], "date string, x_price double"))


def test_unreadable_and_large_volumes(spark):
    from marketlens.operators.normalize import normalize_bars
    texts = ["1e30", "n/a", "12.6", "1e3", "9007199254740993", "", "-5"]
    raw = spark.createDataFrame([("A", f"2024-01-{i + 1:02d}", v) for i, v in enumerate(texts)],
                                "Ticker string, Date string, Volume string")
    got = [r.volume for r in normalize_bars(raw).orderBy("date").collect()]
    assert got == [None, None, 13, 1000, 9007199254740993, None, -5]


def test_statement_dates_without_values_give_no_rows(spark):
    st = spark.createDataFrame([("A", "cost", 1.0, None), ("A", "revenue", 2.0, None), ("B", "cost", None, 3.0)],
                               "ticker string, metric string, `2020-12-31` double, `2021-12-31` double")
    rows = sorted((r.ticker, str(r.date), r.cost, r.revenue)
                  for r in reshape.transpose_financials(st, ["cost", "revenue"]).collect())
    assert rows == [("A", "2020-12-31", 1.0, 2.0), ("B", "2021-12-31", 3.0, None)]
    assert reshape.statement_long(st).count() == 3


def test_news_time_under_the_feeds_key_and_rejected_payloads(spark):
    rows = [("A", '[{"uuid": "1", "providerPublishTime": 7}, {"uuid": "2", "provider_publish_time": 8}]'),
            ("A", "not json"), ("A", None), ("A", "[]")]
    df = spark.createDataFrame(rows, "ticker string, payload string")
    assert {r.uuid: r.provider_publish_time for r in reshape.explode_news(df).collect()} == {"1": 7, "2": 8}
    assert [r.payload for r in reshape.news_rejects(df).collect()] == ["not json"]


def test_tickers_that_share_a_flat_name_are_refused(spark):
    import pytest
    df = spark.createDataFrame([("BRK.B", "2024-01-08", 1.0)], "ticker string, date string, close double")
    with pytest.raises(ValueError, match="share"):
        reshape.pivot_measure(df, "close", ["BRK.B", "BRK_B"])



def test_variants_keep_keys_that_no_schema_names(spark, scratch):
    from marketlens.operators import reshape
    payloads = spark.createDataFrame([
        ("A", '[{"uuid": "1", "mood": 0.5, "tags": ["x", "y"]}, {"uuid": "2", "mood": "bad", "a.b": 7}]'),
        ("B", "[]"), ("C", None), ("D", "{not json")], "ticker string, payload string")
    reshape.news_variants(payloads).write.parquet(f"{scratch}/news")
    got = reshape.variant_fields(spark.read.parquet(f"{scratch}/news"), "item",
                                 {"mood": "double", "tags": "array<string>", "a.b": "long"}).collect()
    assert sorted((r.ticker, r.uuid, r.mood, r.tags, r["a.b"]) for r in got) == [
        ("A", "1", 0.5, ["x", "y"], None), ("A", "2", None, None, 7)]
    long = spark.createDataFrame([("A", "Net Income", d("2024-12-31"), 5.0), ("A", "Odd line", d("2024-12-31"), 2.0),
                                  ("A", "Odd line", d("2024-12-31"), 3.0), ("A", "x", d("2023-12-31"), None)],
                                 "ticker string, metric string, date date, value double")
    out = reshape.variant_fields(reshape.statement_variants(long), "items", {"Odd line": "double", "none": "double"})
    assert [tuple(r) for r in out.collect()] == [("A", d("2024-12-31"), 3.0, None)]
