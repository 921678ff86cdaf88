"""G6 (J1, J2, P8, P9, L1, A4), dimensions (G8, G9, J3, A5, P10), quality."""

from pyspark.sql import functions as F

from helpers import bars, currency, fx
from marketlens.operators import dims, enrich, quality


def test_weekend_bars_removed(spark):
    b = bars(spark, [("A", "2024-01-05", 10.0), ("A", "2024-01-06", 11.0),
                     ("A", "2024-01-07", 12.0), ("A", "2024-01-08", 13.0)])
    out = enrich.enrich_prices(b, currency(spark, [("A", "gbp")]), fx(spark, []))
    assert sorted(str(r.date) for r in out.collect()) == ["2024-01-05", "2024-01-08"]


def test_gbp_without_fx_row_takes_rate_one_but_counts_missing(spark):
    b = bars(spark, [("A", "2024-01-08", 10.0), ("B", "2024-01-08", 20.0)])
    cur = currency(spark, [("A", "gbp"), ("B", "usd")])
    out = enrich.enrich_prices(b, cur, fx(spark, [("USD", "2024-01-08", 0.5)]))
    rows = {r.ticker: r for r in out.collect()}
    assert rows["A"].rate == 1.0 and float(rows["A"].converted_close) == 10.0
    assert rows["A"].currency_code == "GBP"  # upper-cased
    assert float(rows["B"].converted_close) == 10.0
    cov = enrich.fx_coverage(out).first()
    assert cov.missing_rate_rows == 1 and cov.unconverted_rows == 0
    assert cov.missing_rate_pct == 50.0


def test_override_happens_before_multiply(spark):
    # A GBP ticker with an odd GBP quote must still convert at 1
    b = bars(spark, [("A", "2024-01-08", 10.0)])
    out = enrich.enrich_prices(b, currency(spark, [("A", "GBP")]),
                               fx(spark, [("GBP", "2024-01-08", 0.01)])).first()
    assert out.fx_close == 0.01 and out.rate == 1.0 and float(out.converted_close) == 10.0


def test_nan_and_bad_text_rates_become_null(spark):
    from marketlens.operators.normalize import normalize_fx
    raw = spark.createDataFrame(
        [("usd", "gbp", "2024-01-08", "NaN"), ("eur", "gbp", "2024-01-08", "abc"),
         ("hkd", "gbp", "2024-01-08", "0.1")],
        "FromCurrency string, ToCurrency string, Date string, Close string")
    out = {r.from_currency: r.close for r in normalize_fx(raw).collect()}
    assert out == {"USD": None, "EUR": None, "HKD": 0.1}


def test_fx_join_keeps_left_row_count(spark):
    b = bars(spark, [("A", f"2024-01-{d:02d}", 1.0) for d in range(8, 13)])
    out = enrich.enrich_prices(b, currency(spark, [("A", "usd")]),
                               fx(spark, [("USD", "2024-01-09", 0.8), ("EUR", "2024-01-09", 0.9)]))
    assert out.count() == 5
    assert out.where(F.col("rate").isNull()).count() == 4


def test_duplicate_fx_key_reported(spark):
    f = fx(spark, [("USD", "2024-01-08", 0.8), ("USD", "2024-01-08", 0.81)])
    b = bars(spark, [("A", "2024-01-08", 100.0), ("A", "2024-01-09", 0.0),
                     ("A", "2024-01-10", 50.0)])
    rep = {r.rule: (r.violations, r.passed) for r in quality.quality_report(b, f).collect()}
    assert rep["fx_unique_currency_date"] == (1, False)
    assert rep["close_positive"] == (1, False)
    assert rep["bars_unique_ticker_date"] == (0, True)


def test_three_currencies_every_fx_row_keeps_its_date(spark):
    # With any number of currencies every FX row keeps its date
    f = fx(spark, [("GBP", "2024-01-08", 1.0), ("HKD", "2024-01-08", 0.1),
                   ("EUR", "2024-01-09", 0.86), ("JPY", "2024-01-09", 0.005)])
    cur = currency(spark, [("A", "gbp"), ("B", "hkd"), ("C", "eur"), ("D", "eur")])
    for rows in (1, 2, 1_000_000):
        t = dims.exchange_table(cur, f, rows_per_task=rows).collect()
        assert all(r.date is not None for r in t)
        assert len(t) == 5  # EUR has two tickers; JPY has none and is kept
        jpy = [r for r in t if r.from_currency == "JPY"][0]
        assert jpy.ticker is None and jpy.exchange_id == "01092024JPY"


def test_date_dimension_one_row_per_date(spark):
    # One row per date, not one per (currency, date)
    f = fx(spark, [("GBP", "2024-03-18", 1.0), ("HKD", "2024-03-18", 0.1)])
    rows = dims.date_dimension(f).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.date_key, r.year, r.quarter, r.month) == ("03182024", 2024, 1, 3)


def test_fx_pairs_distinct_upper(spark):
    cur = currency(spark, [("A", "gbp"), ("B", "GBP"), ("C", "usd")])
    rows = sorted((r.from_currency, r.pair_symbol) for r in dims.fx_pairs(cur).collect())
    assert rows == [("GBP", "GBPGBP=X"), ("USD", "USDGBP=X")]


def test_coverage_rule_threshold(spark):
    b = bars(spark, [("A", "2024-01-08", 1.0), ("A", "2024-01-09", 1.0)])
    cur, rates = currency(spark, [("A", "usd")]), fx(spark, [("USD", "2024-01-08", 0.5)])

    def rule(limit):
        return {r.rule: r for r in quality.quality_report(b, rates, cur, limit).collect()}["fx_coverage"]

    r = rule(40.0)
    assert r.violations == 1 and r.passed is False
    assert rule(60.0).passed is True


def test_wide_rates_convert_and_lost_ones_are_counted(spark):
    b = bars(spark, [("A", "2024-01-08", 10.0), ("A", "2024-01-09", 10.0), ("A", "2024-01-10", 10.0),
                     ("A", "2024-01-11", 2e12)])
    cur = currency(spark, [("A", "usd")])
    rates = fx(spark, [("USD", "2024-01-08", 1e12), ("USD", "2024-01-09", 2e-11), ("USD", "2024-01-10", 1e30),
                       ("USD", "2024-01-11", 0.5)])
    got = {str(r.date): r.converted_close for r in enrich.enrich_prices(b, cur, rates).collect()}
    assert got["2024-01-10"] is None  # beyond the amount type, and counted:
    assert [float(got[f"2024-01-{d}"]) for d in ("08", "09", "11")] == [1e13, 2e-10, 1e12]
    lost = {r.rule: r.violations for r in quality.quality_report(b, rates, cur).collect()}
    assert lost["conversion_lost"] == 1


def test_prices_in_pence_convert_by_their_unit(spark):
    cur = dims.with_unit_factor(currency(spark, [("L", "GBp"), ("P", "GBP")]))
    b = bars(spark, [("L", "2024-01-08", 250.0), ("P", "2024-01-08", 2.5)])
    out = enrich.enrich_prices(b, cur, fx(spark, []))
    assert {r.ticker: float(r.converted_close) for r in out.collect()} == {"L": 2.5, "P": 2.5}


def _code_sizes(spark, dim, fact, rows_per_task):
    from marketlens.operators.joins import SALT, salted_right_join, salted_sides
    d, f = salted_sides(dim, fact, "code", "from_code", rows_per_task)
    pieces = d.groupBy("code", SALT).count().withColumnRenamed("count", "d").join(
        f.groupBy(F.col("from_code").alias("code"), SALT).count(), ["code", SALT])
    joined = salted_right_join(dim, fact, "code", "from_code", rows_per_task)
    return joined, [r.n for r in pieces.select((F.col("d") * F.col("count")).alias("n")).collect()]


def test_only_heavy_codes_are_cut_and_each_by_its_size(spark):
    # One code holds nine tenths of the instruments; another has most days.
    dim = spark.range(3000).select("id", F.when(F.col("id") % 10 > 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("C"), F.col("id") % 7)).alias("code"))
    fact = spark.range(4000).select(F.col("id").alias("day"), F.when(F.col("id") < 400, F.lit("HOT")).when(
        F.col("id") < 3000, F.lit("C0")).otherwise(F.concat(F.lit("C"), F.col("id") % 9)).alias("from_code"))
    joined, sizes = _code_sizes(spark, dim, fact, 20_000)
    plain = dim.join(fact, dim["code"] == fact["from_code"], "right")
    assert sorted(map(tuple, joined.select("id", "day").na.fill(-1).collect())) == sorted(
        map(tuple, plain.select("id", "day").na.fill(-1).collect()))
    heavy = [n for n in sizes if n > 10_000]
    assert len(heavy) > 50 and max(sizes) < 2 * sorted(heavy)[len(heavy) // 2]
    none, whole = _code_sizes(spark, dim, fact, 10**9)
    assert len(whole) <= 9 and none.count() == joined.count()


def test_exchange_table_without_any_lines(spark, tmp_path):
    from conftest import SF_SMALL
    from marketlens.plans import queries as Q
    for name in ("lineitem", "orders"):
        t = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        (t.limit(0) if name == "lineitem" else t).write.parquet(f"{tmp_path}/{name}.parquet")
    out = Q.q_exchange_table(spark, str(tmp_path))
    assert out.count() > 0 and out.where("ticker is not null").count() == 0
    assert Q.q_fx_rates(spark, str(tmp_path)).count() == 0
