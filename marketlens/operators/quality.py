"""Data-quality rules (Q1-Q5 and lost conversions): (rule, violations, passed).

Bars and rates are each aggregated once to their keys, and all rules read
those aggregates, so no rule adds a scan of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_weekday
from .enrich import BASE_CURRENCY, apply_rate, attach_fx


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Extra rows beyond one per key (0 when the key is unique)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("v"))


def q2_fx_unique(fx: DataFrame) -> DataFrame:
    """Q2: FX is unique on (from_currency, to_currency, date)."""
    return _rules(duplicate_keys(fx, ["from_currency", "to_currency", "date"]),
                  [("fx_unique_currency_date", F.col("v"), F.col("v") == 0)])


def q5_currency_unique(currency: DataFrame) -> DataFrame:
    """Q5: every ticker has one currency code, or J1 multiplies its bars."""
    codes = currency.select("ticker", F.upper(F.trim("currency_code")).alias("code")).distinct()
    return _rules(duplicate_keys(codes, ["ticker"]),
                  [("currency_unique_ticker", F.col("v"), F.col("v") == 0)])


def _rules(agg: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """One row per rule out of a one-row aggregate."""
    rows = [F.struct(F.lit(name).alias("rule"), F.coalesce(v, F.lit(0)).cast("bigint").alias("violations"),
                     F.coalesce(ok, F.lit(True)).alias("passed")) for name, v, ok in rules]
    return agg.select(F.inline(F.array(*rows)))


def quality_report(bars: DataFrame, fx: DataFrame, currency: DataFrame | None = None,
                   max_missing_pct: float = 20.0, base: str = BASE_CURRENCY) -> DataFrame:
    """Q1-Q3, and with the currency dimension Q4, Q5 and lost conversions.

    Q1 bars are unique on (ticker, date); Q2 rates on (from, to, date); Q3
    every present close is > 0; Q4 the weekday bars without a rate stay under
    `max_missing_pct` percent; Q5 a ticker has one currency; conversion_lost
    counts prices that have a rate but no converted price.
    """
    keyed = bars.groupBy("ticker", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("close") <= 0).cast("long")).alias("bad"),
        F.max("close").alias("close"))
    rates = fx.groupBy("from_currency", "to_currency", "date").agg(
        F.count(F.lit(1)).alias("n"), F.max("close").alias("close"))
    sums = [F.sum(F.col("n") - 1).alias("dup"), F.sum("bad").alias("bad")]
    rules = [("bars_unique_ticker_date", F.col("dup"), F.coalesce(F.col("dup"), F.lit(0)) == 0),
             ("close_positive", F.col("bad"), F.coalesce(F.col("bad"), F.lit(0)) == 0)]
    fx_rule = _rules(rates.agg(F.sum(F.col("n") - 1).alias("v")),
                     [("fx_unique_currency_date", F.col("v"), F.coalesce(F.col("v"), F.lit(0)) == 0)])
    if currency is None:
        return _rules(keyed.agg(*sums), rules).unionByName(fx_rule)
    codes = (currency.groupBy("ticker").agg(F.max(F.upper(F.trim("currency_code"))).alias("currency_code")))
    master = apply_rate(attach_fx(keyed.join(codes, "ticker", "left"), rates.drop("n"), base), base)
    days = F.when(is_weekday("date"), F.col("n")).otherwise(0)
    agg = master.agg(*sums, F.sum(days).alias("days"),
                     F.sum(F.when(F.col("rate").isNull(), days).otherwise(0)).alias("unrated"),
                     F.sum(F.when(F.col("rate").isNotNull() & F.col("close").isNotNull()
                                  & F.col("converted_close").isNull(), F.col("n")).otherwise(0)).alias("lost"))
    rules += [("fx_coverage", F.col("unrated"),
               F.try_divide(F.col("unrated") * 100.0, F.col("days")) <= max_missing_pct),
              ("conversion_lost", F.col("lost"), F.coalesce(F.col("lost"), F.lit(0)) == 0)]
    return _rules(agg, rules).unionByName(fx_rule).unionByName(q5_currency_unique(currency))
