"""Dimensions: currency lookup, FX pairs, date dimension, FX table, tickers
(S7, A5, C1, P10, G8, G9, J3, C4, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.text import pair_symbol
from .joins import salted_right_join


# Minor units that a price may be quoted in, and their size.
MINOR_UNITS = {"GBp": 0.01, "GBX": 0.01, "ZAc": 0.01, "ILA": 0.01}
MINOR_CODES = {"GBX": "GBP", "ILA": "ILS"}


def currency_dimension(currency: DataFrame) -> DataFrame:
    """S7 + C1: (ticker, currency_code) with the code upper-cased.

    Minor units (e.g. pence quoted as GBp) fold into the major code here, as
    in the source; `with_unit_factor` keeps their size.  Rule Q5 checks that a
    ticker has one code.
    """
    return currency.select("ticker", F.upper(F.trim("currency_code")).alias("currency_code"))


def with_unit_factor(currency: DataFrame) -> DataFrame:
    """The currency dimension with `unit_factor`: the share of the major unit
    that a quoted price counts in (0.01 for pence, else 1)."""
    raw = F.trim("currency_code")
    factors = F.create_map(*[F.lit(x) for kv in MINOR_UNITS.items() for x in kv])
    majors = F.create_map(*[F.lit(x) for kv in MINOR_CODES.items() for x in kv])
    return currency.select("ticker", F.coalesce(majors[raw], F.upper(raw)).alias("currency_code"),
                           F.coalesce(factors[raw], F.lit(1.0)).alias("unit_factor"))


def distinct_currencies(currency: DataFrame) -> DataFrame:
    """A5 + U2: the distinct upper-case codes in use."""
    return (currency.select(F.upper(F.trim("currency_code")).alias("currency_code"))
                    .where(F.col("currency_code").isNotNull()).distinct())


def fx_pairs(currency: DataFrame, base: str = "GBP") -> DataFrame:
    """P10 + C2: pair metadata for every code in use, quoted into `base`."""
    codes = distinct_currencies(currency)
    return codes.select(
        F.col("currency_code").alias("from_currency"),
        F.lit(base).alias("to_currency"),
        pair_symbol("currency_code", base).alias("pair_symbol"))


def scope_fx(fx: DataFrame, currency: DataFrame, base: str = "GBP") -> DataFrame:
    """Keep only the FX pairs the instrument universe needs.

    A left-semi join against the distinct codes, which adaptive execution
    broadcasts when it has measured them as small.
    """
    pairs = fx_pairs(currency, base).select("from_currency", "to_currency")
    return fx.join(pairs, ["from_currency", "to_currency"], "left_semi")


def date_dimension(dated: DataFrame, date_col: str = "date") -> DataFrame:
    """G8 + C3 + C5: one row per distinct date key with year, quarter, month."""
    d = dated.select(F.col(date_col).alias("d")).where(F.col("d").isNotNull()).distinct()
    return d.select(
        date_key("d").alias("date_key"),
        F.year("d").cast("bigint").alias("year"),
        F.quarter("d").cast("bigint").alias("quarter"),
        F.month("d").cast("bigint").alias("month"))


def exchange_table(currency: DataFrame, fx: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """G9 + J3 + C4: ticker-currency RIGHT JOIN FX on code = from_currency.

    One row per ticker and FX day; FX days of a code no ticker uses are kept
    with a NULL ticker.  The join key has few values, so codes with more than
    `rows_per_task` rows are cut by their size (see joins.salted_right_join).
    """
    cur = currency_dimension(currency)
    rates = fx.select(
        "from_currency", "to_currency", "date", "open",
        F.col("close").alias("currency_close"), "low", "high",
        F.concat(date_key("date"), F.col("from_currency")).alias("exchange_id"),
        date_key("date").alias("currency_date_key"))
    joined = salted_right_join(cur, rates, "currency_code", "from_currency", rows_per_task)
    return joined.select(
        "ticker", "currency_code", "date", "open", "currency_close", "low", "high",
        "from_currency", "to_currency", "exchange_id", "currency_date_key")


def ticker_master(bars: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """K4: the distinct instruments, those of a requested list included even
    when they have no history yet."""
    names = bars.select("ticker")
    if requested is not None:
        names = names.unionByName(requested.select("ticker"))
    return names.where(F.col("ticker").isNotNull()).distinct()
