"""The enriched master frame (G6): J1, J2, P9, P8, L1 and A4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_weekday, weekday
from ..functions.exact import convert
from .dims import currency_dimension

BASE_CURRENCY = "GBP"


def attach_currency(bars: DataFrame, currency: DataFrame) -> DataFrame:
    """Bars LEFT JOIN instrument currency on ticker (codes upper-cased).

    A dimension that has `unit_factor` (see `dims.with_unit_factor`) brings it
    along, and `apply_rate` then converts prices quoted in minor units.
    """
    if "unit_factor" in currency.columns:
        return bars.join(currency.select("ticker", "currency_code", "unit_factor"), "ticker", "left")
    return bars.join(currency_dimension(currency), "ticker", "left")


def attach_fx(bars: DataFrame, fx: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """LEFT JOIN the FX close on (date, currency_code = from_currency).

    FX must be unique on (from_currency, date) or rows multiply (rule Q2).
    Only pairs quoted into `base` are used.  The raw rate stays in `fx_close`.
    """
    rates = (fx.where(F.upper("to_currency") == base)
               .select(F.col("date").alias("_fx_date"),
                       F.upper("from_currency").alias("_fx_from"),
                       F.col("close").try_cast("double").alias("fx_close")))
    rates = rates.withColumn("fx_close", F.when(~F.isnan("fx_close"), F.col("fx_close")))
    joined = bars.join(
        rates,
        (bars["date"] == rates["_fx_date"]) & (bars["currency_code"] == rates["_fx_from"]),
        "left")
    return joined.drop("_fx_date", "_fx_from")


def apply_rate(df: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """P9 then P8: base-currency rows take rate 1, then close x rate.

    The override comes first so base-currency prices never use a missing or
    odd quote.  The product is exact (decimal); see functions.exact.
    """
    rate = F.when(F.col("currency_code").isin(base), F.lit(1.0)).otherwise(F.col("fx_close"))
    df = df.withColumn("rate", rate)
    price = F.col("close") * F.col("unit_factor") if "unit_factor" in df.columns else F.col("close")
    return df.withColumn("converted_close", convert(price, "rate"))


def enrich_prices(bars: DataFrame, currency: DataFrame, fx: DataFrame,
                  base: str = BASE_CURRENCY, weekdays_only: bool = True) -> DataFrame:
    """Bars + currency + FX rate + converted close, weekdays only.

    Catalyst moves the weekday filter below both joins into the scans.
    """
    df = attach_fx(attach_currency(bars, currency), fx, base)
    df = apply_rate(df, base).withColumn("day", weekday("date"))
    if weekdays_only:
        df = df.where(is_weekday("date"))
    return df


def fx_coverage(enriched: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A4 (+ C13): share of rows without a raw FX rate, in percent.

    Counted on the rate before the base-currency override, as the source
    does; `unconverted_rows` counts rows whose final rate is still missing.
    """
    by = by or []
    agg = enriched.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.col("fx_close").isNull().cast("long")).alias("missing_rate_rows"),
        F.sum(F.col("rate").isNull().cast("long")).alias("unconverted_rows"),
    )
    return agg.withColumn(
        "missing_rate_pct",
        F.try_divide(F.col("missing_rate_rows") * 100.0, F.col("total_rows")))

