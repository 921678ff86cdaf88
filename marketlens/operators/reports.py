"""Yearly report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import exact_avg

MEASURES = ("open", "close", "high", "low")


def yearly_report(spark: SparkSession, history: DataFrame) -> DataFrame:
    """Per ticker and calendar year the mean of each price measure.

    One aggregate with map-side partial sums; means are exact up to the final
    division, whatever the order of the rows.
    """
    by_year = history.groupBy(F.year("date").cast("bigint").alias("year"), "ticker")
    return by_year.agg(*[exact_avg(m).alias(f"avg_{m}") for m in MEASURES])


def create_yearly_view(spark: SparkSession, history: DataFrame,
                       name: str = "yearly_stock") -> DataFrame:
    """K7: publish the report as a named temporary view."""
    df = yearly_report(spark, history)
    df.createOrReplaceTempView(name)
    return df
