"""Incremental loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BAR_MEASURES, BARS
from .normalize import LOAD_MARKS, one_per_key

KEYS = ["ticker", "date"]


def last_update(history: DataFrame) -> DataFrame:
    """S9 + A3 + K6: latest stored date per ticker.

    This replaces the state file: the watermark is derived from the target,
    keyed by equality on ticker (L5), and typed as a date.
    """
    return history.groupBy("ticker").agg(F.max("date").alias("last_date"))


def last_update_from_files(spark: SparkSession, path: str) -> DataFrame:
    """S9 + K6 without reading a row: latest date per ticker of a parquet table
    partitioned by ticker, from the statistics in the file footers.

    Aggregates reach the footers only through Spark's second-generation
    parquet reader; a session of its own switches it on, so the caller's
    settings stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return last_update(own.read.schema(BARS).parquet(path).select("ticker", "date"))


def one_per_day(incoming: DataFrame, end: str | None = None) -> DataFrame:
    """L7 and overlapping pulls: the increment's days before `end`, one bar per
    (ticker, date).  Where it has the load marks (file time, file name) the bar
    that was written last wins, so a correction beats what it corrects."""
    if end is not None:
        incoming = incoming.where(F.col("date") < F.to_date(F.lit(end)))
    return one_per_key(incoming, KEYS, [c for c in LOAD_MARKS if c in incoming.columns])


def _concerned(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The part of the target in the increment's years.  On a table partitioned
    by `year` this is a partition filter, evaluated before files are listed for
    reading: a set of years, one value per calendar year at most."""
    if "year" not in target.columns:
        return target
    years = rows.select(F.collect_set(F.year("date"))).scalar()
    return target.where(F.array_contains(years, F.col("year")))


def new_bars(target: DataFrame, incoming: DataFrame, end: str | None = None) -> DataFrame:
    """S5 + J5 + L7: incoming bars not yet stored, safe to re-run.

    A bar is new if the target has no bar of its (ticker, date): the overlap day
    is not appended again, and a day that arrives late, behind a ticker's last
    stored one, is.  The target is read for its keys only, and only in the
    increment's years where it is partitioned by `year`.
    """
    rows = one_per_day(incoming, end)
    return rows.join(_concerned(target, rows).select(*KEYS), KEYS, "left_anti")


def corrected_bars(target: DataFrame, incoming: DataFrame, end: str | None = None) -> DataFrame:
    """Incoming bars that the target has with other values: they replace those."""
    rows = one_per_day(incoming, end)
    stored = _concerned(target, rows).select(*KEYS, F.struct(*BAR_MEASURES).alias("_stored"))
    return (rows.join(stored, KEYS).where(~F.struct(*BAR_MEASURES).eqNullSafe(F.col("_stored")))
                .drop("_stored"))


def append_new_bars(target: DataFrame, incoming: DataFrame, end: str | None = None) -> DataFrame:
    """The table after the load: target plus new bars."""
    return target.unionByName(new_bars(target, incoming, end))


def merge_bars(target: DataFrame, incoming: DataFrame, end: str | None = None) -> DataFrame:
    """The table after the load: target, new bars, and corrected ones replaced."""
    rows = one_per_day(incoming, end)
    return target.join(rows.select(*KEYS), KEYS, "left_anti").unionByName(rows)
