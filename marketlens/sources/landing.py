"""Landing-file readers.

Every reader takes an explicit schema (no inference) and returns a table in
the market schema.  All tickers are read in one scan; the format is any
Spark file source (parquet, csv, json, orc).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import (LOAD_MARKS, normalize_bars, normalize_fx, one_per_key, to_date, union_all,
                                   with_load_marks)
from ..operators.reshape import explode_news, news_rejects, statement_long, transpose_financials, wide_to_long
from ..schemas import BARS, CURRENCY, FX, NEWS_PAYLOAD


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None):
    """CSV is read by header name with every column as text (a CSV schema
    would be applied by position); other formats take the schema."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        return r.option("header", "true").option("inferSchema", "false")
    if schema is not None:
        r = r.schema(schema)
    return r


def _as_text(schema: T.StructType) -> T.StructType:
    """Landing schema with every field as text; values are coerced later."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_bars(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
              schema: T.StructType | None = None) -> DataFrame:
    """Daily history of every ticker in one scan, normalised.

    Text formats are read as strings and coerced (bad numbers become NULL).
    """
    if schema is None:
        schema = BARS if fmt in ("parquet", "orc") else _as_text(BARS)
    return _newest(_reader(spark, fmt, schema).load(path), normalize_bars, ["ticker", "date"])


def _newest(raw: DataFrame, normalize, keys: list[str]) -> DataFrame:
    """Normalised rows, one per key: overlapping pulls repeat days, and the row
    of the file written last wins."""
    return one_per_key(normalize(with_load_marks(raw), keep=[*LOAD_MARKS]), keys, [*LOAD_MARKS])


def read_holders(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    """Holder rows with two positional columns and a ticker column."""
    raw = spark.read.format(fmt).option("header", "false" if fmt == "csv" else "true").load(path)
    return name_holders(raw)


def name_holders(raw: DataFrame) -> DataFrame:
    """P4 + P3: name the positional columns; parse the percent text."""
    cols = raw.columns
    df = raw.toDF("percent", "detail", *cols[2:])
    if "ticker" not in df.columns:
        for alias in ("stock", "symbol", "_c2"):
            if alias in df.columns:
                df = df.withColumnRenamed(alias, "ticker")
                break
    pct = F.regexp_replace(F.trim("percent"), "%$", "").try_cast("double")
    return df.select("ticker", F.col("percent").cast("string").alias("percent"),
                     F.col("detail").cast("string").alias("detail"),
                     pct.alias("percent_value"))


def read_financial_statements(spark: SparkSession, path: str | list[str],
                              metrics: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """S3: statements (ticker, metric, one column per date) as long rows
    (ticker, metric, date, value), or, with a metric list, one row per date."""
    raw = _reader(spark, fmt, None).load(path)
    return statement_long(raw) if metrics is None else transpose_financials(raw, metrics)


def read_news(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """(ticker, JSON payload) files -> one row per news item."""
    return explode_news(_reader(spark, fmt, NEWS_PAYLOAD).load(path))


def read_news_rejects(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """The payloads that hold no readable list of items."""
    return news_rejects(_reader(spark, fmt, NEWS_PAYLOAD).load(path))


def read_fx(spark: SparkSession, paths: list[str], fmt: str = "parquet",
            to_currency: str | None = None) -> DataFrame:
    """S6 + U1: FX history; several landing paths are unioned by name."""
    schema = FX if fmt in ("parquet", "orc") else _as_text(FX)
    frames = [with_load_marks(_reader(spark, fmt, schema).load(p)) for p in paths]
    rows = normalize_fx(union_all(frames), to_currency, keep=[*LOAD_MARKS])
    return one_per_key(rows, ["from_currency", "to_currency", "date"], [*LOAD_MARKS])


def read_currency(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """The instrument currency dimension."""
    return _reader(spark, fmt, CURRENCY).load(path)


def read_wide_bars(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Bulk file with `<ticker>_<measure>` columns, stacked to long."""
    wide = _reader(spark, fmt, None).load(path)
    key = next((c for c in wide.columns if c.lower() == "date"), "date")
    wide = wide.withColumn(key, to_date(key)).withColumnRenamed(key, "date")
    return normalize_bars(wide_to_long(wide))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view."""
    return spark.table(name)
