"""Projection and conversion operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BAR_COLUMNS, BARS, FX, FX_COLUMNS

# When a landing row was written, and in which file; the greatest is the newest.
LOAD_MARKS = ("_file_time", "_file")

# Column names that mean the instrument in landing files.
TICKER_ALIASES = ("ticker", "stock", "symbol")


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def to_number(c: Column | str, dtype: str = "double") -> Column:
    """Coerce to a number; bad text and NaN become NULL."""
    col = F.col(c) if isinstance(c, str) else c
    num = col.try_cast(dtype)
    if dtype in ("double", "float"):
        num = F.when(~F.isnan(num), num)
    return num


def to_whole(c: Column, dtype: T.DataType) -> Column:
    """P6 for whole numbers: digits beyond a double's are kept, text such as
    "12.6" or "1e3" is rounded, and what the type cannot hold becomes NULL."""
    wide = c.try_cast("decimal(38,6)")
    return F.coalesce(c.cast("string").try_cast(dtype), F.round(wide, 0).try_cast(dtype),
                      F.round(to_number(c, "double"), 0).try_cast("decimal(38,0)").try_cast(dtype))


def to_date(c: Column | str) -> Column:
    """P5: date from a date, timestamp or text column."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.try_cast("date"), F.to_date(F.try_to_timestamp(col.cast("string"))))


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """P2 + P5 + P6 + P7: fixed column list, each cast to its schema type.

    Missing optional columns take the default (or NULL).
    """
    defaults = defaults or {}
    out = []
    src_types = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name in df.columns:
            src = F.col(f.name)
            same = src_types[f.name] == f.dataType
            if same and not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                v = src
            elif isinstance(f.dataType, T.DateType):
                v = to_date(src)
            elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                v = to_number(src, "double")
            elif isinstance(f.dataType, (T.LongType, T.IntegerType)):
                v = to_whole(src, f.dataType)
            elif isinstance(f.dataType, T.StringType):
                v = src.cast("string")
            else:
                v = src.cast(f.dataType)
        else:
            v = F.lit(defaults.get(f.name)).cast(f.dataType)
        out.append(v.alias(f.name))
    return df.select(*out)


def normalize_bars(raw: DataFrame, keep: list[str] = ()) -> DataFrame:
    """S1 normaliser: lower-case names, one ticker column, BARS schema.

    Rows without a ticker or a date cannot be keyed and are rejected.  Columns
    in `keep` stay as they are (load times, for `one_per_key`).
    """
    df = lower_columns(raw)
    for alias in TICKER_ALIASES[1:]:
        if alias in df.columns and "ticker" not in df.columns:
            df = df.withColumnRenamed(alias, "ticker")
    out = conform(df, T.StructType(BARS.fields + [df.schema[c] for c in keep]), defaults={"dividends": 0.0})
    return out.where(F.col("ticker").isNotNull() & F.col("date").isNotNull()).select(*BAR_COLUMNS, *keep)


def one_per_key(df: DataFrame, keys: list[str], newest: list[str] = ()) -> DataFrame:
    """One row per key where loads overlap: the greatest by the `newest`
    columns (file time, file name), then by the values themselves, so the
    choice does not depend on row order.  One aggregate that combines before
    its shuffle; the `newest` columns are dropped."""
    rest = [c for c in df.columns if c not in keys and c not in newest]
    best = F.max(F.struct(*newest, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[
        F.col(c) if c in keys else F.col(f"_best.{c}").alias(c)
        for c in df.columns if c not in newest])


def with_load_marks(raw: DataFrame) -> DataFrame:
    """Rows of a file source with the time and name of their file."""
    return raw.select("*", F.col("_metadata.file_modification_time").alias(LOAD_MARKS[0]),
                      F.col("_metadata.file_path").alias(LOAD_MARKS[1]))


def normalize_fx(raw: DataFrame, to_currency: str | None = None, keep: list[str] = ()) -> DataFrame:
    """FX normaliser; upper-case codes so joins are case-insensitive."""
    df = lower_columns(raw)
    renames = {"fromcurrency": "from_currency", "tocurrency": "to_currency"}
    df = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    if "to_currency" not in df.columns and to_currency:
        df = df.withColumn("to_currency", F.lit(to_currency))
    out = conform(df, T.StructType(FX.fields + [df.schema[c] for c in keep]))
    return (out.withColumn("from_currency", F.upper("from_currency"))
               .withColumn("to_currency", F.upper("to_currency"))
               .where(F.col("date").isNotNull())
               .select(*FX_COLUMNS, *keep))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
