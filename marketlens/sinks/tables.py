"""Table sinks (K1-K3, K5, K8).

Writes go through Spark's file commit protocol, so a failed or retried job
never leaves half a table; re-runs replace (overwrite) or skip rows already
stored (see operators.incremental).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import incremental

# The source's if_exists words mapped to Spark save modes.
MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append",
         "ignore": "ignore"}


def spread_for_write(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rebalance on the partition columns: adaptive execution gives small
    directories one file and splits a directory that outgrows the advisory
    partition size over as many tasks as it needs."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_table(df: DataFrame, path: str, if_exists: str = "append",
                partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """K1: write a frame as files; fail / replace / append."""
    if partition_by:
        df = spread_for_write(df, partition_by)
    w = df.write.mode(MODES[if_exists]).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_table(df: DataFrame, name: str, if_exists: str = "append",
               partition_by: list[str] | None = None) -> None:
    """K1 to the catalog (saveAsTable)."""
    w = df.write.mode(MODES[if_exists])
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def column_ddl(df: DataFrame) -> DataFrame:
    """A7 + C9 + K3: per column its longest text and a DDL type.

    One aggregate pass computes max(length) of every string column; the
    result has one row per column (unpivoted), so it stays tiny.
    """
    fields = df.schema.fields
    strings = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    lens = df.agg(*[F.max(F.length(F.col(f"`{c}`"))).cast("bigint").alias(c) for c in strings]) \
        if strings else df.sparkSession.range(1).select()
    rows = []
    for f in fields:
        dt = f.dataType
        if isinstance(dt, T.StringType):
            length = F.col(f"`{f.name}`")
            ddl = F.concat(F.lit("VARCHAR("), F.greatest(F.coalesce(length, F.lit(1)), F.lit(1)).cast("string"), F.lit(")"))
        else:
            length = F.lit(None).cast("bigint")
            ddl = F.lit(_sql_type(dt))
        rows.append(F.struct(F.lit(f.name).alias("column_name"),
                             F.lit(dt.simpleString()).alias("data_type"),
                             length.alias("max_length"), ddl.alias("ddl_type")))
    return lens.select(F.inline(F.array(*rows)))


def _sql_type(dt: T.DataType) -> str:
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return "INT"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "DOUBLE"
    if isinstance(dt, T.DecimalType):
        return dt.simpleString().upper()
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    return "VARCHAR(1024)"


def create_table_column_types(df: DataFrame) -> str:
    """K3: the `createTableColumnTypes` option for a JDBC write (one small
    aggregate; the result has one row per column)."""
    rows = column_ddl(df).select("column_name", "ddl_type").collect()
    return ", ".join(f"{r.column_name} {r.ddl_type}" for r in rows)


def write_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append",
               properties: dict | None = None, batchsize: int = 10_000,
               num_partitions: int | None = None, typed: bool = True) -> None:
    """K2: write through Spark's JDBC writer with batched inserts.

    Credentials belong in `properties` (read them from the environment of the
    job, never from code).  Column types come from the data (K3).
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    w = df.write.mode(MODES[if_exists])
    if typed and if_exists in ("fail", "replace"):
        w = w.option("createTableColumnTypes", create_table_column_types(df))
    w.jdbc(url, table, properties=props)


def store_bars(target: DataFrame, path: str, rows: DataFrame) -> None:
    """Add an increment (one bar per (ticker, date)) to the stored bars at
    `path`, a table partitioned by year of which `target` is the present content.

    Corrected bars replace the stored ones by rewriting their years, then new
    ones are appended.  Each write is one commit, and a load that is repeated
    after a failure finds what it stored before and adds nothing twice.
    """
    changed = incremental.corrected_bars(target, rows)
    years = [r.year for r in changed.select(F.year("date").alias("year")).distinct().collect()]  # calendar years
    if years:
        kept = target.where(F.col("year").isin(years)).drop("year")
        whole = incremental.merge_bars(kept, rows.where(F.year("date").isin(years)))
        out = spread_for_write(whole.withColumn("year", F.year("date")), ["year"])
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
        rows = rows.where(~F.year("date").isin(years))
    write_table(incremental.new_bars(target, rows).withColumn("year", F.year("date")), path, "append", ["year"])


def save_bucketed(df: DataFrame, name: str, buckets: int, by: str = "ticker", order: str = "date",
                  path: str | None = None) -> None:
    """K1 + K8 for tables that meet by `by`: bucketed on it and sorted within, so
    a join of two such tables and windows partitioned by `by` need no exchange.
    Rows go to their buckets first, so each bucket is written by one task."""
    sort = [c for c in (by, order) if c in df.columns]
    w = df.repartition(buckets, by).sortWithinPartitions(*sort).write.mode("overwrite").format("parquet")
    w = w.bucketBy(buckets, by).sortBy(*sort)
    (w.option("path", path) if path else w).saveAsTable(name)


PUBLISHED = T.StructType([T.StructField("seq", T.LongType()), T.StructField("table", T.StringType()),
                          T.StructField("path", T.StringType())])


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    """What was published: a row per table and publication."""
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{root.rstrip('/')}/_published_tables")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], PUBLISHED)


def current_path(spark: SparkSession, root: str, name: str) -> str | None:
    """Where the last published version of a table lies (None: there is none)."""
    found = _pointers(spark, root).where(F.col("table") == name).agg(F.max_by("path", "seq")).first()
    return found[0]


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = current_path(spark, root, name)
    if path is None:
        raise ValueError(f"no table {name!r} was published under {root}")
    return spark.read.parquet(path)


def publish(tables: dict[str, DataFrame], root: str, partition_by: dict[str, list[str]] | None = None,
            drop: dict[str, T.StructType] | None = None) -> str:
    """K5 + K8, all or nothing: write a set of tables into a folder of its own
    run, then show all of them by one commit.

    Readers find a table through the pointer rows (`current_path`).  A run's
    pointers are one file, added by one commit after every table is complete, so
    a run that fails at any table, or whose driver is lost, leaves the set before
    it whole; its folder is never read.  A refresh is one writer at a time.
    Tables in `drop` that this run does not load are published empty.
    """
    root, partition_by = root.rstrip("/"), partition_by or {}
    if not tables:
        raise ValueError("nothing to publish")
    spark = next(iter(tables.values())).sparkSession
    whole = dict(tables)
    for name, schema in (drop or {}).items():
        whole.setdefault(name, spark.createDataFrame([], schema))
    seq = (_pointers(spark, root).agg(F.max("seq")).first()[0] or 0) + 1
    folder = f"{root}/runs/{seq:08d}-{uuid.uuid4().hex}"
    for name, df in whole.items():
        write_table(df, f"{folder}/{name}", "fail", partition_by.get(name))
    rows = spark.createDataFrame([(seq, name, f"{folder}/{name}") for name in whole], PUBLISHED)
    rows.coalesce(1).write.mode("append").parquet(f"{root}/_published_tables")
    return folder


def full_refresh(tables: dict[str, DataFrame], root: str,
                 partition_by: dict[str, list[str]] | None = None,
                 drop: dict[str, T.StructType] | None = None) -> None:
    """K5 + K8: replace every table of a refresh (no per-ticker loop).

    Tables in `drop` that this refresh does not load are left empty, with
    their schema, so no rows of an earlier refresh survive."""
    partition_by = partition_by or {}
    for name, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{name}", "replace", partition_by.get(name))
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    for name, schema in (drop or {}).items():
        if name not in tables:
            write_table(spark.createDataFrame([], schema), f"{root.rstrip('/')}/{name}", "replace")
