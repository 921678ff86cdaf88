"""Reshape and nested-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import flat_name
from ..schemas import BAR_MEASURES, NEWS_COLUMNS, NEWS_ITEM, NEWS_TIME_KEY
from .normalize import to_date, to_number


def _q(name: str) -> str:
    return f"`{name}`"


def wide_tickers(wide: DataFrame, measures=BAR_MEASURES, key: str = "date") -> list[str]:
    """Tickers present in a `<ticker>_<measure>` wide table (schema only)."""
    seen: list[str] = []
    for c in wide.columns:
        if c == key or "_" not in c:
            continue
        t, m = c.rsplit("_", 1)
        if m.lower() in measures and t not in seen:
            seen.append(t)
    return seen


def wide_to_long(wide: DataFrame, measures=BAR_MEASURES, key: str = "date") -> DataFrame:
    """Stack `<ticker>_<measure>` columns into (key, ticker, measures...).

    Measures match in any case (P1); tickers keep theirs.  Rows whose measures
    are all missing are dropped, as a stack does.  The ticker list comes from
    the schema, so nothing is collected.
    """
    tickers = wide_tickers(wide, measures, key)
    if not tickers:
        raise ValueError(f"no <ticker>_<measure> column among {wide.columns}; measures are {list(measures)}")
    names = {c: f"{c.rsplit('_', 1)[0]}_{c.rsplit('_', 1)[1].lower()}" for c in wide.columns
             if "_" in c and c != key and c.rsplit("_", 1)[1].lower() in measures}
    wide = wide.select(*[F.col(_q(c)).alias(names.get(c, c)) for c in wide.columns])
    present = set(wide.columns)
    types = {f.name: f.dataType for f in wide.schema.fields}
    mtype = {}
    for m in measures:
        for t in tickers:
            if f"{t}_{m}" in present:
                mtype[m] = types[f"{t}_{m}"]
                break
    structs = []
    for t in tickers:
        fields = [F.lit(t).alias("ticker")]
        for m in measures:
            name = f"{t}_{m}"
            v = F.col(_q(name)) if name in present else F.lit(None).cast(mtype.get(m, T.DoubleType()))
            fields.append(v.alias(m))
        structs.append(F.struct(*fields))
    long = wide.select(F.col(key), F.inline(F.array(*structs)))
    return long.na.drop(how="all", subset=list(measures))


def long_to_wide(df: DataFrame, tickers: list[str], measures=BAR_MEASURES,
                 key: str = "date") -> DataFrame:
    """Inverse of R1: one row per key, `<ticker>_<measure>` columns."""
    aggs = [F.first(m, ignorenulls=True).alias(m) for m in measures]
    return df.groupBy(key).pivot("ticker", tickers).agg(*aggs)


def pivot_measure(df: DataFrame, measure: str, tickers: list[str], prefix: str | None = None,
                  key: str = "date") -> DataFrame:
    """R2 + R4 + A2: key x ticker pivot of one measure with flat column names.

    The ticker list is explicit so Spark does not run a job to find it.
    Values of one (key, ticker) are averaged, as a pivot table does.  Tickers
    whose flat names would be equal are refused.
    """
    prefix = prefix or measure.capitalize()
    names = [flat_name(prefix, t) for t in tickers]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"tickers share a column name: {sorted(names)}")
    wide = df.groupBy(key).pivot("ticker", tickers).agg(F.avg(measure))
    return wide.select(key, *[F.col(_q(t)).alias(flat_name(prefix, t)) for t in tickers])


def transpose_financials(statement: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Statement (ticker, metric, <date columns>) -> (ticker, date, <metrics>).

    Date columns are every column other than ticker and metric.  With an
    explicit metric list the pivot needs no extra job.
    """
    return financials_by_date(statement_long(statement), metrics)


def statement_long(statement: DataFrame) -> DataFrame:
    """Statement layout -> (ticker, metric, date, value), the form to store: its
    columns do not change with the data.  Values that are missing for a date
    column are no observation and give no row."""
    date_cols = [c for c in statement.columns if c not in ("ticker", "metric")]
    long = statement.unpivot(["ticker", "metric"], date_cols, "date", "value")
    return (long.withColumn("date", to_date("date"))
                .withColumn("value", to_number("value"))
                .where(F.col("value").isNotNull()))


def financials_by_date(long: DataFrame, metrics: list[str]) -> DataFrame:
    """Pivot long financials (ticker, metric, date, value) to one row per date
    that has a value.  The metric list is explicit, so no job runs while the
    frame is built; a metric that repeats for a date takes its largest value."""
    long = long.where(F.col("value").isNotNull())
    return long.groupBy("ticker", "date").pivot("metric", metrics).agg(F.max("value"))


def statement_wide(long: DataFrame, dates: list[str]) -> DataFrame:
    """Long financials back to the statement layout (one column per listed date)."""
    return (long.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
                .groupBy("ticker", "metric").pivot("date", dates).agg(F.max("value")))


def explode_news(payloads: DataFrame) -> DataFrame:
    """(ticker, payload JSON array) -> one row per news item.

    Missing keys become NULL; an empty or NULL list yields no rows, and so does
    a payload that is not a list of items (see `news_rejects`).  The publish
    time is read under the feed's key and under the stored column's name.
    """
    items = F.from_json("payload", T.ArrayType(NEWS_ITEM))
    rows = payloads.select("ticker", F.inline(items))
    time = F.coalesce("provider_publish_time", NEWS_TIME_KEY)
    return rows.withColumn("provider_publish_time", time).select(*NEWS_COLUMNS)


def news_variants(payloads: DataFrame) -> DataFrame:
    """S4 with open keys: (ticker, uuid, item), the whole item as a VARIANT, so
    keys that no schema names are kept and can be taken out later with a type
    (`F.try_variant_get`)."""
    items = payloads.select("ticker", F.explode(F.from_json("payload", "array<variant>")).alias("item"))
    return items.select("ticker", F.try_variant_get("item", "$.uuid", "string").alias("uuid"), "item")


def statement_variants(long: DataFrame) -> DataFrame:
    """S3 with open line items: (ticker, date, items), one VARIANT object of all
    metrics that a statement has on a date, whatever their names; a statement's
    lines are few.  A metric that repeats for a date takes its largest value."""
    rows = (long.where(F.col("value").isNotNull() & F.col("metric").isNotNull())
            .groupBy("ticker", "date", "metric").agg(F.max("value").alias("value")))
    return rows.groupBy("ticker", "date").agg(F.to_variant_object(F.map_from_entries(
        F.collect_list(F.struct("metric", "value")))).alias("items"))


def variant_fields(df: DataFrame, variant: str, fields: dict[str, str]) -> DataFrame:
    """Typed columns from a VARIANT column: name -> type; a field that is absent
    or does not fit its type is NULL.  Other columns stay, the variant goes."""
    return df.select(*[c for c in df.columns if c != variant], *[
        F.try_variant_get(variant, f"$['{n}']", t).alias(n) for n, t in fields.items()])


def news_rejects(payloads: DataFrame) -> DataFrame:
    """Payloads that hold text but no readable list: (ticker, payload)."""
    items = F.from_json("payload", T.ArrayType(NEWS_ITEM))
    unread = items.isNull() | F.exists(items, lambda x: x.isNull())
    return payloads.where(F.col("payload").isNotNull() & unread)
