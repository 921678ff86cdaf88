import datetime as dt

from pyspark.sql import types as T

from marketlens.schemas import BARS, CURRENCY, FX


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def bars(spark, rows):
    """rows: (ticker, date str, close[, open, high, low, volume])."""
    out = []
    for r in rows:
        t, day, close = r[0], d(r[1]), r[2]
        out.append((t, day, close, close, close, close, 100, 0.0))
    return spark.createDataFrame(out, BARS)


def currency(spark, rows):
    return spark.createDataFrame(rows, CURRENCY)


def fx(spark, rows):
    """rows: (from, date str, close) quoted into GBP."""
    return spark.createDataFrame([(c, "GBP", d(day), v, v, v, v) for c, day, v in rows], FX)


def weekdays(start: str, n: int):
    out, day = [], d(start)
    while len(out) < n:
        if day.weekday() <= 4:
            out.append(day.isoformat())
        day += dt.timedelta(days=1)
    return out


SIMPLE = T.StructType([T.StructField("ticker", T.StringType()),
                       T.StructField("date", T.DateType()),
                       T.StructField("close", T.DoubleType())])
