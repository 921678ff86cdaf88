"""Explicit schemas for every market table (no inference anywhere).

There is no row index: `date` is an ordinary column, so index <-> column
moves (R5) are not needed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the feed and of the stored tables.
# Daily price bars, one row per (ticker, date).
BARS = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("dividends", T.DoubleType(), True),
])
BAR_MEASURES = ["open", "high", "low", "close", "volume", "dividends"]
BAR_COLUMNS = ["ticker", "date"] + BAR_MEASURES

# Instrument currency dimension; codes may arrive in any case.
CURRENCY = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("currency_code", T.StringType(), True),
])

# Daily FX bars quoted as from_currency -> to_currency.
FX = T.StructType([
    T.StructField("from_currency", T.StringType(), False),
    T.StructField("to_currency", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
])
FX_COLUMNS = [f.name for f in FX.fields]

# Holder breakdown after positional columns are named.
HOLDERS = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("percent", T.StringType(), True),
    T.StructField("detail", T.StringType(), True),
    T.StructField("percent_value", T.DoubleType(), True),
])

# Financial statements, stored long.
FINANCIALS = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("value", T.DoubleType(), True),
])

# Fixed value: the feed's own key of the publish time.
NEWS_TIME_KEY = "providerPublishTime"
# One news item inside a JSON payload array, as the feed names it.
NEWS_ITEM = T.StructType([
    T.StructField("uuid", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("publisher", T.StringType(), True),
    T.StructField("link", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("provider_publish_time", T.LongType(), True),
    T.StructField(NEWS_TIME_KEY, T.LongType(), True),
])
NEWS_PAYLOAD = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("payload", T.StringType(), True),
])
NEWS = T.StructType([T.StructField("ticker", T.StringType(), True)]
                    + [f for f in NEWS_ITEM.fields if f.name != NEWS_TIME_KEY])
NEWS_COLUMNS = ["ticker", "uuid", "title", "publisher", "link", "provider_publish_time", "type"]

FORECAST = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("ds", T.DateType(), False),
    T.StructField("y", T.DoubleType(), True),
    T.StructField("yhat", T.DoubleType(), True),
    T.StructField("yhat_lower", T.DoubleType(), True),
    T.StructField("yhat_upper", T.DoubleType(), True),
    T.StructField("trend", T.DoubleType(), True),
    T.StructField("is_future", T.BooleanType(), False),
])
