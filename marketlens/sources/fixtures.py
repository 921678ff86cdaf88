"""Market tables derived from the driver's TPC-H-style tables.

Everything here is a Spark plan over the given parquet files, so its work
grows with them.  The mappings from TPC-H values to tickers and currencies
are fixed values chosen for the fixtures (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.normalize import normalize_bars, normalize_fx

# ---- fixed values of the fixtures -------------------------------------------
# Dense universe: ticker = l_returnflag, with a raw (lower-case) currency.
FLAG_CURRENCY = {"A": "gbp", "N": "hkd", "R": "eur"}
# Dense FX: orders grouped by o_orderstatus.
STATUS_CURRENCY = {"F": "GBP", "O": "HKD", "P": "EUR"}
# Wide universe: ticker = s_name; currency by the supplier's region.
REGION_CURRENCY = {"AFRICA": "zar", "AMERICA": "usd", "ASIA": "jpy",
                   "EUROPE": "gbp", "MIDDLE EAST": "aed"}
# Wide FX: orders grouped by o_orderpriority.
PRIORITY_CURRENCY = {"1-URGENT": "USD", "2-HIGH": "GBP", "3-MEDIUM": "JPY",
                     "4-NOT SPECIFIED": "ZAR", "5-LOW": "AED"}
# FX close = order price x this factor (decimal(12,2) x decimal(7,6)).
FX_FACTOR = "0.000002"
BASE = "GBP"
# Incremental-load fixture: batch 1 ends on, batch 2 starts on this day.
SPLIT_DATE = "2000-12-31"
# Late-day fixture: the day of the month that is never loaded in time, the one
# that is corrected later, the months an increment reaches back, and its end.
GAP_DAY = 11
CORRECTED_DAY = 13
LATE_MONTHS = 3
UNTIL = "2001-03-01"
# The ticker that the overlap fixture has not loaded before.
LATE_TICKER = "R"
# Date columns of the statement fixture (some without data).
STATEMENT_YEARS = range(1990, 2011)
# News fixture: pages go round-robin to the dense tickers, eight per payload.
NEWS_TICKERS = ["A", "N", "R"]
NEWS_CHUNK = 8
NEWS_TIME_BASE = 1_600_000_000
# ------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(mapping: dict, c: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c]


def _order_key() -> Column:
    """(l_orderkey, l_linenumber, price) packed into one orderable decimal.

    A struct key forces a sort-based aggregate; one decimal keeps the hash
    aggregate with its map-side partial combine.  Price is in the key, so rows
    that tie on it carry the same price.  Layout: line numbers take 4 bits
    (TPC-H uses 1-7) and the price in cents 10 digits; decimal(25,0) leaves
    room for order keys far beyond 100 TB of lines.
    """
    line = (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("decimal(25,0)")
    cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(12,0)")
    return line * F.lit(10 ** 10).cast("decimal(11,0)") + cents


def _bars_from_lines(lines: DataFrame, ticker: Column) -> DataFrame:
    k = _order_key()
    px = F.col("l_extendedprice")
    return (lines.groupBy(ticker.alias("ticker"), F.col("l_shipdate").cast("date").alias("date"))
                 .agg(F.min_by(px, k).alias("open"),
                      F.max(px).alias("high"),
                      F.min(px).alias("low"),
                      F.max_by(px, k).alias("close"),
                      F.sum("l_quantity").cast("bigint").alias("volume"))
                 .withColumn("dividends", F.lit(0.0)))


def dense_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tickers (one per return flag), one bar per ship date."""
    li = table(spark, sf_dir, "lineitem")
    return normalize_bars(_bars_from_lines(li, F.col("l_returnflag")))


def dense_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker -> raw currency code of the tickers that have lines."""
    flags = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("ticker")).distinct()
    return flags.select("ticker", _lookup(FLAG_CURRENCY, F.col("ticker")).alias("currency_code"))


def flag_currency(spark: SparkSession) -> DataFrame:
    """The fixed mapping itself (three rows).  Bars look their ticker up in it, so
    the tickers are those of the bars, and the lines are scanned once."""
    rows = [F.struct(F.lit(t).alias("ticker"), F.lit(c).alias("currency_code"))
            for t, c in FLAG_CURRENCY.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def line_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per line, so that (ticker, date) repeats: ticker, date, close."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("ticker"), F.col("l_shipdate").cast("date").alias("date"),
                     F.col("l_extendedprice").alias("close"))


def text_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense bars as a landing file of text has them: title-case names,
    every value as text, the volume out of range or unreadable on some days."""
    bars = dense_bars(spark, sf_dir)
    volume = (F.when(F.dayofmonth("date") % 7 == 0, F.lit("1e30"))
              .when(F.dayofmonth("date") % 7 == 1, F.lit("n/a"))
              .when(F.dayofmonth("date") % 7 == 2, F.concat(F.col("volume").cast("string"), F.lit(".4")))
              .otherwise(F.col("volume").cast("string")))
    return bars.select(F.date_format("date", "yyyy-MM-dd").alias("Date"), F.col("ticker").alias("Stock"),
                       *[F.col(c).cast("string").alias(c.capitalize()) for c in ("open", "high", "low", "close")],
                       volume.alias("Volume"), F.lit("0").alias("Dividends"))


def _fx_from_orders(orders: DataFrame, code: Column) -> DataFrame:
    f = F.lit(FX_FACTOR).cast("decimal(7,6)")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    g = orders.groupBy(code.alias("from_currency"),
                       F.col("o_orderdate").cast("date").alias("date"))
    fx = g.agg(F.min_by(price, "o_orderkey").alias("o"), F.max_by(price, "o_orderkey").alias("c"),
               F.min(price).alias("l"), F.max(price).alias("h"))
    return normalize_fx(fx.select(
        "from_currency", F.lit(BASE).alias("to_currency"), "date",
        (F.col("o") * f).cast("double").alias("open"),
        (F.col("c") * f).cast("double").alias("close"),
        (F.col("l") * f).cast("double").alias("low"),
        (F.col("h") * f).cast("double").alias("high")))


def dense_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily FX per currency from orders (close 0.002 to 1.0)."""
    o = table(spark, sf_dir, "orders")
    return _fx_from_orders(o, _lookup(STATUS_CURRENCY, F.col("o_orderstatus")))


def wide_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker per supplier (s_name).

    Lines are aggregated to (supplier, day) bars first, so the join to the
    supplier table moves bars, not lines.
    """
    li = table(spark, sf_dir, "lineitem")
    bars = _bars_from_lines(li, F.col("l_suppkey"))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    named = bars.join(sup, bars["ticker"] == sup["s_suppkey"], "inner")
    return normalize_bars(named.drop("ticker", "s_suppkey").withColumnRenamed("s_name", "ticker"))


def wide_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier ticker -> currency of its region (nation and region are fixed
    25- and 5-row tables, so broadcasting them is safe)."""
    sup = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(nat.join(F.broadcast(reg), nat["n_regionkey"] == reg["r_regionkey"]))
    j = sup.join(geo, sup["s_nationkey"] == geo["n_nationkey"], "left")
    return j.select(F.col("s_name").alias("ticker"),
                    _lookup(REGION_CURRENCY, F.col("r_name")).alias("currency_code"))


def wide_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return _fx_from_orders(o, _lookup(PRIORITY_CURRENCY, F.col("o_orderpriority")))


def financials_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (return flag, ship year): four exact sums as long metrics, dated at
    the year end."""
    li = table(spark, sf_dir, "lineitem")
    yr = F.year("l_shipdate")
    sums = li.groupBy(F.col("l_returnflag").alias("ticker"), yr.alias("y")).agg(
        *[F.sum(F.col(c).cast("decimal(18,2)")).cast("double").alias(m)
          for c, m in FINANCIAL_METRICS])
    metrics = [m for _, m in FINANCIAL_METRICS]
    long = sums.unpivot(["ticker", "y"], metrics, "metric", "value")
    return long.select("ticker", "metric", F.make_date("y", F.lit(12), F.lit(31)).alias("date"),
                       "value")


# Source column -> metric name of the financials fixture.
FINANCIAL_METRICS = [("l_quantity", "quantity"), ("l_extendedprice", "extended_price"),
                     ("l_discount", "discount"), ("l_tax", "tax")]


def holders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holder table as it lands: two positional text columns plus ticker.

    Row = (share of the ticker's quantity shipped by suppliers of a nation,
    nation name).  Lines are summed per (flag, supplier) before the joins.
    """
    from ..functions.text import basis_points_text
    li = table(spark, sf_dir, "lineitem")
    per_sup = li.groupBy("l_returnflag", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = per_sup.join(sup, per_sup["l_suppkey"] == sup["s_suppkey"]).join(
        nat, F.col("s_nationkey") == nat["n_nationkey"])
    per_nat = j.groupBy("l_returnflag", "n_name").agg(F.sum("q").cast("bigint").alias("q"))
    # A flag's partition holds one row per nation (at most 25).
    per_nat = per_nat.withColumn("tot", F.sum("q").over(Window.partitionBy("l_returnflag")))
    # basis points, rounded half up, in integer arithmetic
    bp = F.expr("(q * 20000 + tot) div (tot * 2)")
    return per_nat.select(basis_points_text(bp).alias("_c0"), F.col("n_name").alias("_c1"),
                          F.col("l_returnflag").alias("ticker"))


def news_payloads(spark: SparkSession, sf_dir: str, time_key: str = "provider_publish_time",
                  more: dict[str, Column] | None = None) -> DataFrame:
    """(ticker, JSON array of news items) built from the pages table.

    Items are packed eight to a payload, so no payload grows with the data.
    Odd pages carry no publish time (the key is absent from the JSON).  `more`
    are further keys of an item.
    """
    from ..functions.text import url_host
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ticker = F.element_at(F.array(*[F.lit(t) for t in NEWS_TICKERS]),
                          (F.pmod("page_id", F.lit(len(NEWS_TICKERS))) + 1).cast("int"))
    item = F.struct(
        F.col("page_id").cast("string").alias("uuid"),
        F.concat(F.lit("Market update "), F.col("page_id").cast("string")).alias("title"),
        url_host("url").alias("publisher"),
        F.col("url").alias("link"),
        F.lit("STORY").alias("type"),
        F.when(F.pmod("page_id", F.lit(2)) == 0,
               F.lit(NEWS_TIME_BASE) + F.col("page_id") * 3600).alias(time_key),
        *[c.alias(n) for n, c in (more or {}).items()])
    g = pages.groupBy(ticker.alias("ticker"), F.floor(F.col("page_id") / NEWS_CHUNK).alias("chunk"))
    return g.agg(F.to_json(F.collect_list(item)).alias("payload")).select("ticker", "payload")
