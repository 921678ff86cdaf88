"""Per-instrument time-series operators.

All windows use the same spec, partitioned by ticker and ordered by date, so
Spark plans one exchange and one sort for W1 and W2 together.  A ticker's
window partition holds at most one row per calendar day (bars are unique on
(ticker, date), rule Q1), which bounds every per-task group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import AMOUNT_DEC, RUNNING_DEC, exact_avg

# Fixed values of the rolling report: horizon (rows) and minimum non-null observations of the rolling means.
ROLLING_WINDOWS = ((50, 25), (200, 100), (365, 182), (1000, 500))


def _w(by: str = "ticker", order: str = "date"):
    return Window.partitionBy(by).orderBy(order)


def _wu(by: str = "ticker", order: str = "date"):
    return _w(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def daily_returns(df: DataFrame, price: str = "close", out: str = "daily_return",
                  by: str = "ticker", order: str = "date") -> DataFrame:
    """Percent change per ticker with gaps padded from the last price.

    A missing price repeats the previous one (return 0 on that row); leading
    missing prices give NULL; a zero previous price gives NULL, not an error.
    """
    filled = F.last(price, ignorenulls=True).over(_wu(by, order))
    df = df.withColumn("_filled", filled)
    prev = F.lag("_filled", 1).over(_w(by, order))
    return df.withColumn(out, F.try_divide(F.col("_filled"), prev) - 1.0).drop("_filled")


def daily_returns_chunked(df: DataFrame, price: str = "close", out: str = "daily_return",
                          by: str = "ticker", order: str = "date") -> DataFrame:
    """W1 for series too long for one task; same result as `daily_returns`.

    The price carried into each (ticker, day) block is the last present
    price of the earlier blocks, taken from a per-ticker window over one row
    per day; inside the block a (ticker, day) window pads and lags.
    """
    base = df.withColumn("_blk", F.col(order).cast("date"))
    last_in_blk = base.groupBy(by, "_blk").agg(
        F.max_by(price, F.when(F.col(price).isNotNull(), F.col(order))).alias("_last"))
    wd = Window.partitionBy(by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_blk.select(by, "_blk", F.last("_last", ignorenulls=True).over(wd).alias("_in"))
    rows = base.join(carry, [by, "_blk"])
    wi = Window.partitionBy(by, "_blk").orderBy(order)
    wiu = wi.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_filled", F.coalesce(F.last(price, ignorenulls=True).over(wiu),
                                                 F.col("_in")))
    prev = F.when(F.row_number().over(wi) == 1, F.col("_in")).otherwise(F.lag("_filled", 1).over(wi))
    return (rows.withColumn(out, F.try_divide(F.col("_filled"), prev) - 1.0)
                .drop("_blk", "_in", "_filled"))


def rolling_means(df: DataFrame, value: str, windows=ROLLING_WINDOWS, prefix: str = "ma",
                  by: str = "ticker", order: str = "date") -> DataFrame:
    """Trailing mean over n rows, NULL until min_periods values are seen.

    Computed from prefix sums: one running sum and count, then each horizon is
    the difference to the value n rows back.  Cost is linear in rows for any
    horizon (a sliding frame re-aggregates n rows per row).  Missing values
    keep their slot in the n rows but add nothing to the sum or the count.
    Sums are decimal so the result does not depend on the row order of
    partial sums.
    """
    x = F.col(value).cast(AMOUNT_DEC)
    df = (df.withColumn("_s", F.sum(F.coalesce(x, F.lit(0).cast(AMOUNT_DEC)))
                                 .over(_wu(by, order)).cast(RUNNING_DEC))
            .withColumn("_n", F.count(x).over(_wu(by, order))))
    w = _w(by, order)
    for n, mp in windows:
        if mp > n:
            raise ValueError(f"min_periods {mp} exceeds window {n}")
        s_n = F.col("_s") - F.coalesce(F.lag("_s", n).over(w), F.lit(0).cast(RUNNING_DEC))
        c_n = F.col("_n") - F.coalesce(F.lag("_n", n).over(w), F.lit(0))
        df = df.withColumn(
            f"{prefix}{n}",
            F.when(c_n >= F.lit(max(mp, 1)), F.try_divide(s_n.cast("double"), c_n.cast("double"))))
    return df.drop("_s", "_n")


def rolling_means_chunked(df: DataFrame, value: str, windows=ROLLING_WINDOWS,
                          prefix: str = "ma", by: str = "ticker", order: str = "date",
                          chunk_rows: int = 100_000) -> DataFrame:
    """W2 for series too long for one task (a key holding a third of the rows).

    Same result as `rolling_means`, without any window partitioned by ticker
    alone:

    1. per (ticker, day) totals, then exclusive running totals over a
       ticker's days (at most one row per calendar day) give each day's
       offset of rows, sum and count;
    2. inside each (ticker, day) block a window adds the block-local running
       values, giving every row its global index and prefix sums;
    3. rows are cut into chunks of `chunk_rows` consecutive indices; each
       chunk also receives the `max(n)` rows before it (a halo), so
       `lag(n)` inside (ticker, chunk) sees every row it needs.  Halo rows are
       dropped afterwards.

    Steps 1 and 2 hold one (ticker, day) block in a task and step 3 at most
    chunk_rows + max(n) rows, so a day's rows of one ticker are the bound.
    """
    x = F.col(value).cast(AMOUNT_DEC)
    zero = F.lit(0).cast(AMOUNT_DEC)
    base = df.withColumn("_x", x).withColumn("_blk", F.col(order).cast("date"))
    tot = base.groupBy(by, "_blk").agg(F.count(F.lit(1)).alias("_rows"),
                                        F.sum(F.coalesce("_x", zero)).alias("_bs"),
                                        F.count("_x").alias("_bn"))
    wb = Window.partitionBy(by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(by, "_blk",
                     F.coalesce(F.sum("_rows").over(wb), F.lit(0)).alias("_r0"),
                     F.coalesce(F.sum("_bs").over(wb), zero).cast(RUNNING_DEC).alias("_s0"),
                     F.coalesce(F.sum("_bn").over(wb), F.lit(0)).alias("_n0"))
    rows = base.join(off, [by, "_blk"])
    wi = Window.partitionBy(by, "_blk").orderBy(order)
    wiu = wi.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (rows.withColumn("_g", F.col("_r0") + F.row_number().over(wi))
                .withColumn("_s", (F.col("_s0") + F.sum(F.coalesce("_x", zero)).over(wiu))
                            .cast(RUNNING_DEC))
                .withColumn("_n", F.col("_n0") + F.count("_x").over(wiu))
                .drop("_r0", "_s0", "_n0", "_blk"))
    halo = max(n for n, _ in windows)
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    own = F.floor((F.col("_g") - 1) / chunk_rows).cast("bigint")
    # chunks whose halo covers this row: the next ceil(halo / chunk_rows) chunks
    reach = -(-halo // chunk_rows)
    copies = rows.select("*", F.explode(F.sequence(own, own + reach)).alias("_c"))
    copies = copies.where((F.col("_c") == own)
                          | (F.col("_g") > F.col("_c") * chunk_rows - halo))
    wc = Window.partitionBy(by, "_c").orderBy("_g")
    out = copies
    for n, mp in windows:
        if mp > n:
            raise ValueError(f"min_periods {mp} exceeds window {n}")
        prev_s = F.when(F.col("_g") > n, F.lag("_s", n).over(wc)).otherwise(
            F.lit(0).cast(RUNNING_DEC))
        prev_n = F.when(F.col("_g") > n, F.lag("_n", n).over(wc)).otherwise(F.lit(0))
        s_n, c_n = F.col("_s") - prev_s, F.col("_n") - prev_n
        out = out.withColumn(
            f"{prefix}{n}",
            F.when(c_n >= F.lit(max(mp, 1)), F.try_divide(s_n.cast("double"), c_n.cast("double"))))
    return out.where(F.col("_c") == own).drop("_x", "_g", "_s", "_n", "_c")


def rolling_means_frame(df: DataFrame, value: str, windows=ROLLING_WINDOWS, prefix: str = "ma",
                        by: str = "ticker", order: str = "date") -> DataFrame:
    """W2 written with sliding frames; the reference form for tests."""
    for n, mp in windows:
        fr = _w(by, order).rowsBetween(-(n - 1), Window.currentRow)
        x = F.col(value).cast(AMOUNT_DEC)
        df = df.withColumn(
            f"{prefix}{n}",
            F.when(F.count(x).over(fr) >= mp,
                   F.sum(x).over(fr).cast("double") / F.count(x).over(fr)))
    return df


def cumulative_returns(df: DataFrame, price: str = "close", out: str = "cumulative_return",
                       by: str = "ticker", order: str = "date") -> DataFrame:
    """W4 (+ W3, C12, G4): growth of 1 unit per ticker on the shared date axis.

    The date axis holds every date on which any ticker has a price.  A ticker
    shows 1.0 before its first price, then last price / first price, carried
    forward over dates it has no price (the product of daily factors
    telescopes to that ratio).

    Prices of one (ticker, date) are averaged first (A2), as the wide table of
    the report does, so repeated bars give one row per ticker and axis day.

    Plan: the axis days are numbered once (the axis has at most one row per
    calendar day, so one task may number it and AQE may broadcast it).  Each
    priced row covers the axis numbers up to its next priced row, a ticker's
    first row also those before it, at 1.0.  Only days of the output are
    produced, with no cross join.
    """
    priced = (df.select(by, order, price).where(F.col(price).isNotNull())
                .groupBy(by, order)
                .agg(F.when(F.count(price) == 1, F.max(price)).otherwise(exact_avg(price)).alias(price)))
    axis = priced.select(F.col(order).alias("_d")).distinct().withColumn(
        "_i", F.row_number().over(Window.orderBy("_d")))
    days = axis.select(F.max("_i")).scalar()
    w = _w(by, "_i")
    first_px = F.first(price).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = (priced.join(axis, priced[order] == axis["_d"]).select(by, "_i", price)
            .withColumn("_cr", F.try_divide(F.col(price), first_px))
            .withColumn("_next", F.lead("_i").over(w))
            .withColumn("_from", F.when(F.lag("_i").over(w).isNull(), F.lit(1)).otherwise(F.col("_i"))))
    dense = rows.select(by, F.col("_i").alias("_own"), "_cr", F.explode(
        F.sequence("_from", F.coalesce(F.col("_next") - 1, days))).alias("_i"))
    value = F.when(F.col("_i") < F.col("_own"), F.lit(1.0)).otherwise(F.col("_cr"))
    return dense.join(axis, "_i").select(by, F.col("_d").alias(order), value.alias(out))


def return_histogram(returns: DataFrame, value: str = "daily_return", nbins: int = 200,
                     by: str = "ticker") -> DataFrame:
    """A6 + G3: fixed-width histogram of returns per ticker on one global range.

    The range is a scalar subquery of one min/max aggregate, and bins are
    counted map-side, so only bins are shuffled, not returns.  The exchange
    below the windows of `returns` is the same in both and is reused.  Bins are
    [lo + i*w, lo + (i+1)*w), the last one closed.
    """
    vals = returns.where(F.col(value).isNotNull() & ~F.isnan(value))
    rng = vals.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    vals = vals.select(by, value, rng.alias("_r"))  # the subquery is referenced once
    lo, hi = F.col("_r.lo"), F.col("_r.hi")
    width = (hi - lo) / F.lit(float(nbins))
    b = F.when(width > 0, F.least(F.lit(nbins - 1).cast("bigint"),
                                   F.floor((F.col(value) - lo) / width).cast("bigint"))
               ).otherwise(F.lit(0).cast("bigint"))
    counts = vals.groupBy(by, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"),
                                                   F.first(lo).alias("_lo"),
                                                   F.first(width).alias("_w"))
    return counts.select(
        by, "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
        "count")


RANGE_MONTHS = {"1m": 1, "6m": 6, "1y": 12}


def date_range(df: DataFrame, preset: str, order: str = "date", latest: Column | None = None) -> DataFrame:
    """1m, 6m, 1y back from the latest date; ytd; or all.

    The latest date is a scalar subquery over the frame unless the caller
    knows it, so the filter needs no join.
    """
    preset = preset.lower()
    if preset == "all":
        return df
    latest = df.select(F.max(order)).scalar() if latest is None else latest
    if preset == "ytd":
        return df.where(F.col(order) >= F.trunc(latest, "year"))
    if preset not in RANGE_MONTHS:
        raise ValueError(f"unknown range preset {preset!r}")
    return df.where(F.col(order) > F.add_months(latest, -RANGE_MONTHS[preset]))


def price_series(enriched: DataFrame, value: str = "converted_close", log: bool = False,
                 preset: str = "all", latest: Column | None = None) -> DataFrame:
    """G1: (ticker, date, price) without missing prices (L4); P12 log10 option."""
    df = enriched.select("ticker", "date", value).na.drop(subset=[value])
    if log:
        df = df.where(F.col(value) > 0).withColumn(value, F.log10(F.col(value).cast("double")))
    return date_range(df, preset, latest=latest)


def volume_series(enriched: DataFrame) -> DataFrame:
    """Traded volume per ticker and date."""
    return enriched.select("ticker", "date", "volume")


def rolling_report(enriched: DataFrame, value: str = "converted_close",
                   windows=ROLLING_WINDOWS, required=("ma1000", "ma200"),
                   preset: str = "all") -> DataFrame:
    """The four rolling means with rows lacking the plotted series dropped.

    The range preset (L6) applies after the means, which need the rows
    before it."""
    df = rolling_means(enriched.select("ticker", "date", value), value, windows)
    need = [c for c in required if c in df.columns] + [value]
    return date_range(df.na.drop(subset=need), preset)


def sort_for_report(df: DataFrame, order: str = "date", by: str = "ticker") -> DataFrame:
    """O1: date ascending, missing dates last (a range-partitioned sort)."""
    return df.orderBy(F.asc_nulls_last(order), F.col(by))
