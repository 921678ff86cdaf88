"""DuckDB SQL oracles, one per registered query.

Written independently of the Spark plans: ordered aggregates instead of
packed keys, sliding-frame windows instead of prefix sums, a cross-joined
date spine for cumulative returns.  Tables are the driver's views.
"""

from __future__ import annotations

from ..sources import fixtures as fx


def _case(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


DENSE_BARS = """
dense_bars AS (
  SELECT l_returnflag AS ticker, CAST(l_shipdate AS DATE) AS date,
         first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS open,
         max(l_extendedprice) AS high,
         min(l_extendedprice) AS low,
         first(l_extendedprice ORDER BY l_orderkey DESC, l_linenumber DESC,
               l_extendedprice DESC) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume,
         CAST(0 AS DOUBLE) AS dividends
  FROM lineitem GROUP BY 1, 2)"""

DENSE_CURRENCY = f"""
dense_currency AS (
  SELECT DISTINCT l_returnflag AS ticker, {_case('l_returnflag', fx.FLAG_CURRENCY)} AS currency_code
  FROM lineitem)"""


def _fx(code_expr: str, name: str) -> str:
    f = f"CAST('{fx.FX_FACTOR}' AS DECIMAL(7,6))"
    p = "CAST(o_totalprice AS DECIMAL(12,2))"
    return f"""
{name} AS (
  SELECT {code_expr} AS from_currency, 'GBP' AS to_currency, CAST(o_orderdate AS DATE) AS date,
         CAST(arg_min({p}, o_orderkey) * {f} AS DOUBLE) AS open,
         CAST(arg_max({p}, o_orderkey) * {f} AS DOUBLE) AS close,
         CAST(min({p}) * {f} AS DOUBLE) AS low,
         CAST(max({p}) * {f} AS DOUBLE) AS high
  FROM orders GROUP BY 1, 3)"""


DENSE_FX = _fx(_case("o_orderstatus", fx.STATUS_CURRENCY), "dense_fx")
WIDE_FX = _fx(_case("o_orderpriority", fx.PRIORITY_CURRENCY), "wide_fx")

WIDE_BARS = """
wide_bars AS (
  SELECT s.s_name AS ticker, b.date, b.open, b.high, b.low, b.close, b.volume, b.dividends
  FROM (
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
           first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS open,
           max(l_extendedprice) AS high, min(l_extendedprice) AS low,
           first(l_extendedprice ORDER BY l_orderkey DESC, l_linenumber DESC,
                 l_extendedprice DESC) AS close,
           CAST(sum(l_quantity) AS BIGINT) AS volume, CAST(0 AS DOUBLE) AS dividends
    FROM lineitem GROUP BY 1, 2) b
  JOIN supplier s ON b.l_suppkey = s.s_suppkey)"""

WIDE_CURRENCY = f"""
wide_currency AS (
  SELECT s.s_name AS ticker, {_case('r.r_name', fx.REGION_CURRENCY)} AS currency_code
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _master(bars: str, cur: str, fxt: str, name: str) -> str:
    conv = "CAST(CAST(close AS DECIMAL(19,6)) * CAST(rate AS DECIMAL(19,10)) AS DECIMAL(30,12))"
    return f"""
{name}_j AS (
  SELECT b.*, upper(trim(c.currency_code)) AS currency_code, f.close AS fx_close
  FROM {bars} b
  LEFT JOIN {cur} c ON b.ticker = c.ticker
  LEFT JOIN {fxt} f ON b.date = f.date AND upper(trim(c.currency_code)) = f.from_currency
                    AND f.to_currency = 'GBP'),
{name}_r AS (
  SELECT *, CASE WHEN currency_code = 'GBP' THEN CAST(1 AS DOUBLE) ELSE fx_close END AS rate
  FROM {name}_j),
{name} AS (
  SELECT *, {conv} AS conv, CAST(isodow(date) - 1 AS BIGINT) AS day
  FROM {name}_r WHERE isodow(date) <= 5)"""


DENSE_MASTER = _master("dense_bars", "dense_currency", "dense_fx", "master")
WIDE_MASTER = _master("wide_bars", "wide_currency", "wide_fx", "wmaster")

DENSE = f"WITH {DENSE_BARS},{DENSE_CURRENCY},{DENSE_FX},{DENSE_MASTER}"
WIDE = f"WITH {WIDE_BARS},{WIDE_CURRENCY},{WIDE_FX},{WIDE_MASTER}"


def _ma(n: int, mp: int, src: str = "conv") -> str:
    w = f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (f"CASE WHEN count({src}) OVER {w} >= {mp} THEN "
            f"CAST(sum({src}) OVER {w} AS DOUBLE) / count({src}) OVER {w} END AS ma{n}")


MONEY = "CAST(round(conv, 6) AS DOUBLE) AS converted_close"
def _returns(head: str, master: str) -> str:
    return f"""{head},
filled AS (
  SELECT ticker, date, close,
         last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cf
  FROM {master}),
returns AS (
  SELECT ticker, date, close,
         CASE WHEN lag(cf) OVER (PARTITION BY ticker ORDER BY date) = 0 THEN NULL
              ELSE cf / lag(cf) OVER (PARTITION BY ticker ORDER BY date) - 1 END AS daily_return
  FROM filled)"""


def _cumulative(head: str, priced: str) -> str:
    return f"""{head},
priced AS ({priced}),
axis AS (SELECT DISTINCT date FROM priced),
names AS (SELECT DISTINCT ticker FROM priced),
grid AS (SELECT n.ticker, a.date, p.close FROM axis a CROSS JOIN names n
         LEFT JOIN priced p ON p.ticker = n.ticker AND p.date = a.date),
cum AS (
  SELECT ticker, date,
         COALESCE(
           last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           / first_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
           CAST(1 AS DOUBLE)) AS cumulative_return
  FROM grid)"""


def _histogram(returns: str) -> str:
    return f"""{returns},
        r AS (SELECT * FROM returns WHERE daily_return IS NOT NULL AND NOT isnan(daily_return)),
        rng AS (SELECT min(daily_return) AS lo, max(daily_return) AS hi FROM r),
        b AS (SELECT r.ticker, r.daily_return, rng.lo, (rng.hi - rng.lo) / CAST(200 AS DOUBLE) AS width
              FROM r, rng),
        bb AS (SELECT ticker, lo, width,
                 CASE WHEN width > 0 THEN least(CAST(199 AS BIGINT),
                      CAST(floor((daily_return - lo) / width) AS BIGINT)) ELSE CAST(0 AS BIGINT) END AS bin
               FROM b)
        SELECT ticker, bin, round(lo + bin * width, 9) AS bin_start,
               round(lo + (bin + 1) * width, 9) AS bin_end, count(*) AS count
        FROM bb GROUP BY ticker, bin, lo, width"""


RETURNS = _returns(DENSE, "master")
CUMULATIVE = _cumulative(DENSE, "SELECT ticker, date, close FROM master WHERE close IS NOT NULL")


def _quality(head: str, bars: str, rates: str, codes: str) -> str:
    """The rules written out one by one over named tables."""
    return f"""{head},
        one_code AS (SELECT ticker, max(upper(trim(currency_code))) AS code FROM {codes} GROUP BY ticker),
        one_rate AS (SELECT from_currency, date, max(close) AS close FROM {rates}
                     WHERE to_currency = 'GBP' GROUP BY 1, 2),
        rated AS (SELECT b.*, CASE WHEN c.code = 'GBP' THEN 1.0 ELSE r.close END AS rate
                  FROM {bars} b LEFT JOIN one_code c USING (ticker)
                  LEFT JOIN one_rate r ON r.from_currency = c.code AND r.date = b.date
                  WHERE isodow(b.date) <= 5)
        SELECT 'bars_unique_ticker_date' AS rule, v AS violations, v = 0 AS passed
        FROM (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS v
              FROM (SELECT count(*) AS n FROM {bars} GROUP BY ticker, date))
        UNION ALL SELECT 'fx_unique_currency_date', v, v = 0
        FROM (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS v
              FROM (SELECT count(*) AS n FROM {rates} GROUP BY from_currency, to_currency, date))
        UNION ALL SELECT 'close_positive', v, v = 0
        FROM (SELECT count(*) AS v FROM {bars} WHERE close <= 0)
        UNION ALL SELECT 'fx_coverage', v, v * 100.0 / n <= 20.0
        FROM (SELECT count(*) FILTER (rate IS NULL) AS v, count(*) AS n FROM rated)
        UNION ALL SELECT 'conversion_lost', CAST(0 AS BIGINT), true
        UNION ALL SELECT 'currency_unique_ticker', v, v = 0
        FROM (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS v
              FROM (SELECT count(DISTINCT upper(trim(currency_code))) AS n FROM {codes} GROUP BY ticker))"""


FORECAST_TRAIN = f"""{DENSE},
train AS (SELECT ticker, date AS ds, close AS y, currency_code FROM master
          WHERE date > DATE '1999-01-01')"""


# Published public holidays of the forecast fixture's days (1999 to early 2002),
# listed by date: country, then "date name" lines.
PUBLISHED_HOLIDAYS = {
    "GB": """
        1999-01-01 New Year's Day
        1999-04-02 Good Friday
        1999-04-05 Easter Monday
        1999-05-03 May Day
        1999-05-31 Spring Bank Holiday
        1999-08-30 Late Summer Bank Holiday
        1999-12-27 Christmas Day (substitute day)
        1999-12-28 Boxing Day (substitute day)
        1999-12-31 Millennium Celebrations
        2000-01-03 New Year's Day (substitute day)
        2000-04-21 Good Friday
        2000-04-24 Easter Monday
        2000-05-01 May Day
        2000-05-29 Spring Bank Holiday
        2000-08-28 Late Summer Bank Holiday
        2000-12-25 Christmas Day
        2000-12-26 Boxing Day
        2001-01-01 New Year's Day
        2001-04-13 Good Friday
        2001-04-16 Easter Monday
        2001-05-07 May Day
        2001-05-28 Spring Bank Holiday
        2001-08-27 Late Summer Bank Holiday
        2001-12-25 Christmas Day
        2001-12-26 Boxing Day
        2002-01-01 New Year's Day""",
    "HK": """
        1999-01-01 The first day of January
        1999-02-16 Lunar New Year's Day
        1999-02-17 The second day of Lunar New Year
        1999-02-18 The third day of Lunar New Year
        1999-04-02 Good Friday
        1999-04-05 Ching Ming Festival
        1999-04-05 Easter Monday
        1999-04-06 The day following Ching Ming Festival
        1999-06-18 Tuen Ng Festival
        1999-07-01 Hong Kong Special Administrative Region Establishment Day
        1999-10-01 National Day
        1999-10-18 The day following Chung Yeung Festival
        1999-12-27 The first weekday after Christmas Day
        2000-02-04 The day preceding Lunar New Year's Day
        2000-02-07 The third day of Lunar New Year
        2000-04-04 Ching Ming Festival
        2000-04-21 Good Friday
        2000-04-24 Easter Monday
        2000-05-01 Labour Day
        2000-05-11 The Birthday of the Buddha
        2000-06-06 Tuen Ng Festival
        2000-09-13 The day following the Chinese Mid-Autumn Festival
        2000-10-02 The day following National Day
        2000-10-06 Chung Yeung Festival
        2000-12-25 Christmas Day
        2000-12-26 The first weekday after Christmas Day
        2001-01-01 The first day of January
        2001-01-24 Lunar New Year's Day
        2001-01-25 The second day of Lunar New Year
        2001-01-26 The third day of Lunar New Year
        2001-04-05 Ching Ming Festival
        2001-04-13 Good Friday
        2001-04-16 Easter Monday
        2001-04-30 The Birthday of the Buddha
        2001-05-01 Labour Day
        2001-06-25 Tuen Ng Festival
        2001-07-02 The day following Hong Kong Special Administrative Region Establishment Day
        2001-10-01 National Day
        2001-10-02 The day following the Chinese Mid-Autumn Festival
        2001-10-25 Chung Yeung Festival
        2001-12-25 Christmas Day
        2001-12-26 The first weekday after Christmas Day
        2002-01-01 The first day of January""",
    "US": """
        1999-01-01 New Year's Day
        1999-01-18 Martin Luther King Jr. Day
        1999-02-15 Washington's Birthday
        1999-05-31 Memorial Day
        1999-07-05 Independence Day (observed)
        1999-09-06 Labor Day
        1999-10-11 Columbus Day
        1999-11-11 Veterans Day
        1999-11-25 Thanksgiving
        1999-12-24 Christmas Day (observed)
        1999-12-31 New Year's Day (observed)
        2000-01-17 Martin Luther King Jr. Day
        2000-02-21 Washington's Birthday
        2000-05-29 Memorial Day
        2000-07-04 Independence Day
        2000-09-04 Labor Day
        2000-10-09 Columbus Day
        2000-11-10 Veterans Day (observed)
        2000-11-23 Thanksgiving
        2000-12-25 Christmas Day
        2001-01-01 New Year's Day
        2001-01-15 Martin Luther King Jr. Day
        2001-02-19 Washington's Birthday
        2001-05-28 Memorial Day
        2001-07-04 Independence Day
        2001-09-03 Labor Day
        2001-10-08 Columbus Day
        2001-11-12 Veterans Day (observed)
        2001-11-22 Thanksgiving
        2001-12-25 Christmas Day
        2002-01-01 New Year's Day
        2002-01-21 Martin Luther King Jr. Day""",
}


def _holiday_sql() -> str:
    rows = []
    for country, lines in PUBLISHED_HOLIDAYS.items():
        for line in lines.split("\n"):
            if line.strip():
                day, name = line.strip().split(" ", 1)
                rows.append("('{}', DATE '{}', '{}')".format(country, day, name.replace("'", "''")))
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(country, date, holiday)"


CALENDAR = f"""{FORECAST_TRAIN},
per AS (SELECT ticker, max(ds) AS last, max(currency_code) AS code FROM train GROUP BY ticker),
hol_raw AS ({_holiday_sql()}),
hol AS (SELECT country, date, string_agg(holiday, ', ' ORDER BY holiday) AS holiday
        FROM hol_raw GROUP BY country, date),
cal0 AS (
  SELECT DISTINCT t.ticker, t.ds, false AS is_future, p.code FROM train t JOIN per p USING (ticker)
  UNION ALL
  SELECT p.ticker, CAST(p.last + CAST(g.i AS INTEGER) AS DATE) AS ds, true AS is_future, p.code
  FROM per p, LATERAL (SELECT unnest(generate_series(1, 90)) AS i) g),
cal AS (
  SELECT ticker, ds, is_future,
         CASE upper(code) WHEN 'GBP' THEN 'GB' WHEN 'HKD' THEN 'HK' ELSE 'US' END AS country
  FROM cal0 WHERE isodow(ds) <= 5)"""


def _model_terms() -> list[tuple[str, str]]:
    """(name, SQL) of each term of the linear-growth model, in order."""
    pi = "2 * pi()"
    out = [("one", "CAST(1 AS DOUBLE)"), ("t", "t")]
    out += [(f"bend{k}", f"greatest(t - CAST(0.8 AS DOUBLE) * {k} / 9, 0)") for k in range(1, 9)]
    for kind, period, order in (("year", "365.25", 4), ("week", "7", 2)):
        for k in range(1, order + 1):
            out += [(f"{f}_{kind}{k}", f"{f}(days * ({pi} * {k} / CAST({period} AS DOUBLE)))") for f in ("sin", "cos")]
    return [*out, ("holiday", "CASE WHEN holiday IS NULL THEN 0 ELSE 1 END")]


def _normal_sums() -> str:
    names = [n for n, _ in _model_terms()]
    return f"""{CALENDAR},
seen AS (
  SELECT t.ticker, t.ds, t.y, h.holiday FROM train t JOIN cal c ON t.ticker = c.ticker AND t.ds = c.ds
  LEFT JOIN (SELECT DISTINCT country, date, 'x' AS holiday FROM hol) h ON h.country = c.country AND h.date = t.ds
  WHERE t.y IS NOT NULL),
ends AS (SELECT ticker, min(ds) AS d0, greatest(max(ds) - min(ds), 1) AS span FROM seen GROUP BY ticker),
base AS (SELECT s.*, CAST(s.ds - e.d0 AS DOUBLE) / e.span AS t, CAST(s.ds - DATE '1970-01-01' AS DOUBLE) AS days
         FROM seen s JOIN ends e USING (ticker)),
terms AS (SELECT ticker, ds, y, unnest([{', '.join(f"'{n}'" for n in names)}]) AS a,
                 unnest([{', '.join(f"CAST({e} AS DOUBLE)" for _, e in _model_terms())}]) AS x,
                 unnest(range({len(names)})) AS i FROM base)
SELECT p.ticker, count(*) AS n, p.a, q.a AS b, round(sum(p.x * q.x) / count(*), 6) AS value
FROM terms p JOIN terms q ON p.ticker = q.ticker AND p.ds = q.ds AND p.i <= q.i GROUP BY p.ticker, p.a, q.a
UNION ALL
SELECT ticker, count(*), a, 'y', round(sum(x * y) / count(*), 4) FROM terms GROUP BY ticker, a"""


LATE_DAYS = f"""
target AS (SELECT * FROM dense_bars WHERE date <= DATE '{fx.SPLIT_DATE}' AND day(date) <> {fx.GAP_DAY}),
incoming AS (SELECT * FROM dense_bars WHERE date > DATE '{fx.SPLIT_DATE}' - INTERVAL {fx.LATE_MONTHS} MONTH)"""

CUTOFF_SQL = f"""{FORECAST_TRAIN},
seen AS (SELECT ticker, ds, y, CAST(ds - DATE '1999-01-01' AS DOUBLE) AS x FROM train WHERE y IS NOT NULL),
ends AS (SELECT ticker, min(ds) AS d0, max(ds) AS d1 FROM seen GROUP BY ticker),
cuts AS (SELECT ticker, CAST(k AS INTEGER) AS k, CAST(d1 - 60 - CAST(k * 30 AS INTEGER) AS DATE) AS cutoff
         FROM ends, range(1000) AS r(k) WHERE d1 - 60 - CAST(k * 30 AS INTEGER) >= d0 + 365)"""

ORACLE: dict[str, str] = {
    "daily_bars": f"WITH {DENSE_BARS} SELECT * FROM dense_bars",
    "yearly_report": f"""WITH {DENSE_BARS}
        SELECT CAST(year(date) AS BIGINT) AS year, ticker,
          CAST(sum(CAST(open AS DECIMAL(30,12))) AS DOUBLE) / count(open) AS avg_open,
          CAST(sum(CAST(close AS DECIMAL(30,12))) AS DOUBLE) / count(close) AS avg_close,
          CAST(sum(CAST(high AS DECIMAL(30,12))) AS DOUBLE) / count(high) AS avg_high,
          CAST(sum(CAST(low AS DECIMAL(30,12))) AS DOUBLE) / count(low) AS avg_low
        FROM dense_bars GROUP BY 1, 2""",
    "currency_lookup": f"""WITH {WIDE_CURRENCY}
        SELECT ticker, upper(trim(currency_code)) AS currency_code FROM wide_currency""",
    "fx_pairs": f"""WITH {WIDE_CURRENCY}
        SELECT DISTINCT upper(trim(currency_code)) AS from_currency, 'GBP' AS to_currency,
               upper(trim(currency_code)) || 'GBP=X' AS pair_symbol
        FROM wide_currency WHERE currency_code IS NOT NULL""",
    "fx_rates": f"""WITH {DENSE_CURRENCY},{DENSE_FX}
        SELECT * FROM dense_fx WHERE from_currency IN
          (SELECT upper(trim(currency_code)) FROM dense_currency) AND to_currency = 'GBP'""",
    "enriched_prices": f"""{DENSE}
        SELECT ticker, date, open, high, low, close, volume, dividends, currency_code, fx_close,
               rate, {MONEY}, day FROM master""",
    "fx_coverage": f"""{DENSE}
        SELECT count(*) AS total_rows,
               CAST(sum(CASE WHEN fx_close IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_rate_rows,
               CAST(sum(CASE WHEN rate IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unconverted_rows,
               round(sum(CASE WHEN fx_close IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 6)
                 AS missing_rate_pct
        FROM master""",
    "date_dimension": f"""WITH {DENSE_FX}
        SELECT DISTINCT strftime(date, '%m%d%Y') AS date_key, CAST(year(date) AS BIGINT) AS year,
               CAST(quarter(date) AS BIGINT) AS quarter, CAST(month(date) AS BIGINT) AS month
        FROM dense_fx""",
    "exchange_table": f"""WITH {DENSE_CURRENCY},{DENSE_FX}
        SELECT c.ticker, upper(trim(c.currency_code)) AS currency_code, f.date, f.open,
               f.close AS currency_close, f.low, f.high, f.from_currency, f.to_currency,
               strftime(f.date, '%m%d%Y') || f.from_currency AS exchange_id,
               strftime(f.date, '%m%d%Y') AS currency_date_key
        FROM dense_currency c RIGHT JOIN dense_fx f
          ON upper(trim(c.currency_code)) = f.from_currency""",
    "price_series": f"""{DENSE}
        SELECT ticker, date, {MONEY} FROM master WHERE conv IS NOT NULL""",
    "price_range_6m": f"""{DENSE}
        SELECT ticker, date, {MONEY} FROM master WHERE conv IS NOT NULL
          AND date > (SELECT max(date) FROM master WHERE conv IS NOT NULL) - INTERVAL 6 MONTH""",
    "price_range_ytd": f"""{DENSE}
        SELECT ticker, date, {MONEY} FROM master WHERE conv IS NOT NULL
          AND date >= date_trunc('year', (SELECT max(date) FROM master WHERE conv IS NOT NULL))""",
    "volume_series": f"{DENSE} SELECT ticker, date, volume FROM master",
    "daily_returns": f"{RETURNS} SELECT ticker, date, close, daily_return FROM returns",
    "daily_returns_chunked": f"{RETURNS} SELECT ticker, date, close, daily_return FROM returns",
    "return_histogram": _histogram(RETURNS),
    "cumulative_returns": f"{CUMULATIVE} SELECT ticker, date, cumulative_return FROM cum",
    "cumulative_returns_wide": f"""{CUMULATIVE}
        SELECT date,
          max(CASE WHEN ticker = 'A' THEN cumulative_return END) AS Close_A,
          max(CASE WHEN ticker = 'N' THEN cumulative_return END) AS Close_N,
          max(CASE WHEN ticker = 'R' THEN cumulative_return END) AS Close_R
        FROM cum GROUP BY date""",
    "rolling_means": f"""{DENSE}
        SELECT ticker, date, {MONEY}, {_ma(50, 25)}, {_ma(200, 100)}, {_ma(365, 182)},
               {_ma(1000, 500)} FROM master""",
    "rolling_means_chunked": f"""{DENSE}
        SELECT ticker, date, {MONEY}, {_ma(50, 25)}, {_ma(200, 100)}, {_ma(365, 182)},
               {_ma(1000, 500)} FROM master""",
    "rolling_average_report": f"""{DENSE},
        m AS (SELECT ticker, date, {MONEY}, {_ma(50, 25)}, {_ma(200, 100)}, {_ma(365, 182)},
                     {_ma(1000, 500)} FROM master)
        SELECT * FROM m WHERE ma1000 IS NOT NULL AND ma200 IS NOT NULL
          AND converted_close IS NOT NULL""",
    "rolling_means_wide_universe": f"""{WIDE}
        SELECT ticker, date, {MONEY}, {_ma(50, 25)}, {_ma(200, 100)}, {_ma(365, 182)},
               {_ma(1000, 500)} FROM wmaster""",
    "wide_to_long": f"WITH {DENSE_BARS} SELECT * FROM dense_bars",
    "financials_by_date": """
        SELECT l_returnflag AS ticker, make_date(CAST(year(l_shipdate) AS INTEGER), 12, 31) AS date,
          CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS discount,
          CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS extended_price,
          CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
          CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax
        FROM lineitem GROUP BY 1, 2""",
    "holders": """
        WITH q AS (
          SELECT l.l_returnflag AS ticker, n.n_name AS detail, CAST(sum(l.l_quantity) AS BIGINT) AS q
          FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
               JOIN nation n ON s.s_nationkey = n.n_nationkey
          GROUP BY 1, 2),
        t AS (SELECT *, sum(q) OVER (PARTITION BY ticker) AS tot FROM q),
        b AS (SELECT ticker, detail, CAST((q * 20000 + tot) // (tot * 2) AS BIGINT) AS bp FROM t)
        SELECT ticker,
               CAST(bp // 100 AS VARCHAR) || '.' || lpad(CAST(bp % 100 AS VARCHAR), 2, '0') || '%'
                 AS percent,
               detail,
               CAST(CAST(bp // 100 AS VARCHAR) || '.' || lpad(CAST(bp % 100 AS VARCHAR), 2, '0')
                 AS DOUBLE) AS percent_value
        FROM b""",
    "news_items": f"""
        SELECT (['{"', '".join(fx.NEWS_TICKERS)}'])[(page_id % {len(fx.NEWS_TICKERS)}) + 1] AS ticker,
               CAST(page_id AS VARCHAR) AS uuid,
               'Market update ' || CAST(page_id AS VARCHAR) AS title,
               regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1) AS publisher,
               url AS link,
               CASE WHEN page_id % 2 = 0 THEN {fx.NEWS_TIME_BASE} + page_id * 3600 END
                 AS provider_publish_time,
               'STORY' AS type
        FROM pages""",
    "ticker_master": f"WITH {DENSE_BARS} SELECT DISTINCT ticker FROM dense_bars",
    "last_update": f"WITH {DENSE_BARS} SELECT ticker, max(date) AS last_date FROM dense_bars GROUP BY 1",
    "incremental_new_bars": f"""WITH {DENSE_BARS}
        SELECT * FROM dense_bars WHERE date > DATE '{fx.SPLIT_DATE}'""",
    "incremental_late_days": f"""WITH {DENSE_BARS},{LATE_DAYS}
        SELECT * FROM incoming i WHERE NOT EXISTS (
          SELECT 1 FROM target t WHERE t.ticker = i.ticker AND t.date = i.date)""",
    "incremental_until": f"""WITH {DENSE_BARS},{LATE_DAYS}
        SELECT * FROM incoming i WHERE date < DATE '{fx.UNTIL}' AND NOT EXISTS (
          SELECT 1 FROM target t WHERE t.ticker = i.ticker AND t.date = i.date)""",
    "incremental_corrections": f"""WITH {DENSE_BARS},{LATE_DAYS}
        SELECT * REPLACE (CASE WHEN day(date) = {fx.CORRECTED_DAY} THEN close * 2 ELSE close END AS close) FROM incoming
        UNION ALL SELECT * FROM target t WHERE NOT EXISTS (
          SELECT 1 FROM incoming i WHERE t.ticker = i.ticker AND t.date = i.date)""",
    "stream_loads": f"""WITH {DENSE_BARS}
        SELECT * REPLACE (CASE WHEN day(date) = {fx.CORRECTED_DAY} THEN close * 2 ELSE close END AS close)
        FROM dense_bars""",
    "last_update_footers": f"WITH {DENSE_BARS} SELECT ticker, max(date) AS last_date FROM dense_bars GROUP BY 1",
    "colocated_series": f"""{WIDE},
        filled AS (
          SELECT b.ticker, b.date, b.close, upper(trim(c.currency_code)) AS currency_code,
                 last_value(close IGNORE NULLS) OVER (PARTITION BY b.ticker ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cf
          FROM wide_bars b LEFT JOIN wide_currency c ON b.ticker = c.ticker)
        SELECT ticker, date, close, currency_code,
               cf / nullif(lag(cf) OVER (PARTITION BY ticker ORDER BY date), 0) - 1 AS daily_return,
               {_ma(50, 25, "CAST(close AS DECIMAL(18,2))")}, {_ma(200, 100, "CAST(close AS DECIMAL(18,2))")}
        FROM filled""",
    "published_refresh": f"WITH {DENSE_BARS} SELECT * FROM dense_bars",
    "wide_file": f"WITH {DENSE_BARS} SELECT * FROM dense_bars",
    "rates_union": f"""WITH {DENSE_FX}
        SELECT * REPLACE (CASE WHEN from_currency = 'EUR' THEN NULL ELSE low END AS low,
                          CASE WHEN from_currency = 'EUR' THEN NULL ELSE high END AS high) FROM dense_fx""",
    "price_series_sorted": f"""{DENSE}
        SELECT ticker, date, {MONEY} FROM master WHERE conv IS NOT NULL ORDER BY date, ticker""",
    "exchange_table_hot": f"""WITH {WIDE_CURRENCY},{WIDE_FX},
        hot AS (SELECT ticker, CASE WHEN ticker LIKE '%7' THEN currency_code ELSE 'usd' END AS code FROM wide_currency)
        SELECT c.ticker, upper(trim(c.code)) AS currency_code, f.date, f.open, f.close AS currency_close, f.low, f.high,
               f.from_currency, f.to_currency, strftime(f.date, '%m%d%Y') || f.from_currency AS exchange_id,
               strftime(f.date, '%m%d%Y') AS currency_date_key
        FROM hot c RIGHT JOIN wide_fx f ON upper(trim(c.code)) = f.from_currency""",
    "news_open_keys": f"""
        SELECT (['{"', '".join(fx.NEWS_TICKERS)}'])[(page_id % {len(fx.NEWS_TICKERS)}) + 1] AS ticker,
               CAST(page_id AS VARCHAR) AS uuid, 'Market update ' || CAST(page_id AS VARCHAR) AS title,
               (page_id % 7) / CAST(4 AS DOUBLE) AS sentiment, 'p' || CAST(page_id % 3 AS VARCHAR) AS place,
               CAST(NULL AS VARCHAR) AS absent
        FROM pages""",
    "financials_open_items": """
        SELECT l_returnflag AS ticker, make_date(CAST(year(l_shipdate) AS INTEGER), 12, 31) AS date,
          CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS extended_price,
          CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax, CAST(NULL AS DOUBLE) AS goodwill
        FROM lineitem GROUP BY 1, 2""",
    "max_string_lengths": """
        WITH d AS (
          SELECT s.s_suppkey, s.s_name, s.s_acctbal, n.n_name, r.r_name
          FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
               LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
        m AS (SELECT max(length(s_name)) AS a, max(length(n_name)) AS b, max(length(r_name)) AS c FROM d)
        SELECT 's_suppkey' AS column_name, 'bigint' AS data_type, CAST(NULL AS BIGINT) AS max_length,
               'BIGINT' AS ddl_type FROM m
        UNION ALL SELECT 's_name', 'string', a, 'VARCHAR(' || CAST(coalesce(a, 1) AS VARCHAR) || ')' FROM m
        UNION ALL SELECT 's_acctbal', 'double', NULL, 'DOUBLE' FROM m
        UNION ALL SELECT 'n_name', 'string', b, 'VARCHAR(' || CAST(coalesce(b, 1) AS VARCHAR) || ')' FROM m
        UNION ALL SELECT 'r_name', 'string', c, 'VARCHAR(' || CAST(coalesce(c, 1) AS VARCHAR) || ')' FROM m""",
    "quality_report": _quality(DENSE, "dense_bars", "dense_fx", "dense_currency"),
    "linear_trend": f"""{FORECAST_TRAIN},
        xy AS (SELECT ticker, y, CAST(ds - DATE '1999-01-01' AS DOUBLE) AS x FROM train)
        SELECT ticker, count(y) AS n, round(regr_slope(y, x), 6) AS slope,
               round(regr_intercept(y, x), 6) AS intercept
        FROM xy GROUP BY ticker""",
    "future_calendar": f"""{CALENDAR}
        SELECT c.ticker, c.ds, c.is_future, c.country, h.holiday
        FROM cal c LEFT JOIN hol h ON c.country = h.country AND c.ds = h.date""",
    "forecast_scores": f"""{CALENDAR},
        coef AS (SELECT ticker, regr_slope(y, CAST(ds - DATE '1999-01-01' AS DOUBLE)) AS slope,
                        regr_intercept(y, CAST(ds - DATE '1999-01-01' AS DOUBLE)) AS intercept
                 FROM train GROUP BY ticker),
        pred AS (SELECT c.ticker, c.ds,
                        k.intercept + k.slope * CAST(c.ds - DATE '1999-01-01' AS DOUBLE) AS yhat
                 FROM cal c JOIN coef k USING (ticker)),
        j AS (SELECT t.ticker, t.y, p.yhat FROM train t JOIN pred p USING (ticker, ds))
        SELECT ticker, count(*) AS n, round(avg(abs(y - yhat)), 6) AS mae,
               round(avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)), 6) AS mape
        FROM j GROUP BY ticker""",
    "forecast_frame": f"""{CALENDAR}
        SELECT c.ticker, c.ds, t.y, c.is_future, true AS inside
        FROM cal c LEFT JOIN train t ON c.ticker = t.ticker AND c.ds = t.ds""",
    "forecast_normal_sums": _normal_sums(),
    "forecast_cutoffs": f"""{CUTOFF_SQL}
        SELECT ticker, k, cutoff FROM cuts""",
    "forecast_origin_errors": f"""{CUTOFF_SQL},
        fits AS (SELECT c.ticker, c.k, c.cutoff, regr_slope(s.y, s.x) AS slope, regr_intercept(s.y, s.x) AS intercept
                 FROM cuts c JOIN seen s ON s.ticker = c.ticker AND s.ds <= c.cutoff GROUP BY ALL),
        err AS (SELECT f.ticker, CAST(s.ds - f.cutoff AS INTEGER) AS horizon, s.y, s.y - f.intercept - f.slope * s.x AS e
                FROM fits f JOIN seen s ON s.ticker = f.ticker AND s.ds > f.cutoff AND s.ds <= f.cutoff + 60),
        by_day AS (SELECT ticker, horizon, count(e) AS n, sum(abs(e)) AS a, sum(e * e) AS q,
                          sum(abs(e) / greatest(abs(y), 2.220446049250313e-16)) AS p FROM err GROUP BY 1, 2)
        SELECT ticker, horizon, n, round(a / n, 4) AS mae, round(sqrt(q / n), 4) AS rmse, round(p / n, 6) AS mape,
               round(sum(a) OVER w / sum(n) OVER w, 4) AS mae_smooth
        FROM by_day WINDOW w AS (PARTITION BY ticker ORDER BY horizon RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "forecast_holdout_split": f"""{FORECAST_TRAIN}
        SELECT ticker, ds, row_number() OVER (PARTITION BY ticker ORDER BY ds DESC) <= 20 AS is_holdout
        FROM train WHERE y IS NOT NULL AND isodow(ds) <= 5""",
    "enriched_prices_wide": f"""{WIDE}
        SELECT ticker, date, open, high, low, close, volume, dividends, currency_code, fx_close,
               rate, {MONEY}, day FROM wmaster""",
    "daily_returns_wide": f"""{_returns(WIDE, "wmaster")}
        SELECT ticker, date, close, daily_return FROM returns""",
    "return_histogram_wide": _histogram(_returns(WIDE, "wmaster")),
    "cumulative_returns_wide_universe": f"""{_cumulative(
        WIDE, "SELECT ticker, date, close FROM wmaster WHERE close IS NOT NULL")}
        SELECT ticker, date, cumulative_return FROM cum""",
    "cumulative_returns_duplicates": _cumulative("WITH unused AS (SELECT 1 AS x)", """
        SELECT l_returnflag AS ticker, CAST(l_shipdate AS DATE) AS date,
               CASE WHEN count(*) = 1 THEN max(l_extendedprice)
                    ELSE CAST(sum(CAST(l_extendedprice AS DECIMAL(30,12))) AS DOUBLE) / count(*) END AS close
        FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1, 2""")
        + " SELECT ticker, date, round(cumulative_return, 9) AS cumulative_return FROM cum",
    "quality_report_wide": _quality(WIDE, "wide_bars", "wide_fx", "wide_currency"),
    "quality_violations": _quality(f"""{DENSE},
        bad_bars AS (SELECT ticker, date, CASE WHEN day(date) = 2 THEN -close ELSE close END AS close
                     FROM (SELECT * FROM dense_bars
                           UNION ALL SELECT * FROM dense_bars WHERE day(date) = 1)),
        bad_fx AS (SELECT * FROM dense_fx UNION ALL SELECT * FROM dense_fx WHERE day(date) = 15),
        bad_codes AS (SELECT * FROM dense_currency UNION ALL SELECT 'A', 'usd')""",
        "bad_bars", "bad_fx", "bad_codes"),
    "linear_trend_wide": f"""{WIDE},
        xy AS (SELECT ticker, close AS y, CAST(date - DATE '1999-01-01' AS DOUBLE) AS x
               FROM wmaster WHERE date > DATE '1999-01-01')
        SELECT ticker, count(y) AS n, round(regr_slope(y, x), 6) AS slope,
               round(regr_intercept(y, x), 4) AS intercept
        FROM xy GROUP BY ticker""",
    "exchange_table_wide": f"""WITH {WIDE_CURRENCY},{WIDE_FX}
        SELECT c.ticker, upper(trim(c.currency_code)) AS currency_code, f.date, f.open,
               f.close AS currency_close, f.low, f.high, f.from_currency, f.to_currency,
               strftime(f.date, '%m%d%Y') || f.from_currency AS exchange_id,
               strftime(f.date, '%m%d%Y') AS currency_date_key
        FROM wide_currency c RIGHT JOIN wide_fx f
          ON upper(trim(c.currency_code)) = f.from_currency""",
    "price_range_1m": f"""{DENSE}
        SELECT ticker, date, {MONEY} FROM master WHERE conv IS NOT NULL
          AND date > (SELECT max(date) FROM master WHERE conv IS NOT NULL) - INTERVAL 1 MONTH""",
    "price_range_1y": f"""{DENSE}
        SELECT ticker, date, {MONEY} FROM master WHERE conv IS NOT NULL
          AND date > (SELECT max(date) FROM master WHERE conv IS NOT NULL) - INTERVAL 1 YEAR""",
    "price_log": f"""{DENSE}
        SELECT ticker, date, round(log10(close), 9) AS log_close FROM master WHERE close > 0""",
    "rolling_average_6m": f"""{DENSE},
        m AS (SELECT ticker, date, {MONEY}, {_ma(50, 25)}, {_ma(200, 100)}, {_ma(365, 182)},
                     {_ma(1000, 500)} FROM master),
        full_rows AS (SELECT * FROM m WHERE ma1000 IS NOT NULL AND ma200 IS NOT NULL
                      AND converted_close IS NOT NULL)
        SELECT * FROM full_rows WHERE date > (SELECT max(date) FROM full_rows) - INTERVAL 6 MONTH""",
    "incremental_overlap": f"""WITH {DENSE_BARS}
        SELECT * FROM dense_bars WHERE date > DATE '{fx.SPLIT_DATE}' OR ticker = '{fx.LATE_TICKER}'""",
    "fx_overlap": f"""WITH {DENSE_FX}
        SELECT * REPLACE (CASE WHEN day(date) % 2 = 0 THEN close * 2 ELSE close END AS close)
        FROM dense_fx""",
    "bars_from_text": f"""WITH {DENSE_BARS}
        SELECT * REPLACE (CASE WHEN day(date) % 7 IN (0, 1) THEN NULL ELSE volume END AS volume)
        FROM dense_bars""",
    "currency_units": f"""WITH {WIDE_CURRENCY}
        SELECT ticker, upper(currency_code) AS currency_code,
               CASE WHEN currency_code = 'gbp' THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END AS unit_factor
        FROM wide_currency""",
}
ORACLE["news_feed_keys"] = ORACLE["news_items"]
ORACLE["yearly_view"] = ORACLE["yearly_report"]
