"""Country holiday dimension, generated by rule for the years in the data.

The `holidays` package is not available, so the calendar is a table we
author: fixed-date and rule-based public holidays of the three countries the
forecaster uses, the published dates of the HK lunar-calendar festivals, and
the GB days that were moved or declared once.  When a fixed-date US or GB
holiday falls on a weekend, its observed / substitute weekday is generated as
its own entry; a HK holiday on a Sunday gives the next free weekday.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import easter_sunday, last_weekday, nth_weekday

MON, THU, FRI = 0, 3, 4

# ---- fixed values: holiday rules per country ----------------------------------
# ("fixed", month, day) | ("nth", month, weekday, n) | ("last", month, weekday)
# | ("easter", offset_days) | ("weekday_after", month, day): the first
# Monday-to-Friday day after that date | ("observed", month, day, policy):
# only when that date is a Saturday or Sunday, moved to - "near": Friday
# before / Monday after; "next": the Monday after; "plus2": two days later.
# ("ching_ming",): the day of the solar term.
# Optional first year the holiday exists.
HOLIDAY_RULES = {
    "US": [
        ("New Year's Day", ("fixed", 1, 1), None),
        ("Martin Luther King Jr. Day", ("nth", 1, MON, 3), 1986),
        ("Washington's Birthday", ("nth", 2, MON, 3), None),
        ("Memorial Day", ("last", 5, MON), None),
        ("Juneteenth National Independence Day", ("fixed", 6, 19), 2021),
        ("Independence Day", ("fixed", 7, 4), None),
        ("Labor Day", ("nth", 9, MON, 1), None),
        ("Columbus Day", ("nth", 10, MON, 2), None),
        ("Veterans Day", ("fixed", 11, 11), None),
        ("Thanksgiving", ("nth", 11, THU, 4), None),
        ("Christmas Day", ("fixed", 12, 25), None),
        ("New Year's Day (observed)", ("observed", 1, 1, "near"), None),
        ("Juneteenth National Independence Day (observed)", ("observed", 6, 19, "near"), 2021),
        ("Independence Day (observed)", ("observed", 7, 4, "near"), None),
        ("Veterans Day (observed)", ("observed", 11, 11, "near"), None),
        ("Christmas Day (observed)", ("observed", 12, 25, "near"), None),
    ],
    "GB": [
        ("New Year's Day", ("fixed", 1, 1), None),
        ("Good Friday", ("easter", -2), None),
        ("Easter Monday", ("easter", 1), None),
        ("May Day", ("nth", 5, MON, 1), 1978),
        ("Spring Bank Holiday", ("last", 5, MON), None),
        ("Late Summer Bank Holiday", ("last", 8, MON), None),
        ("Christmas Day", ("fixed", 12, 25), None),
        ("Boxing Day", ("fixed", 12, 26), None),
        ("New Year's Day (substitute day)", ("observed", 1, 1, "next"), None),
        ("Christmas Day (substitute day)", ("observed", 12, 25, "plus2"), None),
        ("Boxing Day (substitute day)", ("observed", 12, 26, "plus2"), None),
    ],
    "HK": [
        ("The first day of January", ("fixed", 1, 1), None),
        ("Good Friday", ("easter", -2), None),
        ("The day following Good Friday", ("easter", -1), None),
        ("Easter Monday", ("easter", 1), None),
        ("Ching Ming Festival", ("ching_ming",), None),
        ("Labour Day", ("fixed", 5, 1), 1999),
        ("Hong Kong Special Administrative Region Establishment Day", ("fixed", 7, 1), 1997),
        ("National Day", ("fixed", 10, 1), 1997),
        ("Christmas Day", ("fixed", 12, 25), None),
        ("The first weekday after Christmas Day", ("weekday_after", 12, 25), None),
    ],
}
# Published first days of the HK lunar festivals (month-day), by year.
HK_FESTIVALS = {
    "Lunar New Year's Day": (
        "1992-02-04 1993-01-23 1994-02-10 1995-01-31 1996-02-19 1997-02-07 1998-01-28 1999-02-16 "
        "2000-02-05 2001-01-24 2002-02-12 2003-02-01 2004-01-22 2005-02-09 2006-01-29 2007-02-18 "
        "2008-02-07 2009-01-26 2010-02-14 2011-02-03 2012-01-23 2013-02-10 2014-01-31 2015-02-19 "
        "2016-02-08 2017-01-28 2018-02-16 2019-02-05 2020-01-25 2021-02-12 2022-02-01 2023-01-22 "
        "2024-02-10 2025-01-29 2026-02-17"),
    "The Birthday of the Buddha": (
        "1999-05-22 2000-05-11 2001-04-30 2002-05-19 2003-05-08 2004-05-26 2005-05-15 2006-05-05 "
        "2007-05-24 2008-05-12 2009-05-02 2010-05-21 2011-05-10 2012-04-28 2013-05-17 2014-05-06 "
        "2015-05-25 2016-05-14 2017-05-03 2018-05-22 2019-05-12 2020-04-30 2021-05-19 2022-05-08 "
        "2023-05-26 2024-05-15 2025-05-05"),
    "Tuen Ng Festival": (
        "1999-06-18 2000-06-06 2001-06-25 2002-06-15 2003-06-04 2004-06-22 2005-06-11 2006-05-31 "
        "2007-06-19 2008-06-08 2009-05-28 2010-06-16 2011-06-06 2012-06-23 2013-06-12 2014-06-02 "
        "2015-06-20 2016-06-09 2017-05-30 2018-06-18 2019-06-07 2020-06-25 2021-06-14 2022-06-03 "
        "2023-06-22 2024-06-10 2025-05-31"),
    "The day following the Chinese Mid-Autumn Festival": (
        "1999-09-25 2000-09-13 2001-10-02 2002-09-22 2003-09-12 2004-09-29 2005-09-19 2006-10-07 "
        "2007-09-26 2008-09-15 2009-10-04 2010-09-23 2011-09-13 2012-10-01 2013-09-20 2014-09-09 "
        "2015-09-28 2016-09-16 2017-10-05 2018-09-25 2019-09-14 2020-10-02 2021-09-22 2022-09-11 "
        "2023-09-30 2024-09-18 2025-10-07"),
    "Chung Yeung Festival": (
        "1999-10-17 2000-10-06 2001-10-25 2002-10-14 2003-10-04 2004-10-22 2005-10-11 2006-10-30 "
        "2007-10-19 2008-10-07 2009-10-26 2010-10-16 2011-10-05 2012-10-23 2013-10-13 2014-10-02 "
        "2015-10-21 2016-10-09 2017-10-28 2018-10-17 2019-10-07 2020-10-25 2021-10-14 2022-10-04 "
        "2023-10-23 2024-10-11 2025-10-29"),
}
# GB days that were moved or declared once: (date, name); moved days list the
# rule's date that does not hold in that year.
GB_ONCE = [
    ("1995-05-08", "May Day"), ("1999-12-31", "Millennium Celebrations"),
    ("2002-06-03", "Golden Jubilee of Elizabeth II"), ("2002-06-04", "Spring Bank Holiday"),
    ("2011-04-29", "Wedding of William and Catherine"), ("2012-06-04", "Spring Bank Holiday"),
    ("2012-06-05", "Diamond Jubilee of Elizabeth II"), ("2020-05-08", "May Day"),
    ("2022-06-02", "Spring Bank Holiday"), ("2022-06-03", "Platinum Jubilee of Elizabeth II"),
    ("2022-09-19", "State Funeral of Queen Elizabeth II"), ("2023-05-08", "Coronation of Charles III"),
]
GB_NOT_HELD = ["1995-05-01", "2002-05-27", "2012-05-28", "2020-05-04", "2022-05-30"]
# Holidays follow the instrument's currency; other currencies use a default.
CURRENCY_COUNTRY = {"GBP": "GB", "HKD": "HK"}
DEFAULT_COUNTRY = "US"
# -------------------------------------------------------------------------------


def _rule_date(year: Column, rule: tuple) -> Column:
    kind = rule[0]
    if kind == "fixed":
        return F.make_date(year, F.lit(rule[1]), F.lit(rule[2]))
    if kind == "nth":
        return nth_weekday(year, rule[1], rule[2], rule[3])
    if kind == "last":
        return last_weekday(year, rule[1], rule[2])
    if kind == "easter":
        return F.date_add("_easter", rule[1])
    if kind == "ching_ming":  # the solar term's usual formula for 2000-2099, a day later before
        short = F.pmod(year, F.lit(100))
        day = F.floor(short * 0.2422 + F.when(year >= 2000, 4.81).otherwise(5.59)) - F.floor(
            F.when(year >= 2000, short).otherwise(short - 1) / 4)
        return F.make_date(year, F.lit(4), day.cast("int"))
    if kind == "observed":
        base = F.make_date(year, F.lit(rule[1]), F.lit(rule[2]))
        wd = F.weekday(base)  # Sat = 5, Sun = 6
        shift = {"near": F.when(wd == 5, -1).when(wd == 6, 1),
                 "next": F.when(wd == 5, 2).when(wd == 6, 1),
                 "plus2": F.when(wd >= 5, 2)}[rule[3]]
        return F.date_add(base, shift)
    if kind == "weekday_after":
        base = F.make_date(year, F.lit(rule[1]), F.lit(rule[2]))
        wd = F.weekday(base)  # Fri -> +3, Sat -> +2, otherwise +1
        return F.date_add(base, F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1))
    raise ValueError(kind)


# The three days of Lunar New Year, and how far each is from the day before.
LUNAR_DAYS = {"Lunar New Year's Day": 1, "The second day of Lunar New Year": 2, "The third day of Lunar New Year": 3}


def dated_holidays(country: str) -> list[tuple[str, str]]:
    """(date, name) of the holidays known by date only."""
    if country == "GB":
        return GB_ONCE
    if country != "HK":
        return []
    out = []
    for name, days in HK_FESTIVALS.items():
        for day in days.split():
            out.append((day, name))
            if name in LUNAR_DAYS:
                first = dt.date.fromisoformat(day)
                out += [(str(first + dt.timedelta(days=n - 1)), other)
                        for other, n in LUNAR_DAYS.items() if n > 1]
    return out


def holiday_dimension(years: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """(country, date, holiday) for every year in `years` (column `year`).

    All rules are evaluated in one projection over the years (one struct per
    rule, then inline), so the years input is read once; holidays known by date
    come from the fixed tables above.  Size is bounded by countries x years x
    rules, so the result is safe to broadcast.
    """
    countries = countries or list(HOLIDAY_RULES)
    y = F.col("year").cast("int")
    years = years.select("year", easter_sunday(y).alias("_easter"))  # once, not per rule
    rows = []
    for country in countries:
        for name, rule, since in HOLIDAY_RULES[country]:
            d = _rule_date(y, rule)
            if since is not None:
                d = F.when(y >= since, d)
            if country == "GB":
                d = F.when(~d.cast("string").isin(GB_NOT_HELD), d)
            rows.append(F.struct(F.lit(country).alias("country"), d.alias("date"),
                                 F.lit(name).alias("holiday")))
    out = years.select(F.inline(F.array(*rows))).where(F.col("date").isNotNull())
    listed = ", ".join("('{}', DATE '{}', '{}')".format(c, day, name.replace("'", r"\'"))
                       for c in countries for day, name in dated_holidays(c))
    if listed:
        dated = years.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS v(country, date, holiday)")
        out = out.unionByName(dated.join(years, F.year(dated["date"]) == years["year"], "left_semi"))
    return out.unionByName(_after_sundays(out)) if "HK" in countries else out


# Years that `holiday_table` covers.
TABLE_YEARS = range(1900, 2200)
_TABLE: list = []


def holiday_table(spark: SparkSession) -> DataFrame:
    """(country, date, holiday) of all countries for TABLE_YEARS, one row per
    country and day, names joined.  The rules are evaluated once per process; the
    rows, of fixed number, are part of the plan, so no query derives its holiday
    years from its facts and a broadcast is bounded."""
    if not _TABLE:
        days = holiday_dimension(spark.range(TABLE_YEARS.start, TABLE_YEARS.stop, 1, 1).withColumnRenamed("id", "year"))
        _TABLE.append(days.groupBy("country", "date").agg(
            F.array_join(F.array_sort(F.collect_list("holiday")), ", ").alias("holiday")).toArrow())
    return spark.createDataFrame(_TABLE[0])


def _after_sundays(holidays: DataFrame) -> DataFrame:
    """HK: for each holiday on a Sunday, and for two on one day, the next day
    that is no holiday itself (at most five later: no longer run of holidays
    exists).  Until 2010 a Lunar New Year day on a Sunday gave the day before
    the first instead."""
    hk = holidays.where(F.col("country") == "HK")
    taken = hk.groupBy(F.year("date").alias("_y")).agg(F.collect_set("date").alias("_taken"))
    days = hk.groupBy("country", "date").agg(F.min("holiday").alias("holiday"), F.count(F.lit(1)).alias("n"))
    moved = days.where((F.weekday("date") == 6) | (F.col("n") > 1)).join(taken, F.year("date") == F.col("_y"))
    later = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.date_add("date", i))
    free = F.get(F.filter(later, lambda d: ~F.array_contains("_taken", d)), 0)
    place = F.create_map(*[F.lit(x) for kv in LUNAR_DAYS.items() for x in kv])[F.col("holiday")]
    early = place.isNotNull() & (F.year("date") <= 2010)
    return moved.select(
        "country", F.when(early, F.date_sub("date", place)).otherwise(free).alias("date"),
        F.when(early, F.lit("The day preceding Lunar New Year's Day"))
        .otherwise(F.concat(F.lit("The day following "), "holiday")).alias("holiday"))


def country_for_currency(code: Column, default: str = DEFAULT_COUNTRY) -> Column:
    """F5 rule: GBP -> GB, HKD -> HK, anything else -> the default country."""
    m = F.create_map(*[F.lit(x) for kv in CURRENCY_COUNTRY.items() for x in kv])
    return F.coalesce(m[F.upper(code)], F.lit(default))
