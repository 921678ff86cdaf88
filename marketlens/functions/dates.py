"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday(c: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(c))


def is_weekday(c: Column | str) -> Column:
    return weekday(c) <= 4


def date_key(c: Column | str) -> Column:
    """Month, day, four-digit year with no separators (e.g. 03182024)."""
    return F.date_format(_c(c), "MMddyyyy")


def nth_weekday(year: Column, month: int, wd: int, n: int) -> Column:
    """The n-th given weekday (Mon=0) of a month."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    shift = F.pmod(F.lit(wd) - F.weekday(first), F.lit(7)) + (n - 1) * 7
    return F.date_add(first, shift.cast("int"))


def last_weekday(year: Column, month: int, wd: int) -> Column:
    """The last given weekday (Mon=0) of a month."""
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    shift = F.pmod(F.weekday(last) - F.lit(wd), F.lit(7))
    return F.date_sub(last, shift.cast("int"))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus)."""
    y = year.cast("int")
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100).cast("int")
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4).cast("int")
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4).cast("int")
    k = F.pmod(c, F.lit(4))
    el = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * el) / 451).cast("int")
    month = F.floor((h + el - 7 * m + 114) / 31).cast("int")
    day = F.pmod(h + el - 7 * m + 114, F.lit(31)) + 1
    return F.make_date(y, month, day)
