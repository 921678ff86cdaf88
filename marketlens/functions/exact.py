"""Exact money arithmetic.

Sums of doubles depend on the order rows arrive in, so every average and
running sum here is taken over decimals and divided once at the end.  The
types are chosen so that no intermediate result needs more than 38 digits,
which would make Spark drop scale silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed numeric policy (all products and sums stay exact inside these).
PRICE_DEC = T.DecimalType(18, 6)    # a quoted price
RATE_DEC = T.DecimalType(18, 10)    # an FX rate
AMOUNT_DEC = T.DecimalType(30, 12)  # a converted price, or any summed value
RUNNING_DEC = T.DecimalType(36, 12)  # a running (prefix) sum of amounts


def as_amount(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(AMOUNT_DEC)


def exact_avg(c: Column | str) -> Column:
    """Mean of the non-null values, exact up to the final division."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(as_amount(col)).cast("double"), F.count(col).cast("double"))


def convert(price: Column | str, rate: Column | str) -> Column:
    """price x rate, exact where both factors fit the decimal policy.

    A factor that the policy would cut or reject (a price from 1e12, a rate
    from 1e8 or with more than ten decimals) is multiplied as a double and the
    product rounded to the amount type.  Only a product beyond that type is
    NULL; rule `conversion_lost` of the quality report counts those.
    """
    p = F.col(price) if isinstance(price, str) else price
    r = F.col(rate) if isinstance(rate, str) else rate
    pd, rd = p.try_cast(PRICE_DEC), r.try_cast(RATE_DEC)
    whole = (pd.cast("double") == p.cast("double")) & (rd.cast("double") == r.cast("double"))
    return F.when(whole, (pd * rd).try_cast(AMOUNT_DEC)).otherwise(
        (p.cast("double") * r.cast("double")).try_cast(AMOUNT_DEC))


def money(c: Column | str, places: int = 6) -> Column:
    """Round a decimal to `places` and hand it out as double."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, places).cast("double")
