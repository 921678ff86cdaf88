"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_symbol(code: Column | str, base: str = "GBP") -> Column:
    """Quote symbol of an FX pair, e.g. USD -> USDGBP=X."""
    c = F.col(code) if isinstance(code, str) else code
    return F.concat(c, F.lit(f"{base}=X"))


def flat_name(prefix: str, ticker: str) -> str:
    """Column name for a ticker in a wide table; dots are not allowed."""
    return f"{prefix}_{ticker}".replace(".", "_")


def url_host(url: Column | str) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def basis_points_text(bp: Column) -> Column:
    """Whole basis points (bigint) as fixed two-decimal percent text."""
    return F.concat(
        F.floor(bp / 100).cast("bigint").cast("string"), F.lit("."),
        F.lpad(F.pmod(bp, F.lit(100)).cast("string"), 2, "0"), F.lit("%"))


def fixed2(x: Column | str) -> Column:
    """A number as text with exactly two decimals (no grouping)."""
    c = F.col(x) if isinstance(x, str) else x
    return F.format_string("%.2f", c.cast("double"))


def joined_names(names: Column | str) -> Column:
    """C11: the distinct names of an array column in order, space-separated."""
    c = F.col(names) if isinstance(names, str) else names
    return F.array_join(F.array_sort(F.array_distinct(c)), " ")
