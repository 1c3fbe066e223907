"""Optional text form of report numbers. The numeric columns stay the primary result."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .column import as_column

DASH = "—"
NOT_AVAILABLE = "N/A"
DYNAMIC = "Dynamic"


def thousands(c, missing: str = DASH) -> Column:
    """1234567.0 -> ``1,234,567``."""
    return F.coalesce(F.format_number(as_column(c), 0), F.lit(missing))


def positive_thousands(c, missing: str = DASH) -> Column:
    """As ``thousands``, but zero and negative values count as missing."""
    c = as_column(c)
    return F.coalesce(F.when(c > 0, F.format_number(c, 0)), F.lit(missing))


def two_decimals(c, missing: str = DASH) -> Column:
    """0.9 -> ``0.90``."""
    text = F.replace(F.format_number(as_column(c), 2), F.lit(","), F.lit(""))
    return F.coalesce(text, F.lit(missing))


def dollars(c, missing: str = NOT_AVAILABLE) -> Column:
    """85.4 -> ``$85``; NULL, zero and negative prices show the missing text."""
    c = as_column(c)
    return F.coalesce(F.when(c > 0, F.concat(F.lit("$"), F.format_number(c, 0))), F.lit(missing))


def millions(c, missing: str = DASH) -> Column:
    """2200000000 -> ``$2,200M``."""
    scaled = as_column(c).cast("double") / 1e6
    return F.coalesce(F.concat(F.lit("$"), F.format_number(scaled, 0), F.lit("M")), F.lit(missing))


def billions(c, missing: str = DASH) -> Column:
    """6800000000 -> ``$6.8B``."""
    scaled = as_column(c).cast("double") / 1e9
    return F.coalesce(F.concat(F.lit("$"), F.format_number(scaled, 1), F.lit("B")), F.lit(missing))


def percent(c, missing: str = DASH) -> Column:
    """12.34 -> ``12.3%``."""
    text = F.replace(F.format_number(as_column(c), 1), F.lit(","), F.lit(""))
    return F.coalesce(F.concat(text, F.lit("%")), F.lit(missing))


def times(c, missing: str = DASH) -> Column:
    """12 -> ``12x``."""
    return F.coalesce(F.concat(as_column(c).cast("string"), F.lit("x")), F.lit(missing))
