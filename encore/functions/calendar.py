"""Calendar attributes of a date and the two notions of a weekend."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .column import as_column

# Order in which days and months are presented.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
FRIDAY_TO_SUNDAY = ["Friday", "Saturday", "Sunday"]


def day_number(d) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark counts from 1 = Sunday)."""
    return F.dayofweek(as_column(d)) - 1


def day_name(d) -> Column:
    """Full English name; ``F.dayname`` would give three letters."""
    return F.date_format(as_column(d), "EEEE")


def month_name(d) -> Column:
    """Three letters, ``Jan`` ... ``Dec``."""
    return F.monthname(as_column(d))


def is_weekend(d) -> Column:
    """Saturday or Sunday; false for a missing date, as CASE ... ELSE false is."""
    return F.coalesce(F.dayofweek(as_column(d)).isin(1, 7), F.lit(False))


def weekend_label(flag) -> Column:
    """Text of the Saturday-Sunday flag; a missing flag counts as a weekday."""
    return F.when(as_column(flag), "Weekend").otherwise("Weekday")


def long_weekend_label(name) -> Column:
    """Friday to Sunday counts as weekend here, unlike ``is_weekend``."""
    return F.when(as_column(name).isin(*FRIDAY_TO_SUNDAY), "Weekend").otherwise("Weekday")


def ordinal(c, order: list[str]) -> Column:
    """Position of a value in a fixed order, from 1; NULL for a NULL value."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), as_column(c))
