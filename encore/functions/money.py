"""Prices, streaming estimates and ratios. NULL inputs give NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .column import as_column

# Plays per listener and month, months, dollars per play.
PLAYS_PER_LISTENER = 50
MONTHS_PER_YEAR = 12
DOLLARS_PER_PLAY = 0.004


def midpoint(low, high) -> Column:
    """Half way between two prices, NULL unless both are known."""
    low, high = as_column(low), as_column(high)
    return F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2)


def is_priced(price) -> Column:
    """Known, positive and a number: NaN is greater than all numbers in Spark."""
    price = as_column(price)
    return (price > 0) & (price.cast("double") != float("nan"))


def priced(price) -> Column:
    """The price where it is known and positive, else NULL: feed it to avg, sum or count."""
    return F.when(is_priced(price), as_column(price))


def streaming_estimate(
    listeners,
    plays: int = PLAYS_PER_LISTENER,
    months: int = MONTHS_PER_YEAR,
    rate: float = DOLLARS_PER_PLAY,
) -> Column:
    """Estimated yearly streaming revenue of an audience."""
    return as_column(listeners).cast("double") * plays * months * rate


def revenue_ratio(gross, estimate) -> Column:
    """Gross over estimate, the estimate being at least 1. ``greatest`` skips NULLs, so guard it."""
    gross, estimate = as_column(gross).cast("double"), as_column(estimate)
    return F.when(estimate.isNotNull(), gross / F.greatest(estimate, F.lit(1.0)))


def revenue_multiplier(gross, estimate) -> Column:
    """The ratio as a whole number, halves to even."""
    return F.bround(revenue_ratio(gross, estimate), 0).cast("bigint")


def conversion_rate(tickets, listeners) -> Column:
    """Tickets per hundred listeners, one decimal, halves to even; NULL for no listeners."""
    share = F.try_divide(as_column(tickets).cast("double"), as_column(listeners).cast("double"))
    return F.bround(share * 100, 1)
