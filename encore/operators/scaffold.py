"""Complete calendars: groups without events on a day still show the day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from encore.functions.calendar import DAYS


def fill_days(
    counts: DataFrame,
    day: str = "day_name",
    n: str = "events",
    by: Sequence[str] = (),
    days: Sequence[str] = DAYS,
) -> DataFrame:
    """Every listed day for every group, 0 where the group has no row for it.

    One aggregate with a conditional sum per day, unfolded into rows. It gives
    what a left join of the calendar would, without evaluating the groups twice;
    without groups it gives all days even for empty input.
    """
    sums = [
        F.coalesce(F.sum(F.when(F.col(day) == d, F.col(n))), F.lit(0)).cast("bigint").alias(f"__{i}")
        for i, d in enumerate(days)
    ]
    wide = counts.groupBy(*by).agg(*sums)
    rows = F.array(*[F.struct(F.lit(d).alias(day), F.col(f"__{i}").alias(n)) for i, d in enumerate(days)])
    return wide.select(*by, F.inline(rows))
