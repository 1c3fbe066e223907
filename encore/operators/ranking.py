"""Orders, limits and top-k rows. Every order is total, so results never depend on luck.

``orderBy(...).limit(k)`` is planned as one top-k step: each task keeps k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from encore.functions.calendar import ordinal


def top_k(df: DataFrame, metric: str, k: int, ties: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """The k rows with the largest metric, NULLs last; the lower ``ties`` win at the cut.

    ``ascending=True`` presents the chosen rows smallest first, as bar charts want them.
    """
    top = df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]).limit(k)
    if not ascending:
        return top
    return top.orderBy(F.col(metric).asc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties])


def by_ordinal(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """Sort by a fixed order of values, such as Monday to Sunday; unlisted values last."""
    rank = ordinal(col, order)
    return df.orderBy(F.when(rank > 0, rank).asc_nulls_last(), F.col(col))


def best(value: str | Column, metric: str, ties: str) -> Column:
    """Aggregate: value of the row with the largest metric, the lower ``ties`` on equal ones."""
    value = F.col(value) if isinstance(value, str) else value
    return F.min_by(value, F.struct(-F.col(metric), F.col(ties)))


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """Full sort of a report, at its very edge only."""
    return df.orderBy(*order)
