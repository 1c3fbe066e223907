"""Row filters. Each is a plain predicate, so Spark pushes it to the scan where it may."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from encore.functions.money import is_priced
from encore.functions.text import same_name


def known(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def known_text(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is neither NULL nor empty."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def above(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Rows above a threshold; NULL is dropped. Apply it after ``latest_per_key``, never before."""
    return df.where(F.col(col) > threshold)


def at_most(df: DataFrame, col: str, bound: float) -> DataFrame:
    return df.where(F.col(col) <= bound)


def priced_rows(df: DataFrame, price: str = "price_avg") -> DataFrame:
    """Rows with a known, positive price."""
    return df.where(F.col(price).isNotNull() & is_priced(price))


def selected(df: DataFrame, col: str, value=None) -> DataFrame:
    """Rows equal to a chosen value; no value chosen means all rows."""
    return df if value is None else df.where(F.col(col) == F.lit(value))


def selected_name(df: DataFrame, col: str, value: str | None = None) -> DataFrame:
    """As ``selected``, ignoring case."""
    return df if value is None else df.where(same_name(col, F.lit(value)))
