"""Shared by the column builders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(c) -> Column:
    """A column given by name or as an expression."""
    return F.col(c) if isinstance(c, str) else c
