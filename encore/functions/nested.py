"""Safe access to nested values: a missing part gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .column import as_column
from .text import empty_to_null


def first_of(array) -> Column:
    """First element; NULL for a missing or empty array (``array[0]`` raises on empty)."""
    return F.get(as_column(array), F.lit(0))


def first_where(array, predicate) -> Column:
    """First element that satisfies the predicate, else the first element, else NULL."""
    array = as_column(array)
    return F.coalesce(F.get(F.filter(array, predicate), F.lit(0)), F.get(array, F.lit(0)))


def joined_names(array, field: str = "name", sep: str = ", ") -> Column:
    """Names of a list of structs as one text; an empty or missing list gives NULL."""
    names = F.transform(as_column(array), lambda x: F.coalesce(x[field], F.lit("")))
    return empty_to_null(F.array_join(names, sep))
