"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .column import as_column

# Fixed value: stands for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols) -> Column:
    """md5 of the parts as text, joined by ``-``; NULL parts count as ``NULL_TOKEN``."""
    parts = [
        F.coalesce(as_column(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))


def packed_key(c) -> Column:
    """A text key for shuffles and joins: 16 bytes for the 32 digits of a surrogate key; other texts stay longer ones, so none meet that were different.

    It is a text of these bytes, not to be shown: Spark takes a binary column for five times as large and would broadcast less.
    """
    text = as_column(c)
    half = F.unhex(text)
    return F.when((F.octet_length(text) == 32) & (F.lower(F.hex(half)) == text), half).otherwise(
        F.concat(F.lit(bytes(17)), text.cast("binary"))).cast("string")
