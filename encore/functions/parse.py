"""Values captured from scraped page text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .column import as_column
from .text import empty_to_null

# The two patterns looked for in page text. \s covers Unicode spaces.
LISTENERS_PATTERN = r"(?i)([\d,]+)(?U:\s*)monthly(?U:\s*)listeners"
ARTIST_LINK_PATTERN = r"https://open\.spotify\.com/artist/([a-zA-Z0-9]+)"


def monthly_listeners(text) -> Column:
    """``85,000 Monthly Listeners`` -> 85000; NULL when there is no such phrase."""
    digits = F.replace(F.regexp_extract(as_column(text), LISTENERS_PATTERN, 1), F.lit(","), F.lit(""))
    return empty_to_null(digits).try_cast("decimal(38,0)")


def artist_link_id(text) -> Column:
    """Id of the first artist link in a text, NULL when there is none."""
    return empty_to_null(F.regexp_extract(as_column(text), ARTIST_LINK_PATTERN, 1))
