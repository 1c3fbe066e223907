"""Staging models: latest row per natural key, cleaned and cast.

The casts run under ANSI rules, so a malformed value fails the run as it does in
the warehouse; ``lenient=True`` turns such values into NULL instead. ``whole`` tells that all columns of a wide model are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from encore.functions.text import WORD_BREAKS, clean_code, clean_name
from encore.operators.filters import above
from encore.operators.latest import latest_per_key

# Fixed value: performers at or below this score are left out.
SCORE_THRESHOLD = 0.5

Tiebreak = Sequence[str | Column] | None


def _cast(name: str, to: str, lenient: bool) -> Column:
    c = F.col(name)
    return (c.try_cast(to) if lenient else c.cast(to)).alias(name)


def _trim(*names: str) -> list[Column]:
    return [F.trim(n).alias(n) for n in names]


def _names(breaks: str, *names: str) -> list[Column]:
    return [clean_name(n, breaks).alias(n) for n in names]


def _codes(*names: str) -> list[Column]:
    return [clean_code(n).alias(n) for n in names]


def stg_ticketmaster_events(
    raw: DataFrame, tiebreak: Tiebreak = None, lenient: bool = False, breaks: str = WORD_BREAKS, whole: bool = False
) -> DataFrame:
    """One cleaned row per event."""
    latest = latest_per_key(raw, ["event_id"], tiebreak=tiebreak, whole=whole)
    return latest.select(
        *[_cast(c, "string", False) for c in ("event_id", "artist_id", "venue_id")],
        *_trim("event_name", "event_url"),
        *_codes("sale_status"),
        *_trim("genre"),
        *_names(breaks, "artist_name", "venue_name", "city"),
        *_codes("state"),
        _cast("event_date", "date", lenient),
        _cast("event_time", "string", False),
        _cast("price_min", "decimal(10,2)", lenient),
        _cast("price_max", "decimal(10,2)", lenient),
        *_codes("currency"),
        _cast("loaded_at", "timestamp", lenient),
    )


def stg_spotify_artists(
    raw: DataFrame, tiebreak: Tiebreak = None, lenient: bool = False, breaks: str = WORD_BREAKS
) -> DataFrame:
    """One cleaned row per artist name as scraped (names may meet after cleaning)."""
    if tiebreak is None:  # only columns the model keeps: the page text is not read
        tiebreak = ["artist_id", "spotify_url", "monthly_listeners", "page_title", "page_description"]
    latest = latest_per_key(raw, ["artist_name"], tiebreak=tiebreak)
    return latest.select(
        _cast("artist_id", "string", False),
        *_names(breaks, "artist_name"),
        *_trim("spotify_url"),
        _cast("monthly_listeners", "bigint", lenient),
        *_trim("page_title", "page_description"),
        _cast("loaded_at", "timestamp", lenient),
    )


def stg_seatgeek_performers(
    raw: DataFrame,
    tiebreak: Tiebreak = None,
    lenient: bool = False,
    breaks: str = WORD_BREAKS,
    threshold: float = SCORE_THRESHOLD,
) -> DataFrame:
    """One cleaned row per performer whose latest score is above the threshold."""
    latest = above(latest_per_key(raw, ["performer_name"], tiebreak=tiebreak), "sg_score", threshold)
    return latest.select(
        _cast("performer_id", "string", False),
        *_names(breaks, "performer_name"),
        *_trim("short_name", "seatgeek_url"),
        _cast("sg_score", "double", lenient),
        _cast("sg_popularity", "double", lenient),
        _cast("upcoming_events", "bigint", lenient),
        *_trim("genres", "performer_type"),
        _cast("loaded_at", "timestamp", lenient),
    )


def stg_seatgeek_events(
    raw: DataFrame, tiebreak: Tiebreak = None, lenient: bool = False, breaks: str = WORD_BREAKS, whole: bool = False
) -> DataFrame:
    """One cleaned row per ticket listing."""
    latest = latest_per_key(raw, ["event_id"], tiebreak=tiebreak, whole=whole)
    return latest.select(
        _cast("event_id", "string", False),
        *_trim("event_title", "event_url"),
        _cast("event_date", "date", lenient),
        _cast("event_time", "string", False),
        *_trim("event_type"),
        *_names(breaks, "performer_name"),
        _cast("performer_id", "string", False),
        *_names(breaks, "venue_name"),
        _cast("venue_id", "string", False),
        *_names(breaks, "city"),
        *_codes("state"),
        *[_cast(c, "double", lenient) for c in ("lowest_price", "average_price", "highest_price")],
        _cast("listing_count", "bigint", lenient),
        *[_cast(c, "double", lenient) for c in ("event_popularity", "event_score")],
        _cast("loaded_at", "timestamp", lenient),
    )


def stg_tour_revenue(raw: DataFrame, lenient: bool = False, breaks: str = WORD_BREAKS) -> DataFrame:
    """Cleaned tours. The table is refreshed as a whole, so there is nothing to deduplicate."""
    numbers = ("gross_revenue", "tickets_sold", "avg_ticket_price", "shows")
    return raw.select(
        *_names(breaks, "artist_name"),
        *_trim("tour_name"),
        *[_cast(c, "decimal(38,0)", lenient) for c in numbers],
        *_trim("tour_year", "source"),
        _cast("loaded_at", "timestamp", lenient),
    )
