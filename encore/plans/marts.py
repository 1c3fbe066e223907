"""Star schema: one event fact and artist, venue and date dimensions with surrogate keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from encore.functions import calendar as cal
from encore.functions.keys import surrogate_key
from encore.functions.money import midpoint
from encore.operators.aggregates import distinct_rows
from encore.operators.filters import known
from encore.operators.joins import attach, attach_by_name, attach_key
from encore.operators.latest import first_per_key, latest_per_key


def _one_row_per_name(df: DataFrame, name: str) -> DataFrame:
    """The latest row of each lower-cased name."""
    keyed = df.withColumn("__name", F.lower(name))
    return latest_per_key(keyed, ["__name"]).drop("__name")


def dim_artists(
    events: DataFrame, listeners: DataFrame, performers: DataFrame, strict: bool = False
) -> DataFrame:
    """Artists of the events, enriched by name with audience and ticket-market signals.

    Signals are unique per name as scraped; two spellings that differ in case both
    match and give two rows with one key, which the uniqueness check reports.
    ``strict=True`` keeps the latest of them.
    """
    if strict:
        listeners = _one_row_per_name(listeners, "artist_name")
        performers = _one_row_per_name(performers, "performer_name")
    artists = known(events, "artist_name", "artist_id").select(
        F.col("artist_id").alias("tm_artist_id"), "artist_name", "genre"
    )
    artists = first_per_key(artists, ["tm_artist_id"], ["artist_name", "genre"])
    streaming = listeners.select(
        F.col("artist_id").alias("spotify_artist_id"), "artist_name", "spotify_url", "monthly_listeners"
    )
    market = performers.select(
        F.col("performer_id").alias("sg_performer_id"),
        "performer_name",
        "seatgeek_url",
        "sg_score",
        "sg_popularity",
        F.col("upcoming_events").alias("sg_upcoming_events"),
        F.col("genres").alias("sg_genres"),
    )
    enriched = attach_by_name(
        artists, streaming, "artist_name", "artist_name",
        ["spotify_artist_id", "spotify_url", "monthly_listeners"],
    )
    enriched = attach_by_name(
        enriched, market, "artist_name", "performer_name",
        ["sg_performer_id", "seatgeek_url", "sg_score", "sg_popularity", "sg_upcoming_events", "sg_genres"],
    )
    return enriched.select(surrogate_key("tm_artist_id").alias("artist_key"), *enriched.columns)


def dim_venues(events: DataFrame, strict: bool = False) -> DataFrame:
    """Venues of the events. A venue spelled in two ways gives two rows with one key;
    ``strict=True`` keeps the alphabetically first spelling."""
    details = ["venue_name", "city", "state"]
    if strict:
        venues = first_per_key(known(events, "venue_id").select("venue_id", *details), ["venue_id"], details)
    else:
        venues = distinct_rows(events, "venue_id", *details)
    return venues.select(surrogate_key("venue_id").alias("venue_key"), "venue_id", *details)


def dim_dates(events: DataFrame) -> DataFrame:
    """Dates of the events with their calendar attributes."""
    return distinct_rows(events, "event_date").select(
        surrogate_key("event_date").alias("date_key"),
        "event_date",
        cal.day_number("event_date").alias("day_of_week"),
        cal.day_name("event_date").alias("day_name"),
        F.month("event_date").alias("month_num"),
        cal.month_name("event_date").alias("month_name"),
        F.year("event_date").alias("year"),
        F.quarter("event_date").alias("quarter"),
        cal.is_weekend("event_date").alias("is_weekend"),
    )


def fact_events(
    events: DataFrame, artists: DataFrame, venues: DataFrame, dates: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """One row per staged event with the keys of its dimensions, NULL where there is none.

    ``events`` is already unique per event id, so it is not deduplicated again. Artist and venue keys are made from the
    event's ids as the dimensions make theirs; ``keep`` may store a small table under a name.
    """
    def stored(name: str) -> Callable[[DataFrame], DataFrame]:
        return lambda df: df if keep is None else keep(df, name)

    keyed = attach_key(events, artists, ("artist_id", "tm_artist_id"), "artist_key", surrogate_key, stored("other_artists"))
    keyed = attach_key(keyed, venues, ("venue_id", "venue_id"), "venue_key", surrogate_key, stored("other_venues"))
    keyed = attach(keyed, dates, {"event_date": "event_date"}, ["date_key"])
    return keyed.select(
        surrogate_key("event_id").alias("event_key"),
        "event_id",
        "event_name",
        "event_url",
        "artist_key",
        "venue_key",
        "date_key",
        "event_date",
        "event_time",
        "sale_status",
        "price_min",
        "price_max",
        midpoint("price_min", "price_max").alias("price_avg"),
        "currency",
        "loaded_at",
    )
