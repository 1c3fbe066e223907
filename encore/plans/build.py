"""The whole build: raw tables -> staging -> star schema, and its quality report.

All models are written as tables of a new version below the shared folder, which readers see as a whole once the last one is there: staging events feed all four marts, the other
staging models feed many reports and the checks, and none is evaluated twice. Dimensions are written before
the fact, so that Spark plans its joins from their real sizes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from encore.operators.checks import Check, not_null, run_checks, unique
from encore.operators.lookup import geocode
from encore.session import small_sorts
from encore.sources import versions
from encore.sources.tables import materialise

from . import marts, staging
from .star import Dimension, Star

# Which columns are checked. Audience may be missing, which only warns.
CHECKS: dict[str, list[Check]] = {
    "stg_ticketmaster_events": [not_null(c) for c in ("event_id", "event_name", "event_date", "venue_name")],
    "stg_spotify_artists": [not_null("artist_name"), not_null("monthly_listeners", "warn")],
    "stg_seatgeek_performers": [not_null("performer_name"), not_null("sg_score")],
    "stg_seatgeek_events": [not_null("event_id")],
    "fact_events": [unique("event_key"), not_null("event_key")],
    "dim_artists": [unique("artist_key"), not_null("artist_key")],
    "dim_venues": [unique("venue_key"), not_null("venue_key")],
    "dim_dates": [unique("date_key"), not_null("date_key")],
}


@dataclass(frozen=True)
class Models:
    """All models of one build."""

    stg_ticketmaster_events: DataFrame
    stg_spotify_artists: DataFrame
    stg_seatgeek_performers: DataFrame
    stg_seatgeek_events: DataFrame
    stg_tour_revenue: DataFrame
    dim_artists: DataFrame
    dim_venues: DataFrame
    dim_dates: DataFrame
    fact_events: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, location: str) -> "Models":
        """The models of the build published last, all of one version."""
        place = versions.current(spark, location)
        return cls(**{f.name: spark.read.parquet(f"{place}/{f.name}") for f in fields(cls)})

    def star(self, places: DataFrame | None = None, unique_events: bool = False) -> Star:
        """The star for the reports; with ``places`` the venues carry coordinates."""
        venues = self.dim_venues if places is None else geocode(self.dim_venues, places)
        return Star(
            self.fact_events,
            Dimension(self.dim_artists, "artist_key"),
            Dimension(venues, "venue_key"),
            Dimension(self.dim_dates, "date_key"),
            unique_events,
        )

    def quality_report(self) -> DataFrame:
        """Every declared check of every model."""
        report = None
        for name, checks in CHECKS.items():
            part = run_checks(getattr(self, name), name, checks)
            report = part if report is None else report.unionByName(part)
        return report


def staged(
    raw: dict[str, DataFrame], tiebreaks: dict[str, list] | None = None, lenient: bool = False
) -> dict[str, DataFrame]:
    """The staging models; ``lenient`` makes values that cannot be read NULL instead of failing the run."""
    ties = tiebreaks or {}

    def latest(model, table: str, **more) -> DataFrame:
        return model(raw[table], ties.get(table), lenient, **more)

    return {
        "stg_ticketmaster_events": latest(staging.stg_ticketmaster_events, "raw_ticketmaster_events", whole=True),
        "stg_spotify_artists": latest(staging.stg_spotify_artists, "raw_spotify_artists"),
        "stg_seatgeek_performers": latest(staging.stg_seatgeek_performers, "raw_seatgeek_performers"),
        "stg_seatgeek_events": latest(staging.stg_seatgeek_events, "raw_seatgeek_events", whole=True),
        "stg_tour_revenue": staging.stg_tour_revenue(raw["raw_tour_revenue"], lenient),
    }


def build(
    raw: dict[str, DataFrame],
    location: str,
    strict: bool = False,
    tiebreaks: dict[str, list] | None = None,
    partition_fact_by: Sequence[str] = (),
    lenient: bool = False,
    keep_for: timedelta | None = None,
) -> Models:
    """Build all models; tables go below ``location``, a folder that all executors share.

    They are a version of their own, published at the end: readers of ``location`` see the version before it
    until then, and if the build fails. ``keep_for`` removes versions made longer ago, but the last two published.
    Partition the fact, for instance by ``event_date``, where its volume justifies it.
    """
    small_sorts(raw["raw_ticketmaster_events"].sparkSession)
    root, location = location, versions.new_version(location)
    small = {name: materialise(df, f"{location}/{name}") for name, df in staged(raw, tiebreaks, lenient).items()}
    events = small["stg_ticketmaster_events"]
    listeners, performers = small["stg_spotify_artists"], small["stg_seatgeek_performers"]
    artists = materialise(marts.dim_artists(events, listeners, performers, strict), f"{location}/dim_artists")
    venues = materialise(marts.dim_venues(events, strict), f"{location}/dim_venues")
    dates = materialise(marts.dim_dates(events), f"{location}/dim_dates")
    fact = marts.fact_events(events, artists, venues, dates, lambda df, name: materialise(df, f"{location}/{name}"))
    fact = materialise(fact, f"{location}/fact_events", partition_fact_by)
    spark = fact.sparkSession
    versions.publish(spark, root, location)
    if keep_for is not None:
        versions.remove_old(spark, root, keep_for)
    return Models(
        dim_artists=artists, dim_venues=venues, dim_dates=dates, fact_events=fact, **small
    )
