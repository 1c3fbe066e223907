"""The analyses: demand, prices, revenue, artists, markets, calendar.

Each takes the star and the small staging tables and returns a lazy DataFrame for
all artists, states or genres at once; a chosen value is an optional filter.
Prices are averaged as ``price_sum / price_n``, so partial results merge exactly.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from encore.functions import report_text as text
from encore.functions.calendar import DAYS, MONTHS, long_weekend_label
from encore.functions.money import (
    conversion_rate,
    revenue_multiplier,
    revenue_ratio,
    streaming_estimate,
)
from encore.functions.text import venue_label
from encore.operators.aggregates import (
    count_text_by,
    histogram,
    mean,
    union_distinct,
)
from encore.operators.filters import at_most, known, priced_rows, selected, selected_name
from encore.operators.joins import attach, left_by_name_key, outer_by_name, without_names
from encore.operators.latest import top_per_group
from encore.operators.ranking import best, by_ordinal, top_k
from encore.operators.scaffold import fill_days

from . import sketches
from .star import MEASURES, Star


def _mean_price() -> Column:
    """NULL where no event is priced: the sum is NULL then."""
    return F.try_divide(F.col("price_sum").cast("double"), F.col("price_n").cast("double"))


def listeners_view(stg_artists: DataFrame) -> DataFrame:
    """Artists with a known audience."""
    return known(stg_artists, "monthly_listeners").select(
        "artist_name", F.col("monthly_listeners").cast("double").alias("monthly_listeners")
    )


def market_view(stg_performers: DataFrame) -> DataFrame:
    """Ticket-market signals under the artist's name."""
    return stg_performers.select(
        F.col("performer_name").alias("artist_name"),
        F.col("sg_score").cast("double").alias("sg_score"),
        F.col("sg_popularity").cast("double").alias("sg_popularity"),
        F.col("upcoming_events").cast("bigint").alias("sg_upcoming_events"),
        F.col("genres").alias("sg_genres"),
    )


def tours_view(stg_tours: DataFrame) -> DataFrame:
    numbers = ["gross_revenue", "tickets_sold", "avg_ticket_price"]
    return stg_tours.select(
        "artist_name",
        "tour_name",
        *[F.col(c).cast("double").alias(c) for c in numbers],
        F.col("shows").cast("bigint").alias("shows"),
        "tour_year",
        "source",
    )


# Overview ---------------------------------------------------------------------------------


def overview(star: Star, cells: DataFrame | None = None) -> DataFrame:
    """Events, artists, venues and mean price, in one row and one pass over the fact.

    With ``cells`` of ``sketches.daily_cells`` the counts are estimates and only the cells are read.
    Grouping sets reduce the fact to one row per artist key, one per venue key and a
    total before anything is shuffled. The names of both dimensions are joined as one
    table of (kind, key), so that no join key is NULL for half of the rows.
    """
    if cells is not None:
        return sketches.merged(cells).select(*sketches.estimates("events", "artists", "venues"), _mean_price().alias("avg_price"))
    artist, venue = star.artists, star.venues
    level = F.grouping_id()
    # names are told apart only, so no dimension is joined row by row: all of them weigh the rows
    fact, weight = star.weighted()
    measures = [m for m, name in zip(star.measures(weight), MEASURES) if name != "event_rows"]
    cells = fact.groupingSets([[artist.key], [venue.key], []], artist.key, venue.key).agg(
        F.when(level == 1, "artist").when(level == 2, "venue").otherwise("total").alias("kind"),
        *measures,
    )
    cells = cells.withColumn("key", F.coalesce(F.col(artist.key).cast("string"), F.col(venue.key).cast("string")))
    names = artist.frame.select(
        F.lit("artist").alias("kind"), F.col(artist.key).cast("string").alias("key"), F.col("artist_name").alias("name")
    ).unionByName(
        venue.frame.select(
            F.lit("venue").alias("kind"), F.col(venue.key).cast("string").alias("key"), F.col("venue_name").alias("name")
        )
    )
    cells = attach(cells, names, {"kind": "kind", "key": "key"}, ["name"])
    kind = F.col("kind")
    kpis = cells.agg(
        F.max(F.when(kind == "total", F.col("events"))).alias("events"),
        F.count_distinct(F.when(kind == "artist", F.col("name"))).alias("artists"),
        F.count_distinct(F.when(kind == "venue", F.col("name"))).alias("venues"),
        F.max(F.when(kind == "total", F.col("price_sum"))).alias("price_sum"),
        F.max(F.when(kind == "total", F.col("price_n"))).alias("price_n"),
    )
    if star.unique_events:
        return kpis.select("events", "artists", "venues", _mean_price().alias("avg_price"))
    events = star.fact.agg(star.events_counted().alias("n")).scalar()
    return kpis.select(events.alias("events"), "artists", "venues", _mean_price().alias("avg_price"))


def top_by(star: Star, attribute: str, k: int = 10) -> DataFrame:
    """The k values of an attribute with most events, fewest first as the bars are drawn."""
    counts = star.rollup(attribute).select(attribute, F.col("event_rows").alias("events"))
    return top_k(counts, "events", k, [attribute], ascending=True)


def demand_leaderboard(
    star: Star, listeners: DataFrame, market: DataFrame, k: int = 20
) -> DataFrame:
    """Audience, ticket-market signals and event counts side by side, largest audience first."""
    counts = star.rollup("artist_name").select("artist_name", F.col("events").alias("tm_events"))
    signals = outer_by_name(listeners, market, "artist_name")
    demand = outer_by_name(signals, counts, "artist_name").fillna(0, ["tm_events"])
    demand = demand.select("artist_name", "monthly_listeners", "sg_score", "sg_popularity", "tm_events")
    return top_k(demand, "monthly_listeners", k, ["artist_name", "sg_score", "sg_popularity", "tm_events"])


def demand_leaderboard_text(demand: DataFrame) -> DataFrame:
    return demand.select(
        "artist_name",
        text.thousands("monthly_listeners").alias("spotify_listeners"),
        text.two_decimals("sg_score").alias("seatgeek_score"),
        text.positive_thousands("sg_popularity").alias("seatgeek_popularity"),
        "tm_events",
    )


# Prices and revenue -----------------------------------------------------------------------


def tour_ranking(tours: DataFrame) -> DataFrame:
    """Tours by gross revenue, smallest first as the bars are drawn."""
    return tours.orderBy(F.col("gross_revenue").asc_nulls_last(), "artist_name", "tour_name", "tour_year")


def revenue_comparison(tours: DataFrame, listeners: DataFrame) -> DataFrame:
    """Tour gross against estimated streaming revenue, for artists with both; exact names."""
    both = tours.join(listeners, "artist_name")
    compared = both.withColumn("est_annual_streaming", streaming_estimate("monthly_listeners"))
    return compared.select(
        "artist_name",
        "tour_name",
        "tour_year",
        "monthly_listeners",
        "tickets_sold",
        conversion_rate("tickets_sold", "monthly_listeners").alias("conversion_rate"),
        "gross_revenue",
        "est_annual_streaming",
        revenue_multiplier("gross_revenue", "est_annual_streaming").alias("revenue_multiplier"),
    )


def conversion_table(compared: DataFrame) -> DataFrame:
    """The comparison by multiplier, largest first."""
    return compared.orderBy(F.col("revenue_multiplier").desc_nulls_last(), "artist_name", "tour_name", "tour_year")


def conversion_kpis(compared: DataFrame) -> DataFrame:
    """Artist with the largest multiplier, mean conversion rate and total gap, in one row."""
    return compared.agg(
        best("artist_name", "revenue_multiplier", "artist_name").alias("top_artist"),
        F.max("revenue_multiplier").alias("top_multiplier"),
        mean(F.col("conversion_rate").cast("decimal(18,1)")).alias("avg_conversion_rate"),
        (F.sum(F.col("gross_revenue").cast("decimal(28,2)")) - F.sum(F.col("est_annual_streaming").cast("decimal(28,2)")))
        .cast("double").alias("total_gap"),
    )


def conversion_text(compared: DataFrame) -> DataFrame:
    return compared.select(
        "artist_name",
        "tour_name",
        "tour_year",
        text.thousands("monthly_listeners").alias("monthly_listeners"),
        text.thousands("tickets_sold").alias("tickets_sold"),
        text.percent("conversion_rate").alias("conversion_rate"),
        text.millions("gross_revenue").alias("tour_gross"),
        text.millions("est_annual_streaming").alias("est_streaming_revenue"),
        text.times("revenue_multiplier").alias("revenue_multiplier"),
    )


def price_by_genre(star: Star) -> DataFrame:
    """Mean positive price per genre, lowest first; genres without prices are left out."""
    prices = star.rollup("genre").where(F.col("price_n") > 0)
    return prices.select("genre", _mean_price().alias("avg_price")).orderBy("avg_price", "genre")


def price_distribution(events: DataFrame, bins: int = 20) -> DataFrame:
    """Histogram of positive prices over events (the fact, or the star's frame)."""
    return histogram(priced_rows(events), "price_avg", bins).orderBy("bin")


# Artists ----------------------------------------------------------------------------------


def known_artists(star: Star, listeners: DataFrame) -> DataFrame:
    """Names with events or with an audience, sorted."""
    return union_distinct(known(star.seen(star.artists), "artist_name"), listeners, "artist_name")


def _first_by_lower_name(df: DataFrame, *cols: str) -> DataFrame:
    """One row per lower-cased name: the first in order of name and the given columns."""
    row = F.min_by(F.struct(*cols), F.struct("artist_name", *cols)).alias("row")
    return known(df, "artist_name").groupBy(F.lower("artist_name").alias("name_key")).agg(row).select("name_key", "row.*")


def artist_profiles(
    star: Star,
    listeners: DataFrame,
    market: DataFrame,
    tours: DataFrame,
    artist: str | None = None,
) -> DataFrame:
    """One row per known artist: genre, audience, score, events, mean price, tour and ratio.

    Events match the exact name, the other tables ignore case. The genre is the most
    frequent one of the events, else the market's, else a dash.
    """
    star = star.chosen("artist_name", artist)
    cells = selected(star.rollup("artist_name", "genre", keep_null=True), "artist_name", artist)
    by_use = F.when(F.col("genre").isNotNull(), F.struct(-F.col("event_rows"), F.col("genre")))
    stats = known(cells, "artist_name").groupBy("artist_name").agg(
        F.min_by("genre", by_use).alias("genre"),
        F.sum("events").alias("events"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("price_n").alias("price_n"),
    )
    if not star.unique_events:
        stats = stats.drop("events").join(star.distinct_events("artist_name"), "artist_name", "left")
    heard = selected(known(listeners, "artist_name"), "artist_name", artist).select("artist_name").distinct()
    audience = _first_by_lower_name(listeners, "monthly_listeners")
    signals = _first_by_lower_name(market, "sg_score", "sg_genres")
    tour_columns = ["tour_name", "tour_year", "gross_revenue", "tickets_sold", "avg_ticket_price", "shows"]
    tour = _first_by_lower_name(tours, *tour_columns)
    profile = (
        stats.join(heard, "artist_name", "full")
        .withColumn("name_key", F.lower("artist_name"))
        .join(audience, "name_key", "left")
        .join(signals, "name_key", "left")
        .join(tour, "name_key", "left")
    )
    ratio = revenue_ratio("gross_revenue", streaming_estimate("monthly_listeners"))
    idle = F.coalesce("events", F.lit(0)) == 0
    return profile.select(
        "artist_name",
        F.coalesce("genre", "sg_genres", F.lit(text.DASH)).alias("genre"),
        "monthly_listeners",
        "sg_score",
        F.coalesce("events", F.lit(0)).alias("events"),
        _mean_price().alias("avg_price"),
        *tour_columns,
        F.when(F.col("monthly_listeners") != 0, ratio).alias("revenue_ratio"),
        (idle & F.coalesce(F.col("monthly_listeners") != 0, F.lit(False))).alias("booking_opportunity"),
    )


def artist_events(star: Star, artist: str | None = None) -> DataFrame:
    """Events of an artist with venue and price text; all artists by default."""
    artists = selected(known(star.artists.frame, "artist_name"), "artist_name", artist)
    events = star.fact.join(artists.select(star.artists.key, "artist_name"), star.artists.key)
    venues = star.venues.frame.select(star.venues.key, "venue_name", "city", "state")
    return events.join(venues, star.venues.key, "left").select(
        "artist_name",
        "event_name",
        "venue_name",
        "city",
        "state",
        "event_date",
        text.dollars(F.col("price_avg").cast("double"), text.DYNAMIC).alias("avg_price"),
    )


def audience_and_events(star: Star, listeners: DataFrame) -> DataFrame:
    """Audience against number of events per artist, 0 for artists without events."""
    counts = star.rollup("artist_name").select("artist_name", F.col("events").alias("event_count"))
    return left_by_name_key(listeners, counts, "artist_name", ["event_count"]).fillna(0, ["event_count"])


def untapped_artists(star: Star, listeners: DataFrame, at_most_events: int = 1) -> DataFrame:
    """Artists with an audience but hardly any event, largest audience first."""
    few = at_most(audience_and_events(star, listeners), "event_count", at_most_events)
    flagged = few.withColumn("no_events", F.col("event_count") == 0)
    return flagged.orderBy(F.col("monthly_listeners").desc_nulls_last(), "artist_name", "event_count")


def frequent_artists(raw_events: DataFrame, n: int = 50) -> DataFrame:
    """Most frequent artist names over the raw snapshots."""
    return top_k(count_text_by(raw_events, "artist_name"), "events", n, ["artist_name"])


def artists_to_find(
    raw_events: DataFrame, curated: DataFrame, n: int | None = None, cut_first: bool = False
) -> DataFrame:
    """Artists of the events that the curated list lacks, with their number of snapshots.

    All of them, or the ``n`` most frequent; with ``cut_first`` those of the ``n`` most frequent
    of all artists that are not curated.
    """
    if cut_first and n is not None:
        return without_names(frequent_artists(raw_events, n), curated, "artist_name")
    found = without_names(count_text_by(raw_events, "artist_name"), curated, "artist_name")
    return found if n is None else top_k(found, "events", n, ["artist_name"])


# Venues and markets -----------------------------------------------------------------------


def hotspots(star: Star) -> DataFrame:
    """Events per geocoded city; the venue dimension carries the coordinates."""
    places = star.rollup("city", "state", "lat", "lon")
    return places.select("city", "state", "lat", "lon", "events")


def top_venues(star: Star, k: int = 15) -> DataFrame:
    """Venues with most events and their labels, fewest first as the bars are drawn."""
    counts = star.rollup("venue_name", "city", "state").select("venue_name", "city", "state", "events")
    top = top_k(counts, "events", k, ["venue_name", "city", "state"], ascending=True)
    return top.withColumn("label", venue_label("venue_name", "state"))


def market_kpis(star: Star, state: str | None = None, cells: DataFrame | None = None) -> DataFrame:
    """Events, venues, artists and mean price per state; from ``cells`` of ``sketches.daily_cells`` estimates."""
    if cells is not None:
        rows = sketches.merged(selected(known(cells, "state"), "state", state), "state")
        return rows.select("state", *sketches.estimates("events", "venues", "artists"), _mean_price().alias("avg_price"))
    whole, star = star.packed().fact, star.chosen("state", state).packed()
    if star.unique_events or not star.venues.few():
        cells = selected(known(star.cells("state", "venue_name", "artist_name"), "state"), "state", state)
        rest = cells.groupBy("state").agg(
            F.count_distinct("venue_name").alias("venues"),
            F.count_distinct("artist_name").alias("artists"),
            F.sum("price_sum").alias("price_sum"),
            F.sum("price_n").alias("price_n"),
            F.sum("events").alias("events"),
        )
    else:  # no pairs of artist and venue; totals keep only events of known states and need no choice of them
        totals = selected(replace(star, fact=whole).totals("state", "venue_name", "venues"), "state", state).drop("events")
        artists = selected(star.distinct_names("state", "artist_name", "artists"), "state", state)
        rest = totals.join(artists, "state")
    if not star.unique_events:
        events = selected(star.distinct_events("state"), "state", state)
        rest = rest.drop("events").join(events, "state")
    return rest.select("state", "events", "venues", "artists", _mean_price().alias("avg_price"))


def market_genres(star: Star, k: int = 8, state: str | None = None) -> DataFrame:
    """The k genres with most events per state."""
    counts = star.chosen("state", state).rollup("state", "genre").select("state", "genre", F.col("event_rows").alias("events"))
    order = [F.col("events").desc(), F.col("genre").asc()]
    return top_per_group(selected(counts, "state", state), ["state"], order, k)


def market_artists(
    star: Star, listeners: DataFrame, k: int = 10, state: str | None = None
) -> DataFrame:
    """The k artists with most events per state and their audience."""
    counts = star.chosen("state", state).rollup("state", "artist_name").select("state", "artist_name", "events")
    order = [F.col("events").desc(), F.col("artist_name").asc()]
    top = top_per_group(selected(counts, "state", state), ["state"], order, k)
    return top.join(listeners, "artist_name", "left").select("state", "artist_name", "events", "monthly_listeners")


def market_artists_text(market: DataFrame) -> DataFrame:
    return market.withColumn("spotify_listeners", text.positive_thousands("monthly_listeners")).drop("monthly_listeners")


# Calendar ---------------------------------------------------------------------------------


def by_weekday(star: Star) -> DataFrame:
    """Events per weekday, Monday first, Friday to Sunday labelled as weekend."""
    counts = star.rollup("day_name").select("day_name", F.col("event_rows").alias("events"))
    return by_ordinal(counts.withColumn("label", long_weekend_label("day_name")), "day_name", DAYS)


def by_month(star: Star) -> DataFrame:
    """Events per month over all years, January first."""
    counts = star.rollup("month_name").select("month_name", F.col("event_rows").alias("events"))
    return by_ordinal(counts, "month_name", MONTHS)


def genre_weekdays(star: Star, genre: str | None = None) -> DataFrame:
    """Events per weekday of a genre, or of every genre, with all seven days present."""
    counts = star.chosen("genre", genre).rollup("genre", "day_name").select("genre", "day_name", F.col("event_rows").alias("events"))
    if genre is None:
        return fill_days(counts, by=["genre"])
    return by_ordinal(fill_days(selected(counts, "genre", genre)), "day_name", DAYS)


def tours_of(tours: DataFrame, artist: str | None = None) -> DataFrame:
    """Tours of an artist, ignoring case."""
    return selected_name(tours, "artist_name", artist)
