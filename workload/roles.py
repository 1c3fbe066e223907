"""Role mapping: which given table plays which table of the event schema.

Snapshots of events are lines of orders (several lines share order and line number),
artists are customers, venues are suppliers in nations and regions, audience and
ticket-market signals are user events, tours are the orders of a customer and year.
Names get stray spaces, punctuation and lower case, and some values become NULL, so
that the cleaning steps have something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from encore.functions import calendar
from encore.functions.money import midpoint
from encore.functions.text import clean_name
from encore.operators.latest import latest_per_key
from encore.operators.lookup import geocode
from encore.plans import marts, reports, staging
from encore.plans.star import Dimension, Star
from encore.schemas import PLACES
from encore.sources.reference import literal_rows

from .tables import Tables

# Coordinates lookup: exact cities, cities found only as part of a name, doubled and missing ones.
PLACE_ROWS = [
    (0, "Nation_0", "AFRICA", 10.5, -1.25),
    (1, "Nation_11 Harbour", "AMERICA", 11.5, -2.25),
    (2, "Nation_10", "AFRICA", 12.5, -3.25),
    (3, "Old Nation_12", "ASIA", 13.5, -4.25),
    (4, "Nation_12", "ASIA", 14.5, -5.25),
    (5, "nation_2 West", "ASIA", 15.5, -6.25),
    (6, "Nation_23", "EUROPE", 16.5, -7.25),
    (7, "Nation_3", "ASIA", 17.5, -8.25),
    (8, "Greater NATION_4", "MIDDLE EAST", 18.5, -9.25),
    (9, "Nation_24", "MIDDLE EAST", 19.5, -10.25),
]

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_partkey", "l_suppkey"]  # unique within order, line and ship date
RAW_TIES = {
    "raw_ticketmaster_events": ["event_name", "venue_name", "price_max", "venue_id", "price_min", "event_date"],
    "raw_spotify_artists": ["artist_id", "monthly_listeners"],
    "raw_seatgeek_performers": ["performer_id", "sg_score"],
    "raw_seatgeek_events": ["event_url", "performer_name", "venue_name", "highest_price", "listing_count"],
}


def places(t: Tables) -> DataFrame:
    return literal_rows(t.spark, PLACE_ROWS, PLACES)


def _known_price(value: Column) -> Column:
    """No price for lines flagged N, price zero for the highest discount."""
    return F.when(F.col("l_returnflag") != "N", F.when(F.col("l_discount") == 0.1, F.lit(0)).otherwise(value))


def high_price() -> Column:
    """The list price, missing for untaxed lines: only one of the two prices is known then."""
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    return F.when(F.col("l_tax") != 0, _known_price(price)).cast("decimal(10,2)")


def low_price() -> Column:
    """The discounted price, whole cents."""
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return _known_price(price).cast("decimal(10,2)")


def artist_id() -> Column:
    return F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey"))


def venue_id() -> Column:
    return F.when(F.col("l_quantity") < 50, F.col("l_suppkey"))


def event_date() -> Column:
    return F.when(F.col("l_tax") != 0.08, F.col("l_shipdate").cast("date"))


def messy_artist() -> Column:
    return F.concat(F.lit(" "), F.replace(F.lower("c_name"), F.lit("#"), F.lit("-no.")))


# Raw tables -------------------------------------------------------------------------------


def with_places(lines: DataFrame, suppliers: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Lines with supplier, nation and region, joined one by one: Spark knows the sizes of these tables, while it takes a join of
    them for the product of their sizes and would shuffle the lines."""
    lines = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    lines = lines.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return lines.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")


def with_messy_venues(lines: DataFrame, t: Tables) -> DataFrame:
    """Lines with venue texts, spelled per venue, city and state and not per event."""
    return with_places(
        lines,
        t.supplier.select("s_suppkey", "s_nationkey", F.lower("s_name").alias("venue_name")),
        t.nation.select("n_nationkey", "n_regionkey", F.lower("n_name").alias("city")),
        t.region.select("r_regionkey", F.concat(F.lower("r_name"), F.lit(" ")).alias("state")),
    )


def messy_artists(t: Tables) -> DataFrame:
    """Artist texts, spelled per artist and not per event."""
    return t.customer.select(
        "c_custkey",
        messy_artist().alias("artist_name"),
        F.concat(F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")), F.lit(" ")).alias("genre"),
    )


def places_of_lines(t: Tables) -> DataFrame:
    return with_places(t.lineitem, t.supplier, t.nation, t.region)


def raw_artist_names(t: Tables) -> DataFrame:
    """The artist column of the raw events alone: no venue is joined for it."""
    owners = t.orders.select("o_orderkey", artist_id().alias("artist_id")).where(F.col("artist_id").isNotNull())
    names = t.customer.select("c_custkey", messy_artist().alias("artist_name"))
    lines = t.lineitem.select("l_orderkey").join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.join(names, F.col("artist_id") == F.col("c_custkey"), "left").select("artist_name")


def raw_events(t: Tables) -> DataFrame:
    owners = t.orders.select("o_orderkey", F.lower("o_orderstatus").alias("status"), artist_id().alias("artist_id"))
    owners = owners.join(messy_artists(t), F.col("artist_id") == F.col("c_custkey"), "left")
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", venue_id().isNotNull().alias("has_venue"), event_date().isNotNull().alias("has_date"),
        low_price().alias("low"), high_price().alias("high"), "l_shipdate")  # what is shuffled to the orders
    lines = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return with_messy_venues(lines, t).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.concat(F.lit(" show "), F.lpad(F.col("l_partkey").cast("string"), 12, "0"), F.lit(" ")).alias("event_name"),
        F.concat(F.lit("https://events.example.com/"), "l_orderkey", F.lit("/"), "l_linenumber", F.lit(" ")).alias("event_url"),
        F.when(F.col("has_date"), F.col("l_shipdate").cast("date")).cast("string").alias("event_date"),
        F.concat(F.lpad((F.col("l_linenumber") + 12).cast("string"), 2, "0"), F.lit(":30:00")).alias("event_time"),
        F.concat(F.lit(" "), "status").alias("sale_status"),
        "artist_name",
        F.col("artist_id").cast("string").alias("artist_id"),
        "venue_name",
        F.when(F.col("has_venue"), F.col("l_suppkey")).cast("string").alias("venue_id"),
        "city",
        "state",
        F.col("low").cast("double").alias("price_min"),
        F.col("high").cast("double").alias("price_max"),
        F.lit("usd ").alias("currency"),
        "genre",
        F.col("l_shipdate").cast("timestamp").alias("loaded_at"),
    )


def raw_listeners(t: Tables) -> DataFrame:
    """Every view is one reading of an audience; a few readings spell the name in capitals."""
    views = t.events.where(F.col("event_type") == "view")
    views = views.join(t.customer, F.col("user_id") == F.col("c_custkey"), "left")
    capitals = F.col("props") == '{"k": 0}'
    return views.select(
        F.col("user_id").cast("string").alias("artist_id"),
        F.when(capitals, F.upper(messy_artist())).otherwise(messy_artist()).alias("artist_name"),
        F.concat(F.lit("https://audience.example.com/artist/"), "user_id", F.lit(" ")).alias("spotify_url"),
        F.when(F.col("value") >= 1, F.floor(F.col("value") * 1000)).alias("monthly_listeners"),
        F.concat(F.lit(" page of "), "c_name").alias("page_title"),
        F.concat("event_type", F.lit(" ")).alias("page_description"),
        F.lit(None).cast("string").alias("raw_markdown"),
        F.col("props").alias("raw_metadata"),
        F.col("ts").cast("timestamp").alias("loaded_at"),
    )


def raw_performers(t: Tables) -> DataFrame:
    """Every purchase is one reading of the ticket market."""
    bought = t.events.where(F.col("event_type") == "purchase")
    bought = bought.join(t.customer, F.col("user_id") == F.col("c_custkey"), "left")
    return bought.select(
        F.col("user_id").cast("string").alias("performer_id"),
        messy_artist().alias("performer_name"),
        F.concat(F.lit(" "), "c_name").alias("short_name"),
        F.concat(F.lit("https://tickets.example.com/"), "user_id").alias("seatgeek_url"),
        F.least(F.lit(1.0), F.col("value") / 60).alias("sg_score"),
        F.floor(F.col("value") * 10).cast("double").alias("sg_popularity"),
        F.floor("value").alias("upcoming_events"),
        F.concat(F.lower("c_mktsegment"), F.lit(", live ")).alias("genres"),
        F.lit("band ").alias("performer_type"),
        F.col("ts").cast("timestamp").alias("loaded_at"),
    )


def raw_listings(t: Tables) -> DataFrame:
    """Lines of an order are the readings of one listing."""
    return with_messy_venues(t.lineitem, t).select(
        F.col("l_orderkey").cast("string").alias("event_id"),
        F.concat(F.lit(" listing "), "l_orderkey").alias("event_title"),
        F.concat(F.lit("https://tickets.example.com/e/"), "l_linenumber").alias("event_url"),
        event_date().cast("string").alias("event_date"),
        F.concat(F.lpad((F.col("l_linenumber") + 12).cast("string"), 2, "0"), F.lit(":30:00")).alias("event_time"),
        F.lit(" concert").alias("event_type"),
        F.concat(F.lit("act/no-"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")).alias("performer_name"),
        F.col("l_partkey").cast("string").alias("performer_id"),
        "venue_name",
        F.col("l_suppkey").cast("string").alias("venue_id"),
        "city",
        "state",
        low_price().cast("double").alias("lowest_price"),
        midpoint(low_price(), high_price()).cast("double").alias("average_price"),
        high_price().cast("double").alias("highest_price"),
        F.col("l_quantity").cast("bigint").alias("listing_count"),
        F.col("l_discount").alias("event_popularity"),
        F.col("l_tax").alias("event_score"),
        F.col("l_shipdate").cast("timestamp").alias("loaded_at"),
    )


def raw_tours(t: Tables) -> DataFrame:
    """The orders of an artist and year are one tour."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    sums = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.sum(price).alias("gross"), F.count(F.lit(1)).alias("n"), F.max(price).alias("top"), F.max("o_orderdate").alias("last")
    )
    named = sums.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return named.select(
        messy_artist().alias("artist_name"),
        F.concat(F.lit(" tour "), "y").alias("tour_name"),
        F.col("gross").alias("gross_revenue"),
        (F.col("n") * 1000).alias("tickets_sold"),
        F.col("top").alias("avg_ticket_price"),
        F.col("n").alias("shows"),
        F.col("y").cast("string").alias("tour_year"),
        F.lit(" Orders desk ").alias("source"),
        F.col("last").cast("timestamp").alias("loaded_at"),
    )


def raw(t: Tables) -> dict[str, DataFrame]:
    return {
        "raw_ticketmaster_events": raw_events(t),
        "raw_spotify_artists": raw_listeners(t),
        "raw_seatgeek_performers": raw_performers(t),
        "raw_seatgeek_events": raw_listings(t),
        "raw_tour_revenue": raw_tours(t),
    }


# Staging and marts ------------------------------------------------------------------------


def stg_events(t: Tables) -> DataFrame:
    return staging.stg_ticketmaster_events(raw_events(t), RAW_TIES["raw_ticketmaster_events"])


def stg_listeners(t: Tables) -> DataFrame:
    return staging.stg_spotify_artists(raw_listeners(t), RAW_TIES["raw_spotify_artists"])


def stg_performers(t: Tables) -> DataFrame:
    return staging.stg_seatgeek_performers(raw_performers(t), RAW_TIES["raw_seatgeek_performers"])


def stg_listings(t: Tables) -> DataFrame:
    return staging.stg_seatgeek_events(raw_listings(t), RAW_TIES["raw_seatgeek_events"])


def stg_tours(t: Tables) -> DataFrame:
    return staging.stg_tour_revenue(raw_tours(t))


def listeners(t: Tables) -> DataFrame:
    return reports.listeners_view(stg_listeners(t))


def market(t: Tables) -> DataFrame:
    return reports.market_view(stg_performers(t))


def tours(t: Tables) -> DataFrame:
    return reports.tours_view(stg_tours(t))


# The star of the reports ------------------------------------------------------------------


def latest_lines(t: Tables) -> DataFrame:
    """The latest snapshot of every event, by its natural key."""
    return latest_per_key(t.lineitem, LINE_KEYS, "l_shipdate", LINE_TIES)


def artists(t: Tables) -> DataFrame:
    """Artists under their natural key: 8 bytes in joins where a hash text takes 32."""
    return t.customer.select(
        F.col("c_custkey").alias("artist_key"),
        F.replace("c_name", F.lit("#"), F.lit("-No.")).alias("artist_name"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("genre"),
    )


def venues(t: Tables) -> DataFrame:
    located = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    located = located.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return located.select(
        F.col("s_suppkey").alias("venue_key"),
        F.col("s_name").alias("venue_name"),
        clean_name("n_name").alias("city"),
        F.col("r_name").alias("state"),
    )


def dates(t: Tables) -> DataFrame:
    return marts.dim_dates(t.lineitem.select(F.col("l_shipdate").cast("date").alias("event_date")))


def star(t: Tables, with_artists: bool = True, with_places: bool = False) -> Star:
    """The star over the given tables, by natural keys.

    Orders are joined for the artist only where a report asks for artists; coordinates
    are looked up only where it asks for them.
    """
    lines = latest_lines(t)
    if with_artists:
        owners = t.orders.select("o_orderkey", artist_id().alias("artist_key"))
        lines = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    fact = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.concat(F.lit("show "), "l_partkey").alias("event_name"),
        *(["artist_key"] if with_artists else []),
        venue_id().alias("venue_key"),
        event_date().alias("event_date"),
        low_price().alias("price_min"),
        high_price().alias("price_max"),
        midpoint(low_price(), high_price()).alias("price_avg"),
    )
    halls = geocode(venues(t), places(t)) if with_places else venues(t)
    return Star(
        fact,
        Dimension(artists(t), "artist_key"),
        Dimension(halls, "venue_key"),
        Dimension(dates(t), "event_date", {
            "day_name": calendar.day_name("event_date"), "month_name": calendar.month_name("event_date")}),
        unique_events=True,
    )


def events_frame(t: Tables) -> DataFrame:
    """Events with artist and venue attributes, row by row, for the single operators."""
    s = star(t)
    wide = s.fact.join(s.artists.frame, "artist_key", "left").join(s.venues.frame, "venue_key", "left")
    return wide.withColumn("price_avg", F.col("price_avg").cast("double"))
