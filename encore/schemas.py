"""Declared schemas, as DDL text. Nothing is inferred: optional parts of landed JSON
would vanish from an inferred schema, and inference costs a pass over the data."""

# Landed JSON documents, one per line.
EVENT_DOC = """
  id STRING, name STRING, url STRING,
  dates STRUCT<start: STRUCT<localDate: STRING, localTime: STRING>, status: STRUCT<code: STRING>>,
  _embedded STRUCT<
    venues: ARRAY<STRUCT<id: STRING, name: STRING, city: STRUCT<name: STRING>, state: STRUCT<stateCode: STRING>>>,
    attractions: ARRAY<STRUCT<id: STRING, name: STRING>>>,
  priceRanges ARRAY<STRUCT<min: DOUBLE, max: DOUBLE, currency: STRING>>,
  classifications ARRAY<STRUCT<genre: STRUCT<name: STRING>>>
"""

PERFORMER_DOC = """
  id BIGINT, name STRING, short_name STRING, url STRING, score DOUBLE, popularity DOUBLE,
  num_upcoming_events BIGINT, genres ARRAY<STRUCT<name: STRING>>, type STRING
"""

LISTING_DOC = """
  id BIGINT, title STRING, url STRING, datetime_local STRING, type STRING,
  performers ARRAY<STRUCT<id: BIGINT, name: STRING, primary: BOOLEAN>>,
  venue STRUCT<id: BIGINT, name: STRING, city: STRING, state: STRING>,
  stats STRUCT<lowest_price: DOUBLE, average_price: DOUBLE, highest_price: DOUBLE, listing_count: BIGINT>,
  popularity DOUBLE, score DOUBLE
"""

PAGE_DOC = """
  artist_name STRING, url STRING, title STRING, markdown STRING, metadata MAP<STRING, STRING>
"""

# Raw tables: append-only snapshots stamped with loaded_at, and the tour reference table.
RAW_TABLES = {
    "raw_ticketmaster_events": """
      event_id STRING, event_name STRING, event_url STRING, event_date STRING, event_time STRING,
      sale_status STRING, artist_name STRING, artist_id STRING, venue_name STRING, venue_id STRING,
      city STRING, state STRING, price_min DOUBLE, price_max DOUBLE, currency STRING, genre STRING,
      loaded_at TIMESTAMP
    """,
    "raw_spotify_artists": """
      artist_id STRING, artist_name STRING, spotify_url STRING, monthly_listeners BIGINT,
      page_title STRING, page_description STRING, raw_markdown STRING, raw_metadata STRING,
      loaded_at TIMESTAMP
    """,
    "raw_seatgeek_performers": """
      performer_id STRING, performer_name STRING, short_name STRING, seatgeek_url STRING,
      sg_score DOUBLE, sg_popularity DOUBLE, upcoming_events BIGINT, genres STRING,
      performer_type STRING, loaded_at TIMESTAMP
    """,
    "raw_seatgeek_events": """
      event_id STRING, event_title STRING, event_url STRING, event_date STRING, event_time STRING,
      event_type STRING, performer_name STRING, performer_id STRING, venue_name STRING,
      venue_id STRING, city STRING, state STRING, lowest_price DOUBLE, average_price DOUBLE,
      highest_price DOUBLE, listing_count BIGINT, event_popularity DOUBLE, event_score DOUBLE,
      loaded_at TIMESTAMP
    """,
    "raw_tour_revenue": """
      artist_name STRING, tour_name STRING, gross_revenue DECIMAL(38,0), tickets_sold DECIMAL(38,0),
      avg_ticket_price DECIMAL(38,0), shows DECIMAL(38,0), tour_year STRING, source STRING,
      loaded_at TIMESTAMP
    """,
}

PLACES = "ord INT, city STRING, state STRING, lat DOUBLE, lon DOUBLE"
CURATED_ARTISTS = "artist_name STRING, spotify_url STRING"
