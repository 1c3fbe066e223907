"""Reference rows held in code: city coordinates, verified tours, curated artists.

They are literals of this file, 68, 20 and 30 rows. Passed as Arrow tables they
become local relations whose exact size Spark knows, so it can broadcast them
without a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from encore import schemas

# Fixed values: (city, state, latitude, longitude), in lookup order.
CITY_COORDINATES = [
    ("New York", "NY", 40.7128, -74.0060),
    ("Los Angeles", "CA", 34.0522, -118.2437),
    ("Chicago", "IL", 41.8781, -87.6298),
    ("Houston", "TX", 29.7604, -95.3698),
    ("Phoenix", "AZ", 33.4484, -112.0740),
    ("Philadelphia", "PA", 39.9526, -75.1652),
    ("San Antonio", "TX", 29.4241, -98.4936),
    ("San Diego", "CA", 32.7157, -117.1611),
    ("Dallas", "TX", 32.7767, -96.7970),
    ("San Jose", "CA", 37.3382, -121.8863),
    ("Austin", "TX", 30.2672, -97.7431),
    ("Jacksonville", "FL", 30.3322, -81.6557),
    ("Fort Worth", "TX", 32.7555, -97.3308),
    ("Columbus", "OH", 39.9612, -82.9988),
    ("Charlotte", "NC", 35.2271, -80.8431),
    ("San Francisco", "CA", 37.7749, -122.4194),
    ("Indianapolis", "IN", 39.7684, -86.1581),
    ("Seattle", "WA", 47.6062, -122.3321),
    ("Denver", "CO", 39.7392, -104.9903),
    ("Washington", "DC", 38.9072, -77.0369),
    ("Nashville", "TN", 36.1627, -86.7816),
    ("Oklahoma City", "OK", 35.4676, -97.5164),
    ("El Paso", "TX", 31.7619, -106.4850),
    ("Boston", "MA", 42.3601, -71.0589),
    ("Portland", "OR", 45.5152, -122.6784),
    ("Las Vegas", "NV", 36.1699, -115.1398),
    ("Memphis", "TN", 35.1495, -90.0490),
    ("Louisville", "KY", 38.2527, -85.7585),
    ("Baltimore", "MD", 39.2904, -76.6122),
    ("Milwaukee", "WI", 43.0389, -87.9065),
    ("Albuquerque", "NM", 35.0844, -106.6504),
    ("Tucson", "AZ", 32.2226, -110.9747),
    ("Fresno", "CA", 36.7378, -119.7871),
    ("Sacramento", "CA", 38.5816, -121.4944),
    ("Atlanta", "GA", 33.7490, -84.3880),
    ("Kansas City", "MO", 39.0997, -94.5786),
    ("Omaha", "NE", 41.2565, -95.9345),
    ("Raleigh", "NC", 35.7796, -78.6382),
    ("Miami", "FL", 25.7617, -80.1918),
    ("Cleveland", "OH", 41.4993, -81.6944),
    ("Tulsa", "OK", 36.1540, -95.9928),
    ("Minneapolis", "MN", 44.9778, -93.2650),
    ("Tampa", "FL", 27.9506, -82.4572),
    ("New Orleans", "LA", 29.9511, -90.0715),
    ("Anaheim", "CA", 33.8366, -117.9143),
    ("Pittsburgh", "PA", 40.4406, -79.9959),
    ("Orlando", "FL", 28.5383, -81.3792),
    ("Detroit", "MI", 42.3314, -83.0458),
    ("Salt Lake City", "UT", 40.7608, -111.8910),
    ("Boise", "ID", 43.6150, -116.2023),
    ("Richmond", "VA", 37.5407, -77.4360),
    ("Knoxville", "TN", 35.9606, -83.9207),
    ("Inglewood", "CA", 33.9617, -118.3531),
    ("Noblesville", "IN", 40.0456, -86.0086),
    ("Bristow", "VA", 38.7232, -77.5389),
    ("Tinley Park", "IL", 41.5731, -87.7845),
    ("Maryland Heights", "MO", 38.7131, -90.4263),
    ("West Palm Beach", "FL", 26.7153, -80.0534),
    ("Burgettstown", "PA", 40.3823, -80.3923),
    ("Clarkston", "MI", 42.7356, -83.4188),
    ("Morrison", "CO", 39.6536, -105.1911),
    ("Rosemont", "IL", 41.9953, -87.8706),
    ("Wantagh", "NY", 40.6834, -73.5101),
    ("Camden", "NJ", 39.9259, -75.1196),
    ("Virginia Beach", "VA", 36.8529, -75.9780),
    ("Saratoga Springs", "NY", 43.0831, -73.7846),
    ("George", "WA", 47.0790, -119.8522),
    ("Mansfield", "MA", 42.0334, -71.2190),
]

# Fixed values: (artist, tour, gross, tickets, average ticket, shows, years, source).
TOURS = [
    ("Taylor Swift", "Eras Tour", 2200000000, 10060000, 219, 149, "2023-2024", "Pollstar"),
    ("Morgan Wallen", "One Night At A Time Tour", 260400000, 3100000, 212, 87, "2023-2024", "Billboard Boxscore"),
    ("Post Malone", "F-1 Trillion Tour", 63000000, 470000, 134, 25, "2024", "Billboard Boxscore"),
    ("Metallica", "M72 World Tour", 517500000, 4230000, 120, 70, "2023-2025", "Pollstar"),
    ("Bruno Mars", "Park MGM Residency", 197200000, 574000, 344, 110, "2022-2026", "Billboard Boxscore"),
    ("Ed Sheeran", "Mathematics Tour", 875700000, 8800000, 100, 188, "2022-2025", "Billboard Boxscore"),
    ("Olivia Rodrigo", "GUTS World Tour", 209100000, 1600000, 131, 101, "2024", "Billboard Boxscore"),
    ("Beyonce", "Renaissance World Tour", 579800000, 2800000, 207, 56, "2023", "Pollstar"),
    ("Dave Matthews Band", "Summer Tour 2023", 52000000, 1000000, 52, 45, "2023", "Pollstar"),
    ("Zach Bryan", "Quittin Time Tour", 379200000, 1920000, 198, 81, "2024", "Touring Data"),
    ("Foo Fighters", "Everything Or Nothing At All Tour", 103500000, 862523, 120, 31, "2024", "Pollstar"),
    ("Chris Stapleton", "All-American Road Show", 224300000, 2000000, 112, 333, "2017-2023", "Billboard"),
    ("Doja Cat", "The Scarlet Tour", 67200000, 383017, 175, 31, "2023-2024", "Billboard Boxscore"),
    ("Luke Combs", "Growin Up And Gettin Old Tour", 164900000, 1238820, 133, 25, "2024", "Touring Data"),
    ("Billie Eilish", "Hit Me Hard And Soft Tour", 190000000, 1200000, 152, 70, "2024-2025", "Pollstar"),
    ("Kendrick Lamar", "The Big Steppers Tour", 110900000, 929000, 119, 73, "2022-2023", "Touring Data"),
    ("Drake", "Its All A Blur Tour", 320500000, 1300000, 247, 80, "2023-2024", "Billboard Boxscore"),
    ("Bad Bunny", "Most Wanted Tour", 210900000, 753287, 280, 49, "2024", "Pollstar"),
    ("SZA", "SOS Tour", 95500000, 674000, 142, 50, "2023", "Billboard Boxscore"),
    ("Sabrina Carpenter", "Short N Sweet Tour", 126600000, 974467, 130, 72, "2024-2025", "Touring Data"),
]

# Fixed values: (artist, page URL).
CURATED_ARTISTS = [
    ("Taylor Swift", "https://open.spotify.com/artist/06HL4z0CvFAxyc27GXpf02"),
    ("Morgan Wallen", "https://open.spotify.com/artist/4oUHIQIBe0LHzYfvXNW4QM"),
    ("Drake", "https://open.spotify.com/artist/3TVXtAsR1Inumwj472S9r4"),
    ("Bad Bunny", "https://open.spotify.com/artist/4q3ewBCX7sLwd24euuV69X"),
    ("The Weeknd", "https://open.spotify.com/artist/1Xyo4u8uXC1ZmMpatF05PJ"),
    ("Billie Eilish", "https://open.spotify.com/artist/6qqNVTkY8uBg9cP3Jd7DAH"),
    ("Kendrick Lamar", "https://open.spotify.com/artist/2YZyLoL8N0Wb9xBt1NhZWg"),
    ("SZA", "https://open.spotify.com/artist/7tYKF4w9nC0nq9CsPZTHyP"),
    ("Olivia Rodrigo", "https://open.spotify.com/artist/1McMsnEElThX1knmY4oliG"),
    ("Zach Bryan", "https://open.spotify.com/artist/40ZNYROS4zLfyyBSs2PGe2"),
    ("Beyonce", "https://open.spotify.com/artist/6vWDO969PvNqNYHIOW5v0m"),
    ("Post Malone", "https://open.spotify.com/artist/246dkjvS1zLTtiykXe5h60"),
    ("Sabrina Carpenter", "https://open.spotify.com/artist/74KM79TiuVKeVCqs8QtB0B"),
    ("Chappell Roan", "https://open.spotify.com/artist/7GlBOeep6PqTfFi59PTUUN"),
    ("Tyler Childers", "https://open.spotify.com/artist/5K8mNMsW3wUZxJwCnuqqde"),
    ("Metallica", "https://open.spotify.com/artist/2ye2Wgw4gimLv2eAKyk1NB"),
    ("Dave Matthews Band", "https://open.spotify.com/artist/2TI7qyDE0QfyOlnbtfDo7L"),
    ("Chris Stapleton", "https://open.spotify.com/artist/4YLtL2PYDjzMIJSAiEHNKi"),
    ("Bruno Mars", "https://open.spotify.com/artist/0du5cEVh5yTK9QJze8zA0C"),
    ("Phish", "https://open.spotify.com/artist/4YPqbAiLCBM9cEsBMgMFya"),
    ("Doja Cat", "https://open.spotify.com/artist/5cj0lLjcoR7YOSnhnX0Po5"),
    ("Ed Sheeran", "https://open.spotify.com/artist/6eUKZXaKkcviH0Ku9w2n3V"),
    ("Foo Fighters", "https://open.spotify.com/artist/7jy3rLJdDQY21OgRLCZ9sD"),
    ("Luke Combs", "https://open.spotify.com/artist/718COspgdWOnwOFpJHRZHS"),
    ("Riley Green", "https://open.spotify.com/artist/1nBAxEKiJKb8Hu5MfBLjSH"),
    ("Luke Bryan", "https://open.spotify.com/artist/0BvkDsjIUla7X0k6CSWh1I"),
    ("Soulja Boy", "https://open.spotify.com/artist/7c4V3MRqsFKCmNqFHXVByj"),
    ("Boys Like Girls", "https://open.spotify.com/artist/68aMD6TLRYlRbi0HgkSUoX"),
    ("Sepultura", "https://open.spotify.com/artist/09kPFq6SHHPvaQnCjSCKtH"),
    ("Danny Brown", "https://open.spotify.com/artist/2fGfRomjBWPMV0lMeDp4mV"),
]


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows written out in code, as a table with a declared schema."""
    names = [field.split()[0] for field in schema.split(", ")]
    table = pa.table({name: list(values) for name, values in zip(names, zip(*rows))})
    wanted = [field.split() for field in schema.split(", ")]
    return spark.createDataFrame(table).select(*[F.col(n).cast(t).alias(n) for n, t in wanted])


def city_coordinates(spark: SparkSession) -> DataFrame:
    """Lookup of (ord, city, state, lat, lon); ``ord`` is the order of the list."""
    rows = [(i, *row) for i, row in enumerate(CITY_COORDINATES)]
    return literal_rows(spark, rows, schemas.PLACES)


def tours(spark: SparkSession) -> DataFrame:
    """Rows of raw_tour_revenue."""
    columns = (
        "artist_name STRING, tour_name STRING, gross_revenue DECIMAL(38,0), tickets_sold DECIMAL(38,0), "
        "avg_ticket_price DECIMAL(38,0), shows DECIMAL(38,0), tour_year STRING, source STRING"
    )
    return literal_rows(spark, TOURS, columns).withColumn("loaded_at", F.current_timestamp())


def curated_artists(spark: SparkSession) -> DataFrame:
    """Artists whose pages are always read."""
    return literal_rows(spark, CURATED_ARTISTS, schemas.CURATED_ARTISTS)
