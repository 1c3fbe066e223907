"""Coordinates of (city, state) pairs, as equi-joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from encore.functions.text import strip


def exact_places(places: DataFrame) -> DataFrame:
    """One row per (city, state) of the lookup table: the first one listed."""
    return places.groupBy(F.col("city").alias("__city"), F.col("state").alias("__state")).agg(
        F.min_by("lat", "ord").alias("__lat"), F.min_by("lon", "ord").alias("__lon")
    )


def part_index(places: DataFrame) -> DataFrame:
    """Every part of every lower-cased place name -> the first listed place containing it.

    "The city is contained in a place name of the same state" becomes an equality
    on (part, state). A name of n letters has at most n(n+1)/2 parts, so the index
    grows with the lookup table and not with the cities looked up, and no city is
    compared with all places of its state. The empty text is a part of every name.
    """
    size = F.length("__name")
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size),
            lambda start: F.transform(
                F.sequence(F.lit(1), size - start + 1),
                lambda n: F.substring(F.col("__name"), start, n),
            ),
        )
    )
    named = places.withColumn("__name", F.lower("city"))
    every = F.array_distinct(
        F.when(size > 0, F.concat(F.array(F.lit("")), parts)).otherwise(F.array(F.lit("")))
    )
    return (
        named.select(F.explode(every).alias("__part"), F.col("state").alias("__part_state"), "lat", "lon", "ord")
        .groupBy("__part", "__part_state")
        .agg(F.min_by("lat", "ord").alias("__part_lat"), F.min_by("lon", "ord").alias("__part_lon"))
    )


def geocode(df: DataFrame, places: DataFrame, city: str = "city", state: str = "state") -> DataFrame:
    """Add ``lat`` and ``lon``: exact (city, state) first, else the first place containing the city.

    Call it on a dimension or on distinct pairs, not on events. ``places`` has
    (ord, city, state, lat, lon). A NULL city or state gives NULL coordinates.
    """
    keyed = df.withColumn("__c", strip(city)).withColumn("__s", strip(state))
    exact, parts = exact_places(places), part_index(places)
    keyed = keyed.join(exact, (F.col("__c") == F.col("__city")) & (F.col("__s") == F.col("__state")), "left")
    keyed = keyed.join(
        parts,
        (F.lower("__c") == F.col("__part")) & (F.col("__s") == F.col("__part_state")),
        "left",
    )
    return keyed.select(
        *[F.col(c) for c in df.columns],
        F.coalesce("__lat", "__part_lat").alias("lat"),
        F.coalesce("__lon", "__part_lon").alias("lon"),
    )
