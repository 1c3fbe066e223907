from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from encore import schemas
from encore.functions.keys import surrogate_key
from encore.operators import joins
from encore.plans import marts, staging
from encore.sources.tables import materialise

NOW = datetime.datetime(2024, 1, 1)


def raw_events(spark, *rows):
    """Rows given as dicts; everything else is NULL."""
    schema = schemas.RAW_TABLES["raw_ticketmaster_events"]
    names = spark.createDataFrame([], schema).columns
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def test_cleaning_and_casts(spark):
    raw = raw_events(spark, {
        "event_id": "e", "event_name": " Show ", "sale_status": " onsale", "artist_name": "the foo-bar band", "venue_name": "red rocks/west ",
        "city": "st. paul", "state": " mn ", "event_date": "2024-05-01", "price_min": 2.345, "price_max": 2.675, "currency": "usd", "loaded_at": NOW,
    })
    r = staging.stg_ticketmaster_events(raw).collect()[0]
    assert (r.event_name, r.sale_status, r.artist_name, r.venue_name) == ("Show", "ONSALE", "The Foo-Bar Band", "Red Rocks/West")
    assert (r.city, r.state, r.currency, r.event_date) == ("St. Paul", "MN", "USD", datetime.date(2024, 5, 1))
    assert (r.price_min, r.price_max) == (Decimal("2.35"), Decimal("2.68"))
    spaces = staging.stg_ticketmaster_events(raw, breaks=" ").collect()[0]
    assert spaces.artist_name == "The Foo-bar Band"


def test_bad_values_fail_or_become_null(spark):
    raw = raw_events(spark, {"event_id": "e", "event_date": "soon", "price_min": 1e12, "loaded_at": NOW})
    with pytest.raises(PySparkException):
        staging.stg_ticketmaster_events(raw).collect()
    r = staging.stg_ticketmaster_events(raw, lenient=True).collect()[0]
    assert (r.event_date, r.price_min) == (None, None)


def test_null_keys_keep_one_row(spark):
    raw = raw_events(spark, {"event_name": "a", "loaded_at": NOW}, {"event_name": "b", "loaded_at": NOW}, {"event_id": "e", "loaded_at": NOW})
    assert staging.stg_ticketmaster_events(raw).count() == 2


def test_performers_are_filtered_by_their_latest_score(spark):
    rows = [("1", "p", None, None, 0.9, 1.0, 1, None, None, NOW), ("1", "p", None, None, 0.4, 1.0, 1, None, None, NOW + datetime.timedelta(1)),
            ("2", "q", None, None, 0.5, 1.0, 1, None, None, NOW), ("3", "r", None, None, 0.6, 1.0, 1, " a, b ", None, NOW)]
    raw = spark.createDataFrame(rows, schemas.RAW_TABLES["raw_seatgeek_performers"])
    assert [(r.performer_name, r.genres) for r in staging.stg_seatgeek_performers(raw).collect()] == [("R", "a, b")]


def test_tours_round_half_away_and_are_not_deduplicated(spark):
    schema = schemas.RAW_TABLES["raw_tour_revenue"].replace("DECIMAL(38,0)", "DOUBLE")
    raw = spark.createDataFrame([("sza", " t ", 10.5, 1.0, 1.0, 2.0, "2024", "d", NOW)] * 2, schema)
    got = staging.stg_tour_revenue(raw).collect()
    assert len(got) == 2 and got[0].gross_revenue == 11 and got[0].artist_name == "Sza"


def test_events_without_artist_venue_or_date_stay_in_the_fact(spark):
    events = staging.stg_ticketmaster_events(raw_events(
        spark,
        {"event_id": "e1", "artist_id": "a", "artist_name": "x", "venue_id": "v", "venue_name": "h", "event_date": "2024-01-06", "price_min": 10.0, "loaded_at": NOW},
        {"event_id": "e2", "loaded_at": NOW}, {"event_id": "e3", "artist_id": "b", "loaded_at": NOW},
    ))
    listeners = staging.stg_spotify_artists(spark.createDataFrame(
        [("s1", "X", None, 5, None, None, None, None, NOW), ("s2", "x ", None, 6, None, None, None, None, NOW)], schemas.RAW_TABLES["raw_spotify_artists"]))
    performers = staging.stg_seatgeek_performers(spark.createDataFrame([], schemas.RAW_TABLES["raw_seatgeek_performers"]))
    artists, venues, dates = marts.dim_artists(events, listeners, performers), marts.dim_venues(events), marts.dim_dates(events)
    assert sorted(r.monthly_listeners for r in artists.collect()) == [5, 6]
    assert marts.dim_artists(events, listeners, performers, strict=True).count() == 1
    fact = {r.event_id: r for r in marts.fact_events(events, artists.limit(1), venues, dates).collect()}
    assert set(fact) == {"e1", "e2", "e3"}
    assert fact["e1"].artist_key and fact["e1"].venue_key and fact["e1"].date_key and fact["e1"].price_avg is None
    assert (fact["e2"].artist_key, fact["e2"].venue_key, fact["e2"].date_key) == (None, None, None)
    assert fact["e3"].artist_key is None
    d = dates.collect()[0]
    assert (d.day_of_week, d.day_name, d.month_name, d.quarter, d.is_weekend) == (6, "Saturday", "Jan", 1, True)


def test_fact_is_not_shuffled_for_its_keys(spark, tmp_path):
    """Only ids that a dimension lacks or repeats are joined, whatever the size of the dimension."""
    events = staging.stg_ticketmaster_events(raw_events(spark, *[
        {"event_id": f"e{i}", "artist_id": f"a{i % 3}", "artist_name": "x", "venue_id": "v", "venue_name": "h", "loaded_at": NOW} for i in range(9)]))
    events, spelled = materialise(events, str(tmp_path / "events")), ["venue_key", "venue_id", "venue_name"]
    artists = spark.createDataFrame([(f"key{i}", f"a{i}") for i in (0, 1)], "artist_key STRING, tm_artist_id STRING")
    venues = spark.createDataFrame([("kv", "v", "h"), ("kv", "v", "H")], spelled)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = marts.fact_events(events, artists, venues, marts.dim_dates(events), lambda df, name: materialise(df, str(tmp_path / name)))
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(artist_id" not in plan and "hashpartitioning(venue_id" not in plan
    assert fact.where("artist_key IS NULL").count() == 2 * 3 and fact.count() == 2 * 9
    assert fact.select("venue_key").distinct().count() == 1


@pytest.mark.parametrize("most", [joins.EXCEPTIONS, 2])
def test_keys_made_from_ids_are_those_of_the_join(spark, rows, monkeypatch, most):
    monkeypatch.setattr(joins, "EXCEPTIONS", most)
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, None), (6, "d"), (7, "")], "n INT, id STRING")
    dim = spark.createDataFrame([("a",), ("b",), ("b",), ("d",), ("d",), ("d",), (None,), ("unused",), ("unused",)], "id STRING")
    dim = dim.select("id", surrogate_key("id").alias("k"))
    made = joins.attach_key(facts, dim, ("id", "id"), "k", surrogate_key)
    assert rows(made) == rows(joins.attach(facts, dim, {"id": "id"}, ["k"])) and made.count() == 1 + 4 + 1 + 1 + 3 + 1
    none = joins.attach_key(facts, dim.limit(0), ("id", "id"), "k", surrogate_key)
    assert none.count() == 7 and none.where("k IS NOT NULL").count() == 0
