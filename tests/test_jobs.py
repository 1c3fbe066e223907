from __future__ import annotations

import json

import pytest

from encore import jobs
from encore.plans.build import Models, build
from encore.sources.tables import scan


def land(folder, name, documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(d) for d in documents))
    return str(folder)


def event(i, artist, day="2024-05-03", low=10.0, venue=1):
    return {
        "id": f"e{i}", "name": f"Show {i}", "url": "u",
        "dates": {"start": {"localDate": day, "localTime": "20:00:00"}, "status": {"code": "onsale"}},
        "_embedded": {
            "venues": [{"id": f"v{venue}", "name": f"hall {venue}", "city": {"name": "new york"}, "state": {"stateCode": "ny"}}],
            "attractions": [{"id": artist.lower(), "name": artist}],
        },
        "priceRanges": [{"min": low, "max": low * 2, "currency": "USD"}],
        "classifications": [{"genre": {"name": "Rock"}}],
    }


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    landing, raw = tmp_path_factory.mktemp("landing"), str(tmp_path_factory.mktemp("raw"))
    broad = land(landing / "broad", "1", [event(1, "Drake"), event(2, "Unknown Act"), event(2, "Unknown Act")])
    targeted = land(landing / "targeted", "1", [event(1, "Somebody Else"), event(3, "Drake", "2024-05-04", 0.0, 2)])
    jobs.ingest(spark, "events", [broad, targeted], raw)
    jobs.ingest(spark, "events", [land(landing / "next", "1", [event(2, "Unknown Act", low=50.0)])], raw)
    jobs.ingest(spark, "performers", [land(landing / "p", "1", [{"id": 5, "name": "drake", "score": 0.9, "popularity": 7, "genres": [{"name": "Rap"}]}])], raw)
    jobs.ingest(spark, "listings", [land(landing / "l", "1", [{"id": 9, "title": "x"}, {"id": 9, "title": "x"}])], raw)
    page = {"artist_name": "Drake", "url": "https://x/artist/d1", "markdown": "1,000,000 monthly listeners", "metadata": {"title": "Drake"}}
    jobs.ingest(spark, "pages", [land(landing / "s", "1", [page])], raw)
    jobs.refresh_tours(spark, raw)
    return raw


def test_first_feed_wins_and_later_loads_replace(spark, raw):
    events = jobs.raw_tables(spark, raw)["raw_ticketmaster_events"]
    assert sorted((r.event_id, r.artist_name) for r in events.collect()) == [
        ("e1", "Drake"), ("e2", "Unknown Act"), ("e2", "Unknown Act"), ("e3", "Drake")
    ]
    assert jobs.raw_tables(spark, raw)["raw_seatgeek_events"].count() == 1


def test_build_check_and_reports(spark, raw, tmp_path):
    tables = jobs.raw_tables(spark, raw)
    built = build(tables, str(tmp_path / "marts"), strict=True, partition_fact_by=["event_date"])
    assert built.fact_events.count() == 3
    models = Models.read(spark, str(tmp_path / "marts"))
    assert {r.check_name for r in jobs.check(models).collect()} == {"unique", "not_null"}
    got = jobs.analyses(spark, models, unique_events=True)
    assert tuple(got["overview"].collect()[0])[:3] == (3, 2, 2)
    assert got["overview"].collect()[0].avg_price == (15.0 + 75.0) / 2
    top = got["demand_leaderboard"].collect()[0]
    assert (top.artist_name, top.monthly_listeners, top.sg_score, top.tm_events) == ("Drake", 1000000.0, 0.9, 2)
    tour = got["revenue_comparison"].collect()
    assert [(r.artist_name, r.revenue_multiplier) for r in tour] == [("Drake", round(320500000 / 2400000))]
    assert [tuple(r) for r in got["hotspots"].collect()] == [("New York", "NY", 40.7128, -74.006, 3)]
    for name, df in got.items():
        assert df.columns, name


def test_failed_checks_stop_the_run(spark, raw, tmp_path):
    tables = dict(jobs.raw_tables(spark, raw))
    tables["raw_ticketmaster_events"] = tables["raw_ticketmaster_events"].withColumn("event_name", tables["raw_ticketmaster_events"].genre.substr(9, 1).cast("string")).replace("", None, "event_name")
    models = build(tables, str(tmp_path / "marts"))
    with pytest.raises(ValueError, match="event_name not_null: 3"):
        jobs.check(models)


def test_declare(spark, raw):
    jobs.declare(spark, raw)
    jobs.declare(spark, raw)
    assert spark.table("raw_tour_revenue").count() == 20


def raw_table(spark, folder, name):
    return scan(spark, str(folder / "raw" / name), jobs.schemas.RAW_TABLES[name])


def test_first_document_of_a_file_wins(spark, tmp_path):
    folder = land(tmp_path / "landed", "1", [event(7, "First"), event(7, "Second"), event(8, "Z"), event(8, "A")])
    jobs.ingest(spark, "events", [folder], str(tmp_path / "raw"))
    found = raw_table(spark, tmp_path, "raw_ticketmaster_events").collect()
    assert {r.event_id: r.artist_name for r in found} == {"e7": "First", "e8": "Z"}


def test_whole_page_texts_are_kept(spark, tmp_path):
    text = "1,000 monthly listeners " + "x" * 20_000
    page = {"artist_name": "Drake", "url": "https://x/artist/d1", "markdown": text, "metadata": {}}
    jobs.ingest(spark, "pages", [land(tmp_path / "landed", "1", [page])], str(tmp_path / "raw"))
    [row] = raw_table(spark, tmp_path, "raw_spotify_artists").collect()
    assert (row.raw_markdown, row.monthly_listeners) == (text, 1000)


def test_page_text_is_not_read_by_the_model(spark, raw):
    from encore.plans import staging

    model = staging.stg_spotify_artists(jobs.raw_tables(spark, raw)["raw_spotify_artists"])
    plan = model._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert "page_title" in plan and "raw_markdown" not in plan


def test_pages_to_read(spark, raw):
    pages = jobs.pages_to_read(spark, jobs.raw_tables(spark, raw))
    names = [r.artist_name for r in pages.collect()]
    assert names.count("Unknown Act") == 1 and names.count("Drake") == 1 and len(names) > 3


def test_unreadable_dates_can_be_let_through(spark, tmp_path):
    folder = land(tmp_path / "landed", "1", [event(1, "A", day="soon")])
    jobs.ingest(spark, "events", [folder], str(tmp_path / "raw"))
    rest = {n: spark.createDataFrame([], s) for n, s in jobs.schemas.RAW_TABLES.items()}
    tables = {**rest, "raw_ticketmaster_events": raw_table(spark, tmp_path, "raw_ticketmaster_events")}
    built = build(tables, str(tmp_path / "marts"), lenient=True)
    assert built.fact_events.first().event_date is None
