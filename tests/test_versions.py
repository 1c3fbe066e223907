from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from encore import jobs, schemas
from encore.plans import build as plans
from encore.plans.build import Models, build
from encore.sources import versions

EVENT = {"event_id": "e1", "event_name": "Show", "event_date": "2024-05-03", "artist_id": "a1", "artist_name": "Drake",
         "venue_id": "v1", "venue_name": "Hall", "city": "New York", "state": "NY", "price_min": 10.0, "price_max": 20.0}


def raw(spark, *events):
    tables = {n: spark.createDataFrame([], s) for n, s in schemas.RAW_TABLES.items()}
    schema = tables["raw_ticketmaster_events"].schema
    rows = [[{**EVENT, **e}.get(f.name) for f in schema] for e in events]
    return {**tables, "raw_ticketmaster_events": spark.createDataFrame(rows, schema)}


def seen(spark, root):
    models = Models.read(spark, root)
    keys = {r.artist_key for r in models.fact_events.collect()}
    assert keys == {r.artist_key for r in models.dim_artists.collect()}  # of one version
    return sorted(r.artist_name for r in models.dim_artists.collect())


def test_readers_see_whole_versions_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "marts")
    with pytest.raises(LookupError):
        Models.read(spark, root)
    build(raw(spark, {}), root)
    before = Models.read(spark, root)
    assert seen(spark, root) == ["Drake"]

    def broken(*_):
        assert seen(spark, root) == ["Drake"]  # dimensions of the new version are written by now
        raise RuntimeError("lost between dimensions and fact")

    with monkeypatch.context() as patched:
        patched.setattr(plans.marts, "fact_events", broken)
        with pytest.raises(RuntimeError):
            build(raw(spark, {"artist_id": "a2", "artist_name": "Adele"}), root)
    assert seen(spark, root) == ["Drake"]
    build(raw(spark, {"artist_id": "a3", "artist_name": "Bjork"}), root)
    assert seen(spark, root) == ["Bjork"]
    assert [r.artist_name for r in before.dim_artists.collect()] == ["Drake"]  # a reader that began before goes on


def test_old_versions_are_removed_by_age(spark, tmp_path):
    root, now = str(tmp_path / "set"), datetime(2024, 5, 10, tzinfo=timezone.utc)

    def write(days_ago, publish=True):
        folder = versions.new_version(root, now - timedelta(days=days_ago))
        spark.range(3).write.parquet(f"{folder}/t")
        if publish:
            versions.publish(spark, root, folder)
        return folder.rsplit("/", 1)[-1]

    assert versions.published(spark, root).count() == 0
    oldest, failed, old, last, running = write(9), write(8, False), write(7), write(6), write(0, False)
    (tmp_path / "set" / "versions" / "notes").mkdir()
    assert versions.remove_old(spark, root, timedelta(days=5), now=now) == sorted([oldest, failed])
    assert versions.remove_old(spark, root, timedelta(days=5), now=now) == []
    assert versions.current(spark, root).endswith(last)
    left = {p.name for p in (tmp_path / "set" / "versions").iterdir()}
    assert left == {old, last, running, "notes"} and versions.remove_old(spark, str(tmp_path / "none"), timedelta(0)) == []


def test_job_keeps_the_last_two(spark, tmp_path):
    root = str(tmp_path / "marts")
    for name in ("A", "B", "C", "D"):
        build(raw(spark, {"artist_name": name}), root, keep_for=timedelta(0))
    assert len(list((tmp_path / "marts" / "versions").iterdir())) == 2 and seen(spark, root) == ["D"]
    assert jobs.check(Models.read(spark, root)).count() > 0
