"""Repeated loads, loads that break, and documents that cannot be read."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from encore import jobs
from encore.sources import ledger, tables

DDL = "id BIGINT, name STRING"


def load(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}", "extra") for i in ids], DDL + ", more STRING")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ledger.append_once(load(spark, 1, 2, 2), path, ["id", "name"], "day 1")
    assert not ledger.append_once(load(spark, 1, 2, 2), path, ["id", "name"], "day 1")
    assert ledger.append_once(load(spark, 3), path, ["id", "name"], "day 2")
    assert ids(ledger.scan_loads(spark, path, DDL)) == [1, 2, 2, 3]
    tables.append_rows(load(spark, 9), path, ["id", "name"])  # without a batch
    assert ids(ledger.scan_loads(spark, path, DDL)) == [1, 2, 2, 3, 9] and ids(tables.scan(spark, path, DDL)) == [9]


def test_a_broken_load_is_not_seen_and_its_retry_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger.append_once(load(spark, 1), path, ["id", "name"], "a")
    broken = load(spark, 2, 3, 4, 5).repartition(4).withColumn("name", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        ledger.append_once(broken, path, ["id", "name"], "b")
    assert ids(ledger.scan_loads(spark, path, DDL)) == [1]
    ledger.append_once(load(spark, 2, 3, 4, 5), path, ["id", "name"], "b")
    assert ids(ledger.scan_loads(spark, path, DDL)) == [1, 2, 3, 4, 5]


def test_of_two_senders_the_first_recorded_counts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    ledger.append_once(load(spark, 1), path, ["id", "name"], "a")
    monkeypatch.setattr(ledger, "loads", lambda *_: spark.createDataFrame([], ledger.LEDGER))  # the other's row came too late
    ledger.append_once(load(spark, 1), path, ["id", "name"], "a")
    monkeypatch.undo()
    assert ids(ledger.scan_loads(spark, path, DDL)) == [1]


def test_unread_documents_go_aside(spark, tmp_path):
    good = {"id": "e1", "name": "Show", "priceRanges": [{"min": 10.0}]}
    odd = {"id": "e2", "name": "Odd price", "priceRanges": "ask"}
    lines = [json.dumps(good), '{"id": "e3", "name": ', "plain words", json.dumps(odd), "", json.dumps({"other": 1})]
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "1.json").write_text("\n".join(lines))
    raw = str(tmp_path / "raw")
    for _ in range(2):
        jobs.ingest(spark, "events", [str(tmp_path / "feed")], raw, batch="day 1")
    events = ledger.scan_loads(spark, f"{raw}/raw_ticketmaster_events", "event_id STRING, event_name STRING, price_min DOUBLE")
    assert sorted(tuple(r) for r in events.collect()) == [("e1", "Show", 10.0), ("e2", "Odd price", None)]
    aside = ledger.scan_loads(spark, f"{raw}/{jobs.REJECTED}", "source STRING, landed_file STRING, document STRING, reason STRING").collect()
    assert sorted((r.document, r.reason) for r in aside) == sorted([
        ('{"id": "e3", "name": ', "no document"), ("plain words", "no document"), (json.dumps(odd), "unreadable field")])
    assert all(r.landed_file.endswith("1.json") and r.source == "raw_ticketmaster_events" for r in aside)


def test_pages_add_up(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "1.json").write_text("\n".join(['{"artist_name": "A", "url": "u/1"}', "[", "{"] + ['{"artist_name": "B"}'] * 2))
    raw = str(tmp_path / "raw")
    jobs.ingest(spark, "pages", [str(tmp_path / "feed")], raw)
    assert spark.read.parquet(f"{raw}/raw_spotify_artists").count() == 3 and spark.read.parquet(f"{raw}/{jobs.REJECTED}").count() == 2
