from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from encore import schemas
from encore.operators.latest import keep_first
from encore.session import READS_PER_CORE, small_reads, small_sorts
from encore.sources import landed, reference, tables


def landed_file(tmp_path, documents):
    path = tmp_path / "landed.json"
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def test_events(spark, tmp_path):
    full = {
        "id": "e1", "name": "Show", "url": "u",
        "dates": {"start": {"localDate": "2024-05-01", "localTime": "20:00:00"}, "status": {"code": "onsale"}},
        "_embedded": {
            "venues": [{"id": "v1", "name": "Hall", "city": {"name": "Boston"}, "state": {"stateCode": "MA"}}, {"id": "v2"}],
            "attractions": [{"id": "a1", "name": "Band"}, {"id": "a2", "name": "Support"}],
        },
        "priceRanges": [{"min": 10.5, "max": 20, "currency": "USD"}, {"min": 1}],
        "classifications": [{"genre": {"name": "Rock"}}, {"genre": {"name": "Pop"}}],
    }
    bare = {"id": "e2", "_embedded": {"venues": [], "attractions": []}, "classifications": []}
    docs = landed.read_landed(spark, landed_file(tmp_path, [full, bare, {"name": "x"}]), schemas.EVENT_DOC)
    got = landed.flatten_events(docs)
    assert got.columns == [c.split()[0] for c in schemas.RAW_TABLES["raw_ticketmaster_events"].split(",")]
    one, two, three = sorted(got.collect(), key=lambda r: r.event_id or "z")
    assert one[:16] == ("e1", "Show", "u", "2024-05-01", "20:00:00", "onsale", "Band", "a1", "Hall", "v1", "Boston", "MA", 10.5, 20.0, "USD", "Rock")
    assert two[1:16] == (None,) * 15 and two.event_id == "e2"
    assert three.event_name == "x" and three.event_id is None
    assert one.loaded_at == two.loaded_at and one.loaded_at is not None


def test_performers(spark, tmp_path):
    docs = [
        {"id": 7, "name": "Band", "short_name": "B", "url": "u", "score": 0.9, "popularity": 12, "num_upcoming_events": 3,
         "genres": [{"name": "Rock"}, {}, {"name": "Pop"}], "type": "band"},
        {"id": 8, "genres": []}, {"id": 9},
    ]
    got = landed.flatten_performers(landed.read_landed(spark, landed_file(tmp_path, docs), schemas.PERFORMER_DOC)).orderBy("performer_id").collect()
    assert got[0][:9] == ("7", "Band", "B", "u", 0.9, 12.0, 3, "Rock, , Pop", "band")
    assert [r.genres for r in got[1:]] == [None, None]


def test_listings(spark, tmp_path):
    docs = [
        {"id": 1, "title": "first", "datetime_local": "2024-05-01T20:00:00", "performers": [{"id": 1, "name": "x", "primary": False}, {"id": 2, "name": "y", "primary": True}],
         "venue": {"id": 5, "name": "Hall", "city": "Boston", "state": "MA"}, "stats": {"lowest_price": 1.0, "listing_count": 4}, "score": 0.5},
        {"id": 1, "title": "again"},
        {"id": 2, "datetime_local": "", "performers": [{"id": 1, "name": "x"}]},
        {"id": 3, "performers": []},
    ]
    docs = landed.read_landed(spark, landed_file(tmp_path, docs), schemas.LISTING_DOC).withColumn("position", F.monotonically_increasing_id())
    first = keep_first(docs.withColumn("id", F.col("id").cast("string")), "id", ["position"], drop_missing=False)
    one, two, three = landed.flatten_listings(first).orderBy("event_id").collect()
    assert (one.event_title, one.event_date, one.event_time, one.performer_name, one.performer_id) == ("first", "2024-05-01", "20:00:00", "y", "2")
    assert (one.venue_id, one.city, one.lowest_price, one.highest_price, one.listing_count) == ("5", "Boston", 1.0, None, 4)
    assert (two.event_date, two.event_time, two.performer_name) == (None, None, "x")
    assert (three.performer_name, three.performer_id) == (None, None)


def test_pages(spark):
    pages = spark.createDataFrame(
        [("A", "https://p/x/id1", "Title", "z" * 6000 + " 85,000 Monthly Listeners", {"title": "t", "description": "d"}),
         ("B", "https://p/x/id2", "", "nothing", {"title": "t"}),
         ("C", "https://p/x/id3", None, None, {}),
         ("D", "https://p/x/id4", None, "", None)],
        schemas.PAGE_DOC,
    )
    a, b, c, d = landed.parse_pages(pages).orderBy("artist_name").collect()
    assert (a.artist_id, a.monthly_listeners, a.page_title, a.page_description, len(a.raw_markdown)) == ("id1", 85000, "Title", "d", 6025)
    assert json.loads(a.raw_metadata) == {"title": "t", "description": "d"}
    assert (b.monthly_listeners, b.page_title, b.page_description) == (None, "t", "")
    assert (c.page_title, c.raw_markdown, c.raw_metadata) == ("", None, None)
    assert (d.page_title, d.raw_markdown, d.raw_metadata) == ("", None, None)


def test_union_feeds_ranks(spark, rows):
    a = spark.createDataFrame([("1", "broad"), ("2", "broad")], "id STRING, f STRING")
    b = spark.createDataFrame([("2", "target"), ("3", "target"), (None, "target")], "id STRING, f STRING")
    assert rows(keep_first(landed.union_feeds(a, b), "id", ["feed_rank"]).select("id", "f")) == [("1", "broad"), ("2", "broad"), ("3", "target")]


def test_parse_keeps_other_columns(spark, rows):
    df = spark.createDataFrame([(1, '{"id": "e", "name": "n"}'), (2, "broken")], "k INT, doc STRING")
    assert rows(landed.parse_landed(df, "doc", schemas.EVENT_DOC).select("k", "id", "name")) == [(1, "e", "n"), (2, None, None)]


def test_appends_and_refreshes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", "extra")], "k INT, v STRING, x STRING")
    tables.append_rows(df, path, ["k", "v"])
    tables.append_rows(df, path, ["k", "v"])
    assert rows(tables.scan(spark, path, "k INT, v STRING")) == [(1, "a"), (1, "a")]
    tables.replace_rows(df, path, ["v", "k"])
    assert rows(tables.scan(spark, path, "k INT, v STRING")) == [(1, "a")]


def test_create_if_absent(spark, rows, tmp_path):
    schema = schemas.RAW_TABLES["raw_tour_revenue"]
    for _ in range(2):
        tables.create_if_absent(spark, "raw_tour_revenue_t", schema, str(tmp_path / "tours"))
    tours = reference.tours(spark)
    tours.write.insertInto("raw_tour_revenue_t")
    assert spark.table("raw_tour_revenue_t").count() == 20
    assert spark.table("raw_tour_revenue_t").dtypes == tours.dtypes


@pytest.mark.parametrize("name", schemas.RAW_TABLES)
def test_declared_schemas_are_valid(spark, name):
    assert spark.createDataFrame([], schemas.RAW_TABLES[name]).columns


def test_materialise_view_and_reuse(spark, rows, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("part"))
    table = tables.materialise(df, str(tmp_path / "m"), ["part"])
    assert rows(table.select("id", "part")) == rows(df)
    assert "PartitionFilters: [isnotnull(part" in table.where("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert tables.publish_view(table, "model_view").count() == 100
    kept = tables.reused(df)
    assert kept.storageLevel.useDisk and kept.storageLevel.useMemory
    kept.unpersist()


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert tables.shared_folder(spark).startswith(folder)
    assert tables.new_location(spark, "x") != tables.new_location(spark, "x")


def test_stamp_is_one_instant(spark):
    stamps = tables.stamped(spark.range(1000, numPartitions=4)).agg(F.count_distinct("loaded_at")).collect()[0][0]
    assert stamps == 1


def test_reference_rows(spark):
    assert reference.city_coordinates(spark).count() == 68
    assert reference.curated_artists(spark).count() == 30
    assert reference.tours(spark).agg(F.sum("gross_revenue")).collect()[0][0] == sum(t[2] for t in reference.TOURS)


def test_bytes_per_task_are_only_lowered(spark):
    names = {"spark.sql.files.maxPartitionBytes": ("134217728b", str(32 << 20), "8MB"), "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("64m", str(16 << 20), "1m")}
    old = {name: spark.conf.get(name) for name in names}
    try:
        for name, (high, most, low) in names.items():
            for value, expected in ((high, most), (low, low)):
                spark.conf.set(name, value)
                small_sorts(spark)
                assert spark.conf.get(name) == expected
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def test_models_are_written_with_zstd(spark, tmp_path):
    tables.materialise(spark.range(3), str(tmp_path / "z")).collect()
    assert all(".zstd." in p.name for p in (tmp_path / "z").glob("*.parquet"))


def test_scans_have_some_tasks_a_core(spark, tmp_path):
    """Unless the session says how many; Spark alone makes one task a core of a table that fits them."""
    name, path = "spark.sql.files.minPartitionNum", str(tmp_path / "t")
    cores, opened = spark.sparkContext.defaultParallelism, "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name, None)
    spark.range(100 * cores, numPartitions=4 * cores).write.parquet(path)
    try:
        spark.conf.set(opened, "1")
        spark.conf.unset(name)
        assert spark.read.parquet(path).rdd.getNumPartitions() < 2 * cores
        small_reads(spark)
        assert spark.read.parquet(path).rdd.getNumPartitions() >= READS_PER_CORE * cores
        spark.conf.set(name, "2")
        small_reads(spark)
        assert spark.conf.get(name) == "2"
    finally:
        spark.conf.unset(opened)
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_missing_and_broken_documents_are_parsed_as_before(spark):
    texts = spark.createDataFrame([(1, '{"id": "a"}'), (2, None), (3, ""), (4, "{"), (5, "null"), (6, "[]")], "n INT, document STRING")
    got = landed.parse_landed(texts, "document", "id STRING")
    alone = texts.select("n", F.from_json("document", "id STRING").alias("d")).select("n", "d.*")
    assert got.columns == ["n", "id"] and sorted(got.collect()) == sorted(alone.collect())
