"""Bucketed layouts against plain joins, and their plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from encore.operators.joins import attach
from encore.plans.layouts import lay_out
from encore.plans.star import Dimension

N = 30_000
DIMS = {"artist_key": ("artist_name", 800), "venue_key": ("venue_name", 300), "date_key": ("day_name", 40)}


@pytest.fixture(scope="module")
def star(spark):
    """A third of all rows by one artist, a sixth without one; one venue twice in its dimension; keys outside of theirs."""
    i = F.col("id")
    fact = spark.range(N, numPartitions=4).select(
        i.alias("event_id"), F.when(i % 3 == 0, F.lit("a7")).when(i % 6 != 1, F.concat(F.lit("a"), (i % 900).cast("string"))).alias("artist_key"),
        F.concat(F.lit("v"), (i % 300).cast("string")).alias("venue_key"), F.concat(F.lit("d"), (i % 40).cast("string")).alias("date_key"),
        (i % 90).cast("decimal(10,2)").alias("price_avg"))
    dims = {}
    for key, (name, n) in DIMS.items():
        frame = spark.range(n).select(F.concat(F.lit(key[0]), "id").alias(key), F.concat(F.lit("n"), (F.col("id") % 37).cast("string")).alias(name))
        dims[key] = Dimension(frame.unionByName(frame.where(f"{key} IN ('v3', 'a7')").withColumn(name, F.lit("second"))), key)
    return fact, dims


@pytest.fixture(scope="module")
def layouts(star, tmp_path_factory):
    fact, dims = star
    made = {k: lay_out(fact, d, ["event_id", "price_avg"], str(tmp_path_factory.mktemp("layouts")), buckets=8) for k, d in dims.items()}
    yield made
    for layout in made.values():
        layout.drop()


def counted(df):
    return sorted((tuple(r) for r in df.groupBy(*sorted(df.columns)).count().collect()), key=repr)


@pytest.mark.parametrize("key", DIMS)
def test_same_rows_and_sums(star, layouts, key):
    fact, dims = star
    name = DIMS[key][0]
    plain = attach(fact.select(key, "event_id", "price_avg"), dims[key].frame, {key: key}, [name])
    assert counted(layouts[key].attached([name])) == counted(plain)
    sums = {"events": F.count("event_id"), "prices": F.sum("price_avg")}
    wanted = plain.where(F.col(name).isNotNull()).groupBy(name).agg(*[c.alias(n) for n, c in sums.items()])
    assert sorted(map(tuple, layouts[key].grouped(name, sums).collect())) == sorted(map(tuple, wanted.collect()))


def test_no_exchange_under_the_three_joins(spark, layouts):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in settings:
        spark.conf.set(s, "-1")
    try:
        for key, (name, _) in DIMS.items():
            plan = layouts[key].attached([name])._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
            grouped = layouts[key].grouped(name, {"events": F.count("event_id")})._jdf.queryExecution().executedPlan().toString()
            shuffles = [line for line in grouped.split("\n") if "Exchange hashpartitioning" in line]
            # sums per attribute, and the counts per hot key, of which there are few
            assert [f"hashpartitioning({name}" in s for s in shuffles] == [True] + [False] * (len(shuffles) - 1) and len(shuffles) <= 2
    finally:
        for s in settings:
            spark.conf.unset(s)


def test_hot_and_missing_keys_lie_apart(layouts):
    layout = layouts["artist_key"]
    assert {r[0] for r in layout.hot_fact.select("artist_key").distinct().collect()} == {"a7", None}
    sizes = [r[1] for r in layout.fact.groupBy(F.abs(F.hash("artist_key")) % 8).count().collect()]
    assert max(sizes) < N / 8 and layouts["venue_key"].hot_fact.count() == 0


def test_no_rows(star, tmp_path):
    fact, dims = star
    layout = lay_out(fact.limit(0), dims["date_key"], ["event_id"], str(tmp_path), buckets=4, take=["day_name"])
    assert layout.attached(["day_name"]).count() == 0 and layout.grouped("day_name", {"n": F.count("event_id")}).count() == 0
    layout.drop()


def test_more_rows_get_more_buckets(spark, star, tmp_path, monkeypatch):
    monkeypatch.setattr("encore.plans.layouts.BUCKET_ROWS", 500)
    (fact, dims), n = star, N
    assert n > 4 * 500
    layout = lay_out(fact, dims["date_key"], ["event_id"], str(tmp_path), buckets=4, take=["day_name"])
    try:
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {layout.names[0]}").collect()}
        assert int(described["Num Buckets"]) == -(-n // 500)
        assert layout.attached(["day_name"]).count() == n
    finally:
        layout.drop()
