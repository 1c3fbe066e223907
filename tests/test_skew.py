"""One key holds a third of all rows, another third has no key: results and shuffles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from encore.operators.joins import attach, without_names
from encore.operators.latest import latest_per_key
from encore.plans.star import Dimension, Star

N = 120_000


@pytest.fixture
def hot(spark):
    """(event_id, k, day, loaded_at): k is 'hot' for a third, NULL for a third, spread for the rest."""
    i = F.col("id")
    k = F.when(i % 3 == 0, F.lit("hot")).when(i % 3 == 2, F.concat(F.lit("k"), (i % 1000).cast("string")))
    return spark.range(N, numPartitions=8).select(
        F.concat(F.lit("e"), i.cast("string")).alias("event_id"), k.alias("k"), (i % 7).alias("day"), i.alias("loaded_at"),
        (i % 50).cast("double").alias("price_avg"),
    )


def shuffled_records(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_latest_sends_one_row_of_a_hot_key_per_task(spark, hot):
    before = shuffled_records(spark)
    latest = latest_per_key(hot, ["k"], tiebreak=["event_id"]).collect()
    sent = shuffled_records(spark) - before
    assert len(latest) == 1 + 1 + hot.where("k like 'k%'").select("k").distinct().count()
    assert {r.k: r.loaded_at for r in latest}["hot"] == N - 3
    assert sent <= 8 * len(latest)


def test_rollup_sends_one_row_of_a_hot_key_per_task(spark, hot):
    keys = hot.select("k").where("k is not null").distinct()
    artists = keys.select("k", F.upper("k").alias("artist_name"), F.lit("rock").alias("genre"))
    days = spark.range(7).select(F.col("id").alias("day"), F.concat(F.lit("day"), F.col("id").cast("string")).alias("day_name"))
    halls = spark.range(1).select(F.lit("v").alias("venue"), F.lit("hall").alias("venue_name"))
    star = Star(hot.withColumn("venue", F.lit("v")), Dimension(artists, "k"), Dimension(halls, "venue"), Dimension(days, "day"), True)
    n_keys = keys.count()
    before = shuffled_records(spark)
    got = {r.artist_name: r.event_rows for r in star.rollup("artist_name").collect()}
    sent = shuffled_records(spark) - before
    assert got["HOT"] == N // 3 and sum(got.values()) == N // 3 * 2
    assert sent <= 8 * (n_keys + 2) * 4  # counts per key, the keys themselves, and the joined sums


def test_shuffled_join_splits_hot_and_missing_keys(spark, hot):
    spread = spark.range(1000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    dim = spread.unionByName(spark.range(1).select(F.lit("hot").alias("k"))).withColumn("v", F.upper("k"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = attach(hot, dim, {"k": "k"}, ["v"])
        assert joined.where("v = 'HOT'").count() == N // 3
        result = joined.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("known"), F.max("event_id"))
        got = result.collect()
        assert sum(r.n for r in got) == N and sum(r.known for r in got) == N // 3 * 2
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
        left_out = without_names(joined.select("event_id", "k", "day"), dim.where("k like 'k%'"), "k")
        kept = left_out.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.max("event_id"))
        assert sum(r.n for r in kept.collect()) == N // 3 * 2
        assert kept._jdf.queryExecution().executedPlan().toString().count("skew=true") >= 2
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
