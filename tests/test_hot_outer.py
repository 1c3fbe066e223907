"""Full outer joins whose names hold a third of a side."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from encore.operators import skew
from encore.operators.joins import outer_by_name

N = 60_000
OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def sides(spark):
    """Left: a third 'hot', a sixth 'lonely', some missing. Right: few rows a name, two 'hot', one missing, one of its own."""
    i = F.col("id")
    name = F.when(i % 3 == 0, "hot").when(i % 6 == 1, "lonely").when(i % 997 != 0, F.concat(F.lit("k"), (i % 400).cast("string")))
    left = spark.range(N, numPartitions=4).select(name.alias("name"), (i % 500).alias("n"))
    right = spark.range(600).select(
        F.when(F.col("id") < 2, "hot").when(F.col("id") != 5, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("name"), F.col("id").alias("m"))
    return left, right


def counted(df):
    return sorted(((tuple(r) for r in df.groupBy(*sorted(df.columns)).count().collect())), key=repr)


@pytest.mark.parametrize("limit", [skew.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("swapped", [False, True])
def test_same_rows_as_the_plain_join(spark, sides, monkeypatch, limit, swapped):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    left, right = sides[::-1] if swapped else sides
    got = skew.outer_by_hot_name(left, right, "name", parts=10)
    assert got.columns == outer_by_name(left, right, "name").columns
    assert counted(got) == counted(outer_by_name(left, right, "name"))


def test_hot_keys(spark, sides):
    assert skew.hot_keys(sides[0], "name", 10) == ["hot", "lonely"]
    assert skew.hot_keys(sides[1], "name", 10) == [] and skew.hot_keys(sides[0].limit(0), "name", 10) == []


@pytest.mark.parametrize("limit", [skew.BROADCAST_ROWS, 0])
def test_no_task_has_a_whole_hot_name(spark, sides, monkeypatch, limit):
    """Rows a task of the joins writes: without the treatment a third of all meet in one."""
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    left = sides[0].where("name is not null").withColumn("n", F.monotonically_increasing_id())
    left = spark.createDataFrame(left.toPandas()).repartition(4)
    settings = {**OFF, "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        def sizes(df):
            return sorted(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())

        plain = sizes(outer_by_name(left, sides[1], "name"))
        treated = sizes(skew.outer_by_hot_name(left, sides[1], "name", parts=16))
        assert plain[-1] > N / 3 and treated[-1] < plain[-1] / 3
        salted = sizes(skew.salted_join(left.where("name = 'hot'"), sides[1].where("name = 'hot'"), "name", 16))
        assert sum(salted) == 2 * N // 3 and len(salted) == 16 and salted[-1] <= 3 * salted[8]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_empty_sides_and_clashing_columns(spark, sides):
    left, right = sides
    for a, b in ((left.limit(0), right), (left, right.limit(0)), (left.limit(0), right.limit(0))):
        assert counted(skew.outer_by_hot_name(a, b, "name", 10)) == counted(outer_by_name(a, b, "name"))
    with pytest.raises(ValueError):
        skew.outer_by_hot_name(left, right.withColumnRenamed("m", "n"), "name")
