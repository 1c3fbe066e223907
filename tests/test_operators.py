from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from encore.operators import aggregates, filters, joins, ranking
from encore.operators.checks import failed_run, not_null, repeated_keys, run_checks, unique
from encore.operators.latest import first_per_key, keep_first, latest_per_key, top_per_group
from encore.operators.lookup import geocode
from encore.operators.scaffold import fill_days
from encore.sources.reference import CITY_COORDINATES, city_coordinates, literal_rows


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [("e1", 1, "a"), ("e1", 2, "b"), ("e2", None, "a"), ("e2", 1, "b"), ("e3", 1, "a"), ("e3", 1, "b"),
         (None, 1, "x"), (None, 1, "y")],
        "k STRING, loaded_at INT, v STRING",
    )
    latest = latest_per_key(df, ["k"])
    assert rows(latest) == [("e1", 2, "b"), ("e2", None, "a"), ("e3", 1, "b"), (None, 1, "y")]
    assert rows(latest_per_key(latest, ["k"])) == rows(latest)
    assert rows(latest_per_key(df.orderBy(F.rand(3)), ["k"])) == rows(latest)
    chosen = latest_per_key(df, ["k"], tiebreak=[F.col("v").asc()])
    assert ("e3", 1, "a") in rows(chosen)


def test_first_per_key_and_feeds(spark, rows):
    df = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None)], "k INT, v STRING")
    assert rows(first_per_key(df, ["k"], ["v"])) == [(1, "a"), (2, None)]
    feed = spark.createDataFrame([("i", 2, "late"), ("i", 1, "early"), (None, 1, "none"), ("", 1, "empty")], "id STRING, r INT, v STRING")
    assert rows(keep_first(feed, "id", ["r"])) == [("i", 1, "early")]
    assert len(rows(keep_first(feed, "id", ["r"], drop_missing=False))) == 3


def test_top_per_group_keeps_ties_stable(spark, rows):
    df = spark.createDataFrame([("g", "b", 5), ("g", "a", 5), ("g", "c", 5), ("h", "z", 1)], "g STRING, k STRING, n INT")
    top = top_per_group(df, ["g"], [F.col("n").desc(), F.col("k").asc()], 2)
    assert rows(top.select("g", "k")) == [("g", "a"), ("g", "b"), ("h", "z")]


def test_threshold_applies_to_the_latest_row(spark, rows):
    df = spark.createDataFrame([("p", 1, 0.9), ("p", 2, 0.4), ("q", 1, 0.6), ("r", 1, None)], "k STRING, loaded_at INT, s DOUBLE")
    assert rows(filters.above(latest_per_key(df, ["k"]), "s", 0.5)) == [("q", 1, 0.6)]


def test_joins_by_name(spark, rows):
    left = spark.createDataFrame([(1, "Foo"), (2, "Bar"), (3, None)], "id INT, name STRING")
    right = spark.createDataFrame([("FOO", 10), ("foo", 11), (None, 12)], "n STRING, v INT")
    assert rows(joins.attach_by_name(left, right, "name", "n", ["v"]).select("id", "v")) == [(1, 10), (1, 11), (2, None), (3, None)]
    assert rows(joins.without_names(left, right.withColumnRenamed("n", "name"), "name").select("id")) == [(2,), (3,)]
    a = spark.createDataFrame([("x", 1), (None, 2)], "name STRING, a INT")
    b = spark.createDataFrame([("y", 3), (None, 4)], "name STRING, b INT")
    assert rows(joins.outer_by_name(a, b, "name").select("name", "a", "b")) == sorted(
        [("x", 1, None), ("y", None, 3), (None, 2, 4)], key=repr
    )
    keyed = joins.left_by_name_key(
        spark.createDataFrame([(" Foo\t",), ("none",)], "name STRING"),
        spark.createDataFrame([("FOO ", 7)], "name STRING, n INT"), "name", ["n"],
    )
    assert rows(keyed) == [(" Foo\t", 7), ("none", None)]
    united = joins.union_with_precedence(
        spark.createDataFrame([("A", "url1")], "name STRING, url STRING"),
        spark.createDataFrame([("a", "url2"), ("b", "url3")], "name STRING, url STRING"), "name",
    )
    assert rows(united) == [("A", "url1"), ("b", "url3")]


def test_attach_repeats_and_keeps(spark, rows):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id INT, k STRING")
    dim = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k STRING, v STRING")
    assert rows(joins.attach(facts, dim, {"k": "k"}, ["v"])) == [(1, "a", "x"), (1, "a", "y"), (2, "b", None), (3, None, None)]


def test_counts_drop_null_groups(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "k STRING, v INT")
    assert rows(aggregates.count_by(df, "k")) == [("a", 2)]
    assert rows(aggregates.count_by(df, "k", of="v")) == [("a", 1)]
    assert rows(aggregates.count_text_by(df.union(spark.createDataFrame([("", 1)], "k STRING, v INT")), "k")) == [("a", 2)]


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,)], "p DOUBLE")
    assert df.agg(aggregates.mean_where_positive("p", "m")).collect()[0].m is None
    both = df.union(spark.createDataFrame([(4.0,)], "p DOUBLE"))
    assert both.agg(aggregates.mean_where_positive("p", "m")).collect()[0].m == 4.0


def test_most_frequent_takes_the_smaller_on_ties(spark, rows):
    df = spark.createDataFrame([("x", "b", 3), ("x", "a", 3), ("x", None, 9), ("y", "c", 1)], "k STRING, v STRING, n INT")
    assert rows(aggregates.most_frequent(df, ["k"], "v", "n")) == [("x", "a"), ("y", "c")]


def test_histogram(spark):
    rng = random.Random(3)
    values = [rng.uniform(5, 300) for _ in range(500)] + [300.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "p DOUBLE")
    got = aggregates.histogram(df, "p").orderBy("bin").collect()
    assert sum(r.events for r in got) == len(values)
    assert got[0].bin == 1 and got[-1].bin == 20
    assert got[0].bin_low == 5.0 and got[-1].bin_high == pytest.approx(300.0)
    for r in got:
        inside = [v for v in values if r.bin_low <= v < r.bin_high or (r.bin == 20 and v == 300.0)]
        assert abs(len(inside) - r.events) <= 1  # an edge may round either way
    single = aggregates.histogram(spark.createDataFrame([(7.0,)] * 3, "p DOUBLE"), "p").collect()
    assert [tuple(r) for r in single] == [(1, 7.0, 7.0, 3)]
    assert aggregates.histogram(df.where("p < 0"), "p").collect() == []


def test_top_k(spark):
    df = spark.createDataFrame([("c", 2), ("a", 2), ("b", 2), ("d", None), ("e", 9)], "k STRING, n INT")
    assert [r.k for r in ranking.top_k(df, "n", 3, ["k"]).collect()] == ["e", "a", "b"]
    assert [r.k for r in ranking.top_k(df, "n", 3, ["k"], ascending=True).collect()] == ["b", "a", "e"]
    assert [r.k for r in ranking.top_k(df, "n", 5, ["k"]).collect()][-1] == "d"


def test_ordinal_and_scaffold(spark):
    df = spark.createDataFrame([("Sunday", 1), ("Monday", 2), (None, 3)], "day_name STRING, events INT")
    from encore.functions.calendar import DAYS

    assert [r.events for r in ranking.by_ordinal(df, "day_name", DAYS).collect()] == [2, 1, 3]
    filled = fill_days(df.where("day_name is not null"))
    assert [tuple(r) for r in ranking.by_ordinal(filled, "day_name", DAYS).collect()] == [
        ("Monday", 2), ("Tuesday", 0), ("Wednesday", 0), ("Thursday", 0), ("Friday", 0), ("Saturday", 0), ("Sunday", 1)
    ]
    assert fill_days(df.where("false")).count() == 7
    groups = spark.createDataFrame([("rock", "Friday", 4), ("jazz", "Monday", 1)], "genre STRING, day_name STRING, events INT")
    assert fill_days(groups, by=["genre"]).count() == 14


def python_geocode(city, state):
    """The lookup rule, row by row."""
    if city is None or state is None:
        return None, None
    city, state = city.strip(), state.strip()
    for c, s, lat, lon in CITY_COORDINATES:
        if (c, s) == (city, state):
            return lat, lon
    for c, s, lat, lon in CITY_COORDINATES:
        if s == state and city.lower() in c.lower():
            return lat, lon
    return None, None


def test_geocode_against_the_rule(spark):
    rng = random.Random(11)
    pairs = [("New York", "NY"), ("york", "NY"), ("Columbus", "CA"), (None, "NY"), ("Boston", None), ("", "CA"), (" san ", "CA "),
             ("Saint Louis", "MO"), ("Maryland Heights Amphitheater", "MO")]
    for city, state, _, _ in CITY_COORDINATES:
        start = rng.randint(0, len(city) - 1)
        part = city[start : start + rng.randint(1, 6)]
        pairs += [(part.upper(), state), (part, rng.choice(["CA", "NY", "TX", "FL"])), (f" {city}\t", state)]
    df = spark.createDataFrame(pairs, "city STRING, state STRING")
    got = geocode(df, city_coordinates(spark)).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert (r.lat, r.lon) == python_geocode(r.city, r.state), r


def test_checks(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 5), ("b", 2, 6), (None, 3, 6)], "k STRING, v INT, w INT")
    report = run_checks(df, "t", [unique("k"), not_null("k"), not_null("v", "warn"), unique("w"), unique("v")])
    assert rows(report) == sorted([
        ("t", "k", "unique", "error", 1, False),
        ("t", "k", "not_null", "error", 1, False),
        ("t", "v", "not_null", "warn", 1, False),
        ("t", "w", "unique", "error", 2, False),
        ("t", "v", "unique", "error", 0, True),
    ], key=repr)
    assert {(r.column_name, r.check_name) for r in failed_run(report).collect()} == {("k", "unique"), ("k", "not_null"), ("w", "unique")}
    assert rows(repeated_keys(df, "k")) == [("a", 2)]
    empty = run_checks(df.where("false"), "t", [unique("k"), not_null("k")])
    assert [r.failures for r in empty.collect()] == [0, 0]
    assert all(r.passed for r in run_checks(df, "t", [not_null("w")]).collect())


def test_literal_rows_have_a_known_size(spark):
    df = literal_rows(spark, [(1, "a"), (2, None)], "i INT, s STRING")
    assert df.dtypes == [("i", "int"), ("s", "string")]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()


def test_histogram_has_all_bins_and_no_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (100.0,), (float("nan"),), (None,)], "p DOUBLE")
    got = aggregates.histogram(df, "p").orderBy("bin").collect()
    assert [r.bin for r in got] == list(range(1, 21))
    assert [r.events for r in got] == [2] + [0] * 18 + [1]
    assert got[0].bin_low == 1.0 and got[-1].bin_high == pytest.approx(100.0)
    assert aggregates.histogram(df.where("p IS NULL OR isnan(p)"), "p").collect() == []


def test_nan_is_no_price(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.0,), (-1.0,), (2.5,), (float("inf"),)], "price_avg DOUBLE")
    assert [r.price_avg for r in filters.priced_rows(df).collect()] == [2.5, float("inf")]
    assert df.agg(aggregates.mean_where_positive("price_avg", "m")).first().m == float("inf")
    exact = df.where("price_avg = 2.5").selectExpr("cast(price_avg as decimal(10,2)) as price_avg")
    assert filters.priced_rows(exact).count() == 1


def test_approximate_distinct_counts(spark):
    df = spark.range(1000).selectExpr("id % 100 AS a", "id AS b")
    exact = df.agg(*aggregates.distinct_counts({"a": "a", "b": "b"})).first()
    about = df.agg(*aggregates.distinct_counts({"a": "a", "b": "b"}, approximate=True)).first()
    assert tuple(exact) == (100, 1000) and about.a == pytest.approx(100, rel=0.15) and about.b == pytest.approx(1000, rel=0.15)


def test_latest_per_key_of_whole_rows(spark, rows):
    rng = random.Random(8)
    texts = [None, "", "a", "\x1f", "\x1bn", "b\x1fc"]
    df = spark.createDataFrame(
        [(f"e{rng.randint(0, 9)}", rng.choice(texts), rng.randint(0, 3), rng.choice(texts), i, rng.choice(texts)) for i in range(200)],
        "k string, url string, loaded_at int, city string, n int, genre string")
    plain = latest_per_key(df, ["k"], tiebreak=["n"])
    whole = latest_per_key(df.repartition(3), ["k"], tiebreak=["n"], whole=True)
    assert whole.schema == df.schema and rows(whole) == rows(plain)
    exchanges = [x for x in whole._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in x or "__packed" in x]
    assert exchanges and rows(latest_per_key(df, ["k"], whole=True)) == rows(latest_per_key(df, ["k"]))
