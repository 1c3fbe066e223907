"""Every registered query against its oracle on the smallest tables, and the shapes of plans."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from check import difference, open_tables
from workload import QUERIES

FOLDER = entry.SMALLEST
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")

# Inventory of operators, functions, checks and analyses.
INVENTORY = {
    "src": 12, "prj": 13, "flt": 8, "jn": 11, "ag": 13, "win": 2, "srt": 6, "set": 4, "scl": 29, "qc": 3, "udf": 3, "q": 23,
}
# The engine's own queries; those of other packages have tests of their own.
OWN = {name: query for name, query in entry.queries().items() if name in QUERIES}
WRITES = ("q1_", "q23_", "jn1_", "src6", "src7", "src9", "src11")


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


def test_inventory_is_covered():
    names = OWN
    for family, count in INVENTORY.items():
        for i in range(1, count + 1):
            assert any(re.match(rf"{family}{i}_", n) for n in names), f"{family}{i}"
    assert set(entry.oracle_sql()) >= set(names) == set(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_matches_oracle(spark, db, name):
    n, problem = difference(OWN[name](spark, FOLDER), db, entry.oracle_sql()[name])
    assert problem is None
    assert n > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_and_no_python(spark):
    """Planned as if no table were small: every join still has an equality to shuffle by."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, query in OWN.items():
            if name.startswith(WRITES) or name.endswith(("_marts", "_sketched", "_bucketed", "_hot")):  # these write tables, or broadcast after a count
                continue
            plan = plan_of(query(spark, FOLDER))
            for node in ("Cartesian", "NestedLoop", "BroadcastHashJoin", "Python", "InPandas", "ExistingRDD"):
                assert node not in plan, (name, node)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["win1_latest_per_key"](spark, FOLDER))
    above, below = plan.split("Exchange hashpartitioning(l_orderkey", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["flt5_selected_value"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in plan
    states = plan_of(entry.queries()["q15_top_states"](spark, FOLDER))
    [lines] = re.findall(r"ReadSchema: (struct<l_orderkey[^>]*>)", states)
    assert "l_extendedprice" not in lines and "l_returnflag" not in lines
    assert "TakeOrderedAndProject" in states


def test_reports_aggregate_below_the_joins(spark):
    """Events are counted per key first, so a popular artist costs one row per task."""
    plan = plan_of(entry.queries()["q3_top_artists"](spark, FOLDER))
    joined = plan.index("artist_name")
    assert "partial_count(1)" in plan and "HashAggregate(keys=[artist_key" in plan[joined:]


@pytest.mark.parametrize("name", ["src2_flatten_events", "prj3_staging_events", "prj6_staging_listings"])
def test_lines_are_not_shuffled_to_their_places(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(s_nationkey" not in plan


def test_listings_are_flat_before_they_are_chosen(spark):
    """Documents with their lists are not sorted and shuffled, only the rows made from them."""
    plan = plan_of(entry.queries()["src4_flatten_listings"](spark, FOLDER))
    above, below = plan.split("Exchange hashpartitioning(event_id", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    assert "performers" not in above and "from_json" not in above


@pytest.mark.parametrize("name", ["src2_flatten_events", "src3_flatten_performers", "src4_flatten_listings"])
def test_documents_are_not_made_by_interpreted_expressions(spark, name):
    """``from_json`` is interpreted with all that is merged into it, so the text it reads is made one step below."""
    steps = plan_of(entry.queries()[name](spark, FOLDER)).split("\n")
    [parses] = [i for i, step in enumerate(steps) if "from_json(" in step]
    [writes] = [i for i, step in enumerate(steps) if "StructsToJsonEvaluator" in step]
    assert parses < writes
