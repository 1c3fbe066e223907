"""Joins on natural keys and on names.

No side is forced to broadcast unless its rows were counted: table sizes grow with the data, so Spark
picks a broadcast only when the measured size is under its threshold
(``spark.sql.autoBroadcastJoinThreshold``, at planning time from file sizes and
at run time from shuffle sizes) and shuffles, splitting skewed partitions,
otherwise. Splitting works where both sides come straight from a shuffle: join events
to a dimension that is a table (``plans.build`` writes them), or aggregate events on
the key first (``plans.star``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from encore.functions.text import name_key, same_name
from encore.operators.filters import known

#: Rows of ids that a dimension lacks or repeats that are broadcast, at most.
EXCEPTIONS = 1_000_000


def attach(facts: DataFrame, dim: DataFrame, on: dict[str, str], take: Sequence[str], few: bool = False) -> DataFrame:
    """Left equi-join that adds columns of a dimension; NULL keys match nothing.

    ``on`` maps columns of the facts to columns of the dimension. A key that
    repeats in the dimension repeats the fact. ``few`` tells that the dimension's rows were counted and can be broadcast.
    """
    wanted = dim.select(
        *[F.col(right).alias(f"__{right}") for right in on.values()],
        *[F.col(c) for c in take],
    )
    condition = [facts[left] == wanted[f"__{right}"] for left, right in on.items()]
    return facts.join(F.broadcast(wanted) if few else wanted, condition, "left").drop(*[f"__{r}" for r in on.values()])


def attach_key(
    facts: DataFrame, dim: DataFrame, on: tuple[str, str], key: str, made: Callable[[str], Column],
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """``attach`` of a dimension's key that is ``made`` from the id it is joined on, without moving the facts.

    The key follows from the facts' own id. Looked up are only ids that the dimension lacks, which get no key, and
    those it repeats, which repeat the fact: one shuffle of distinct ids instead of all columns of the facts. They are counted and
    broadcast; over ``EXCEPTIONS`` rows of them the join is ``attach``. ``keep`` may store them, as they are read twice.
    """
    own, natural = on
    times = known(dim, natural).groupBy(F.col(natural).alias("__natural")).agg(F.count(F.lit(1)).alias("__times"))
    used = known(facts, own).select(F.col(own).alias("__id")).distinct()
    looked_up = used.join(times, F.col("__id") == F.col("__natural"), "left")
    other = keep(looked_up.where(F.coalesce("__times", F.lit(0)) != 1).select("__id", "__times"))
    copies = F.greatest(F.coalesce("__times", F.lit(1)), F.lit(1))
    if (other.agg(F.sum(copies)).first()[0] or 0) > EXCEPTIONS:
        return attach(facts, dim, {own: natural}, [key])
    other = other.select("__id", F.col("__times").isNull().alias("__lacking"), F.explode(F.sequence(F.lit(1), copies)).alias("__copy"))
    joined = facts.join(F.broadcast(other.drop("__copy")), facts[own] == other["__id"], "left")
    has = F.col(own).isNotNull() & ~F.coalesce("__lacking", F.lit(False))
    return joined.withColumn(key, F.when(has, made(own))).drop("__id", "__lacking")


def attach_by_name(
    left: DataFrame, right: DataFrame, left_name: str, right_name: str, take: Sequence[str]
) -> DataFrame:
    """Left join on names ignoring case. Several right rows of one name repeat the left row."""
    wanted = right.select(F.col(right_name).alias("__name"), *[F.col(c) for c in take])
    return left.join(wanted, same_name(left[left_name], wanted["__name"]), "left").drop("__name")


def outer_by_name(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Full outer join on the exact name, with NULL names matching each other."""
    right = right.withColumnRenamed(name, "__name")
    joined = left.join(right, left[name].eqNullSafe(right["__name"]), "full")
    return joined.withColumn(name, F.coalesce(F.col(name), F.col("__name"))).drop("__name")


def left_by_name_key(
    left: DataFrame, right: DataFrame, name: str, take: Sequence[str]
) -> DataFrame:
    """Left join on the stripped, lower-cased name."""
    wanted = right.select(name_key(name).alias("__key"), *take)
    keyed = left.withColumn("__left_key", name_key(name))
    joined = keyed.join(wanted, keyed["__left_key"] == wanted["__key"], "left")
    return joined.drop("__key", "__left_key")


def without_names(df: DataFrame, excluded: DataFrame, name: str) -> DataFrame:
    """Rows whose name is not among the excluded names, ignoring case.

    The excluded names are reduced to distinct spellings, not to distinct keys: both
    sides then come straight from a shuffle on the key, which lets Spark split a name
    that holds much of the left side.
    """
    names = excluded.select(F.col(name).alias("__name")).distinct()
    return df.join(names, same_name(df[name], names["__name"]), "left_anti")


def union_with_precedence(first: DataFrame, second: DataFrame, name: str) -> DataFrame:
    """All rows of the first table, and those of the second whose name the first lacks."""
    return first.unionByName(without_names(second, first, name).select(*first.columns))
