"""Counts, distinct counts, means, modes and histograms.

Grouping drops NULL keys where the analysis does; the partial aggregate before
each shuffle collapses hot groups, so no group is ever gathered row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from encore.functions.money import priced

from .filters import known, known_text


def count_by(df: DataFrame, *keys: str, of: str | None = None, name: str = "events") -> DataFrame:
    """Rows (or non-NULL values of ``of``) per key; groups with a NULL key part are dropped."""
    counted = F.count(F.lit(1)) if of is None else F.count(of)
    return known(df, *keys).groupBy(*keys).agg(counted.alias(name))


def count_text_by(df: DataFrame, key: str, name: str = "events") -> DataFrame:
    """Rows per non-empty text key."""
    return known_text(df, key).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def distinct_counts(columns: dict[str, str], approximate: bool = False) -> list[Column]:
    """Distinct counts for one ``agg`` call: output name -> column. Exact by default."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return [count(F.col(c)).alias(name) for name, c in columns.items()]


def mean(value) -> Column:
    """Sum over count: exact for decimals, where ``avg`` would round. NULL if nothing counts."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def mean_where_positive(value: str, name: str) -> Column:
    """Mean of the positive values in the same pass as other aggregates; NULL if there are none."""
    return mean(priced(value)).alias(name)


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean of a value per non-NULL key."""
    return known(df, key).groupBy(key).agg(mean(F.col(value)).alias(name))


def most_frequent(counts: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    """Most frequent value per key from counts per (key, value), the smallest value on ties.

    Works on counts, so a key with many rows or many values is merged piecewise;
    ``F.mode`` would hold all values of a key in one buffer.
    """
    best = F.min_by(F.col(value), F.struct(-F.col(n), F.col(value))).alias(value)
    return known(counts, value).groupBy(*keys).agg(best)


def distinct_rows(df: DataFrame, key: str, *others: str) -> DataFrame:
    """Distinct combinations with a known key."""
    return known(df, key).select(key, *others).distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct known values, sorted."""
    return known(df, col).select(col).distinct().orderBy(col)


def union_distinct(first: DataFrame, second: DataFrame, col: str) -> DataFrame:
    """Distinct values of two lists, sorted."""
    return first.select(col).unionByName(second.select(col)).distinct().orderBy(col)


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram: (bin, bin_low, bin_high, events) of all bins, empty ones included.

    Values are counted once; bounds and bins are taken from the counts per value. The bounds
    are scalar subqueries, so no row is joined to them. NULL and NaN are left out. The top edge falls into the last bin,
    equal bounds give a single bin, no values give no bin.
    """
    counts = known(df, value).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.col(value).cast("double").alias("v"), "n").where(F.col("v") != float("nan"))
    bounds = counts.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    both = bounds.select(F.struct("low", "high")).scalar()
    placed = counts.select("v", "n", both.alias("b")).select("v", "n", "b.low", "b.high")
    raw_bin = F.coalesce(F.width_bucket("v", "low", "high", F.lit(bins)), F.lit(1))
    filled = placed.groupBy(F.least(raw_bin, F.lit(bins)).cast("int").alias("bin")).agg(F.sum("n").alias("events"))
    last = F.when(F.col("low") == F.col("high"), 1).otherwise(bins)
    one = df.sparkSession.range(1).select(both.alias("b")).select("b.low", "b.high").where("low IS NOT NULL")
    every = one.select("low", "high", F.explode(F.sequence(F.lit(1), last)).alias("bin"))
    width = (F.col("high") - F.col("low")) / bins
    return every.join(filled, "bin", "left").select(
        "bin",
        (F.col("low") + (F.col("bin") - 1) * width).alias("bin_low"),
        (F.col("low") + F.col("bin") * width).alias("bin_high"),
        F.coalesce("events", F.lit(0)).alias("events"),
    )
