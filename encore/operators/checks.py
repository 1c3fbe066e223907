"""Declarative column checks as Spark jobs.

Result rows: (table_name, column_name, check_name, severity, failures, passed).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    column: str
    kind: str  # "not_null" or "unique"
    severity: str = "error"  # or "warn"


def not_null(column: str, severity: str = "error") -> Check:
    return Check(column, "not_null", severity)


def unique(column: str, severity: str = "error") -> Check:
    return Check(column, "unique", severity)


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, with their counts; NULLs are not compared."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1)


def run_checks(df: DataFrame, table_name: str, checks: Sequence[Check]) -> DataFrame:
    """Evaluate all checks of a table.

    All not-null checks share one pass. The first unique column shares it too: the
    table is reduced to counts per key, from which repeated keys and NULLs both
    follow. Each further unique column takes a pass of its own.
    """
    uniques = [c.column for c in checks if c.kind == "unique"]
    nulls = list(dict.fromkeys(c.column for c in checks if c.kind == "not_null"))
    null_counts = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls]
    results = []
    if uniques:
        key = uniques[0]
        per_key = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"), *null_counts)
        totals = per_key.agg(
            F.count_if(F.col("__key").isNotNull() & (F.col("__n") > 1)).alias(f"unique_{key}"),
            *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in nulls],
        )
    else:
        totals = df.agg(*null_counts)
    shared = [c for c in checks if c.kind == "not_null" or c.column == uniques[0]]
    rows = F.array(*[
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("check_name"),
            F.lit(c.severity).alias("severity"),
            F.col(("null_" if c.kind == "not_null" else "unique_") + c.column).cast("bigint").alias("failures"),
        )
        for c in shared
    ])
    results.append(totals.select(F.inline(rows)))
    for c in checks:
        if c not in shared:
            results.append(
                repeated_keys(df, c.column).agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(table_name).alias("table_name"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.kind).alias("check_name"),
                    F.lit(c.severity).alias("severity"),
                    "failures",
                )
            )
    report = results[0]
    for r in results[1:]:
        report = report.unionByName(r)
    return report.withColumn("passed", F.col("failures") == 0)


def failed_run(report: DataFrame) -> DataFrame:
    """The rows that fail a run: failed checks of severity error. Warnings only report."""
    return report.where(~F.col("passed") & (F.col("severity") == "error"))
