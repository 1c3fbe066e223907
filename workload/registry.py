"""Registry of queries: a name, a function of the tables, and oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .oracle import sql
from .tables import Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of the tables under a name."""
    def add(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, None if oracle is None else sql(oracle))
        return run

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name].run(Tables(spark, folder))
