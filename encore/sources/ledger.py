"""Appends that can be repeated: a ledger of the loads of a table.

A load has a batch id that its sender chooses, such as the day. Its rows are written below a folder of their own and count only once a row
of the ledger names that folder; the row is one small file, which readers see as a whole. A batch that the ledger knows is not written
again; one that broke half-way left a folder that nobody reads, and its retry adds the whole load. If two senders write a batch at
once, the folder recorded first counts. Both lie in ``_loads`` below the table, which plain scans
of the table pass over: rows appended without a batch stay where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import scan

LEDGER = "batch STRING, folder STRING, recorded_at TIMESTAMP"


def loads(spark: SparkSession, path: str) -> DataFrame:
    """(batch, folder, recorded_at) of the loads of a table that count, one row a batch."""
    try:
        rows = spark.read.schema(LEDGER).parquet(f"{path}/_loads/ledger")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    first = F.min(F.struct("recorded_at", "folder")).alias("first")
    return rows.groupBy("batch").agg(first).select("batch", "first.folder", "first.recorded_at")


def append_once(df: DataFrame, path: str, columns: Sequence[str], batch: str) -> bool:
    """Append a load unless its batch is there already; tells whether it was written."""
    spark = df.sparkSession
    if not loads(spark, path).where(F.col("batch") == batch).isEmpty():
        return False
    folder = uuid.uuid4().hex
    df.select(*columns).write.parquet(f"{path}/_loads/data/{folder}")
    row = spark.createDataFrame([(batch, folder)], "batch STRING, folder STRING").select("*", F.current_timestamp().alias("recorded_at"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/_loads/ledger")
    return True


def scan_loads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a table: those appended plainly and those of the recorded loads."""
    plain = scan(spark, path, schema)
    folders = [r.folder for r in loads(spark, path).select("folder").collect()]  # one a load
    if not folders:
        return plain
    return plain.unionByName(spark.read.schema(schema).parquet(*[f"{path}/_loads/data/{f}" for f in sorted(folders)]))
