"""Raw and mart tables: scans, appends, full refreshes, materialised models, views."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

_local_folders: dict[str, str] = {}


def scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table with its declared schema: no inference, so no extra job."""
    return spark.read.schema(schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir`` of the session.

    A temporary folder is used only where that is unset and the session runs on
    one machine, as in tests; elsewhere the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        return f"{folder.rstrip('/')}/encore-{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = folder = tempfile.mkdtemp(prefix="encore-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_folders[context.applicationId]


def new_location(spark: SparkSession, name: str) -> str:
    """A location not used before, so that re-runs never read or overwrite older output."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stamped(df: DataFrame, name: str = "loaded_at") -> DataFrame:
    """Add the load time, one instant for the whole load."""
    return df.withColumn(name, F.current_timestamp())


def create_if_absent(spark: SparkSession, table: str, schema: str, path: str) -> None:
    """Declare a Parquet table in the catalog unless it is there already."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet LOCATION '{path}'")


def append_rows(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append a load with an explicit column list."""
    df.select(*columns).write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Full refresh: replace the whole table."""
    df.select(*columns).write.mode("overwrite").parquet(path)


def materialise(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a model as a table and read it back, which also cuts its lineage. Hashed keys take half the space under zstd, and a tenth
    less where the second version of Parquet's encodings keeps lengths and shared beginnings of texts apart.

    With partition columns the rows are rebalanced on them first: Spark then
    splits a partition value that holds much of the data over several writers
    and merges the small ones, instead of writing one file per task and value.
    """
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("overwrite").options(
        **{"compression": "zstd", "parquet.writer.version": "v2"})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a model to SQL without storing it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def reused(df: DataFrame) -> DataFrame:
    """Keep a result for the queries that follow, spilling to disk; release it with ``unpersist``."""
    return df.persist()
