"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from encore.sources.tables import new_location, scan

SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table with its declared schema; no inference, so no extra job."""
    return scan(spark, f"{folder}/{name}.parquet", SCHEMAS[name])


#: Rows of texts that go to Python at once, at most.
ROWS_PER_BATCH = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch, where it is higher: a batch of whole texts is held
    several times, in the JVM's direct memory and in Python, by each task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= ROWS_PER_BATCH:
        spark.conf.set(name, str(ROWS_PER_BATCH))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as a table in the folder that all executors share; cuts the lineage.

    Written and read rather than ``checkpoint()``: it needs no folder set on the
    context, keeps columns compressed and survives lost executors in the same way.
    """
    place = new_location(df.sparkSession, "step")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only these columns, so that extra ones cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
