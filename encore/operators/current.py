"""The latest row of every key, kept up to date load by load.

The rows lie in buckets of the keys' hash. A load is reduced to its latest row per key and merged with the buckets that its keys
fall into; only those are read and written anew, below a folder of the merge. A small table says which folder holds each bucket: its rows
for a merge are added as one file after the merge's data, so readers see a merge as a whole or not at all, and a merge that
fails, or a load merged twice, changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .latest import latest_per_key

PLACES = "merge BIGINT, bucket INT, folder STRING"
_BUCKET = "bucket__"


class LatestTable:
    """A stored table with one row per key, the one loaded last.

    ``buckets`` is fixed when the table is first written; some 100 MB of rows for each is a good size. Missing load times count as the latest and
    ties are broken as ``latest_per_key`` does, so merging loads in any order gives what it gives for all of their rows together. One merge
    runs at a time; any number of readers may.
    """

    def __init__(
        self, spark: SparkSession, location: str, schema: str | StructType, keys: Sequence[str], buckets: int = 256,
        loaded_at: str = "loaded_at", tiebreak: Sequence[str | Column] | None = None,
    ):
        self.spark, self.location, self.buckets = spark, location, buckets
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys, self.loaded_at = list(keys), loaded_at
        own = [f.name for f in self.schema if f.name not in self.keys and f.name != loaded_at]
        self.tiebreak = own if tiebreak is None else list(tiebreak)

    def places(self) -> DataFrame:
        """(bucket, merge, folder) of the newest data of every bucket that has some."""
        try:
            rows = self.spark.read.schema(PLACES).parquet(f"{self.location}/places")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], PLACES)
        return rows.groupBy("bucket").agg(F.max("merge").alias("merge"), F.max_by("folder", "merge").alias("folder"))

    def _read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of some buckets, or of all; the files of other buckets are not even listed."""
        places = self.places() if buckets is None else self.places().where(F.col("bucket").isin(list(buckets)))
        paths = [f"{self.location}/data/{r.folder}/{_BUCKET}={r.bucket}" for r in places.collect()]  # one a bucket at most
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def frame(self) -> DataFrame:
        """The latest row of every key over all merged loads."""
        return self._read()

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.select("*", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(_BUCKET))

    def merged(self, load: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The touched buckets after the load: one shuffle of their rows, by bucket, after the load is reduced to a row per key."""
        fresh = latest_per_key(load.select(*self.schema.names), self.keys, self.loaded_at, self.tiebreak)
        both = self._bucketed(self._read(touched).unionByName(fresh)).repartition(_BUCKET)
        return latest_per_key(both, [_BUCKET, *self.keys], self.loaded_at, self.tiebreak)

    def merge(self, load: DataFrame) -> list[int]:
        """Take in a load; returns the buckets that were written anew. NULL keys form one key."""
        touched = sorted(r[0] for r in self._bucketed(load.select(*self.keys)).select(_BUCKET).distinct().collect())  # at most all buckets
        if not touched:
            return []
        number = (self.places().agg(F.max("merge")).first()[0] or 0) + 1
        folder = f"{number}-{uuid.uuid4().hex[:8]}"
        self.merged(load, touched).write.partitionBy(_BUCKET).parquet(f"{self.location}/data/{folder}")
        rows = self.spark.createDataFrame([(number, b, folder) for b in touched], PLACES)
        rows.coalesce(1).write.mode("append").parquet(f"{self.location}/places")
        return touched
