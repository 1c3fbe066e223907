"""Versions of a set of tables, and a pointer to the one that readers see.

A build writes all of its tables below a folder of its own, ``<root>/versions/<time>-<random>``. Only when the last one is
there is the version published: one row in one small file is added to the table ``<root>/published``, which any
store shows to readers as a whole or not at all. Readers take the newest row, so they always see one whole version; a build
that fails leaves the old one in place. Versions that nobody reads any more are removed by age.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

POINTER = "version STRING, published_at TIMESTAMP"
_TIME = "%Y%m%dT%H%M%S%f"


def new_version(root: str, now: datetime | None = None) -> str:
    """A folder for a new version; its name starts with the time of its making."""
    made = (now or datetime.now(timezone.utc)).strftime(_TIME)
    return f"{root}/versions/{made}-{uuid.uuid4().hex[:8]}"


def published(spark: SparkSession, root: str) -> DataFrame:
    """(version, published_at) of all versions that were ever published; no rows where there is none."""
    try:
        return spark.read.schema(POINTER).parquet(f"{root}/published")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POINTER)


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Let readers see a version, which is whole by now. One file with one row appears at once."""
    name = version.rsplit("/", 1)[-1]
    row = spark.createDataFrame([(name,)], "version STRING").select("version", F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/published")


def current(spark: SparkSession, root: str) -> str:
    """The folder of the version published last; LookupError where there is none."""
    newest = F.max_by("version", F.struct("published_at", "version")).alias("version")
    name = published(spark, root).agg(newest).first()["version"]
    if name is None:
        raise LookupError(f"no version is published below {root}")
    return f"{root}/versions/{name}"


def _folders(spark: SparkSession, folder: str) -> Iterator[tuple[str, object, object]]:
    """(name, file system, path) of the folders in a folder, on whatever store it is; none if it is absent."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        for status in files.listStatus(path):
            if status.isDirectory():
                yield status.getPath().getName(), files, status.getPath()


def remove_old(spark: SparkSession, root: str, older_than: timedelta, keep: int = 2, now: datetime | None = None) -> list[str]:
    """Remove the versions made longer ago than that, but the ``keep`` published last; returns their names.

    That includes versions of builds that failed. Choose an age above that of the longest report and build, as those still read or
    write theirs. Folders that are no versions are left alone.
    """
    order = [F.desc("published_at"), F.desc("version")]
    kept = {r.version for r in published(spark, root).orderBy(*order).limit(max(1, keep)).collect()}
    limit = (now or datetime.now(timezone.utc)) - older_than
    removed = []
    for name, files, path in _folders(spark, f"{root}/versions"):
        try:
            made = datetime.strptime(name.split("-")[0], _TIME).replace(tzinfo=timezone.utc)
        except ValueError:
            continue
        if made < limit and name not in kept:
            files.delete(path, True)
            removed.append(name)
    return sorted(removed)
