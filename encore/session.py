"""Session settings the engine relies on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: joins by measured size, merged small and split skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str = "encore", **settings: str) -> SparkSession:
    """A session with these settings. On a cluster give ``spark.checkpoint.dir`` and a
    ``spark.sql.shuffle.partitions`` of some times the number of cores: adaptive
    execution merges partitions that turn out small, but does not split all of them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes that a task reads of a compressed table or shuffle, at most, where it sorts wide rows: decoded they take ten times as much or more.
BYTES_PER_TASK = {"spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}
UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def small_sorts(spark: SparkSession) -> None:
    """Lower the session's bytes per task, where they are higher, so that a task sorts its rows in memory and writes no spilled runs."""
    for name, most in BYTES_PER_TASK.items():
        number, unit = re.fullmatch(r"(\d+)([kmg]?)i?b?", spark.conf.get(name).lower()).groups()
        if int(number) * UNITS[unit] > most:
            spark.conf.set(name, str(most))


#: Tasks a core that read a table, at least where its row groups allow it.
READS_PER_CORE = 4


def small_reads(spark: SparkSession) -> None:
    """Let a scan have some tasks a core, where the session does not say how many: one large task a core leaves the others waiting for the longest."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(READS_PER_CORE * spark.sparkContext.defaultParallelism))
