"""URL filters by a sort-merge range join.

A host is written label by label from the right, each label closed by a dot, so
``www.example.org`` becomes ``org.example.www.``. A rule's reversed host is then a
prefix of the keys of its own host and of all subdomains: rules are nested
intervals of the sorted keys. One sweep over the sorted union of rules and pages
keeps the stack of the rules whose interval is open; a page sees exactly the rules
of its host and of the domains above it, and takes the longest whose path is a
prefix of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower

PARTS = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the right, each closed by a dot; empty for an empty host."""
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", "").otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


class OpenRules:
    """Rules whose interval of host keys is open, innermost last.

    Each level holds the paths of one host by length, so a page's longest path
    prefix is found by looking up its own prefixes. The depth is at most the
    number of labels of a host.
    """

    def __init__(self):
        self.levels: list[tuple[str, dict[int, dict[str, tuple[str, str]]]]] = []

    def move_to(self, key: str) -> None:
        """Close the intervals that do not contain this key."""
        while self.levels and not key.startswith(self.levels[-1][0]):
            self.levels.pop()

    def add(self, key: str, path: str, rule: str, verdict: str) -> None:
        if not self.levels or self.levels[-1][0] != key:
            self.levels.append((key, {}))
        same_length = self.levels[-1][1].setdefault(len(path), {})
        if path not in same_length or verdict == "block":
            same_length[path] = (rule, verdict)

    def best(self, key: str, path: str) -> tuple[str, str] | None:
        """The rule with the longest host and path together; of equally long ones that with the longer host."""
        found, length = None, -1
        for host, paths in reversed(self.levels):
            if host == "" and key != "":
                continue
            for n in sorted(paths, reverse=True):
                if n <= len(path) and len(host) + n > length and path[:n] in paths[n]:
                    found, length = paths[n][path[:n]], len(host) + n
                    break
        return found


def sweep(default: str, kept: Sequence[str]):
    """Function for ``mapInArrow`` over partitions sorted by unit, key and kind (rules before pages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rules = None, OpenRules()
        for batch in batches:
            is_page, judged = [], []
            columns = [batch.column(c).to_pylist() for c in ("_label", "_salt", "_key", "_kind", "_path", "_rule", "_verdict")]
            for label, salt, key, kind, path, rule, verdict in zip(*columns):
                if (label, salt) != unit:
                    unit, rules = (label, salt), OpenRules()
                rules.move_to(key)
                is_page.append(kind == 1)
                if kind == 0:
                    rules.add(key, path, rule, verdict)
                else:
                    judged.append(rules.best(key, path) or (None, default))
            pages = batch.filter(pa.array(is_page, pa.bool_()))
            found = [pa.array([j[i] for j in judged], pa.string()) for i in (0, 1)]
            names = [*kept, "_host", "_path"]
            yield pa.RecordBatch.from_arrays([*[pages.column(n) for n in names], *found], names=[*names, "_rule", "_verdict"])

    return run


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",),
    default: str = "allow", splits: int = 32,
) -> DataFrame:
    """Columns ``keep`` of every page with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has the strings ``host``, ``path`` and ``verdict``. A rule fits its host and all
    subdomains if the page's path starts with the rule's path; the longest wins, of
    two rules with the same host and path the blocking one. A rule without host fits
    only urls without one; a rule with a null host or path names nothing and fits
    nothing. A page without a fitting rule, also one with a null url, gets ``default``
    and a null rule. Repeated pages stay repeated; no pages give no rows; columns
    outside ``keep`` are left aside, so their names cannot clash, and a kept column
    named like a result column gives way to it.

    Pages are dealt by top-level label and one of ``splits`` numbers made of the url
    and the input partition, so that neither a popular domain nor a much repeated url
    meets in one task; rules go to all numbers of their label.
    """
    keep = [c for c in keep if c not in ("host", "path", "rule", "verdict")]
    kept = [f"_keep{i}" for i in range(len(keep))]
    source = F.col(f"`{url}`")
    left = pages.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)],
        host_of(source).alias("_host"), path_of(source).alias("_path"),
        F.pmod(F.xxhash64(source) + F.spark_partition_id(), F.lit(splits)).cast("int").alias("_salt"),
    ).withColumns({"_key": host_key(F.col("_host")), "_kind": F.lit(1), "_rule": F.lit(None).cast("string"),
                   "_verdict": F.lit(None).cast("string")})
    host = ascii_lower(F.col("host"))
    right = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        *[F.lit(None).cast(pages.schema[c].dataType).alias(k) for c, k in zip(keep, kept)],
        host.alias("_host"), F.col("path").alias("_path"),
        F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("_salt"),
        host_key(host).alias("_key"), F.lit(0).alias("_kind"),
        F.concat(host, F.col("path")).alias("_rule"), F.col("verdict").alias("_verdict"),
    )
    both = left.unionByName(right).withColumn("_label", F.substring_index("_key", ".", 1))
    dealt = both.repartition("_label", "_salt").sortWithinPartitions("_label", "_salt", "_key", "_kind")
    types = [f"{k} {pages.schema[c].dataType.simpleString()}" for c, k in zip(keep, kept)]
    judged = dealt.mapInArrow(
        sweep(default, kept), ", ".join([*types, "_host string", "_path string", "_rule string", "_verdict string"])
    )
    return judged.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)],
        *[F.col(f"_{c}").alias(c) for c in ("host", "path", "rule", "verdict")],
    )
