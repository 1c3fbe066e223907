"""The fact laid out by the key of a dimension, so that joining and grouping by it need no shuffle.

``lay_out`` writes the needed columns of the fact and the dimension as tables with equal buckets of the key's hash: a task reads bucket i of both.
A bucket is read by one task whatever its size and adaptive execution cannot split it. Keys that hold more than a bucket's
share of the rows, and rows without a key, are therefore written to a plain table beside; there are
fewer such keys than buckets, so their rows of the dimension are counted and broadcast. One layout serves many
reports; it costs the chosen columns once more and one shuffle when it is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from encore.operators.filters import known
from encore.operators.joins import attach
from encore.operators.skew import BROADCAST_ROWS, among, hot_keys
from encore.sources.tables import materialise

from .star import Dimension


#: Rows of the fact in a bucket, at most, but for a key's own: one task sorts a bucket when it is written.
BUCKET_ROWS = 2_000_000


@dataclass(frozen=True)
class Layout:
    """A fact and a dimension with equal buckets of ``key``, and the fact's rows of hot and missing keys with theirs."""

    key: str
    fact: DataFrame
    dimension: DataFrame
    hot_fact: DataFrame
    hot_dimension: DataFrame
    names: tuple[str, str]

    def attached(self, take: Sequence[str]) -> DataFrame:
        """The fact's rows with columns of the dimension, as ``joins.attach`` gives them; nothing is shuffled."""
        on = {self.key: self.key}
        return attach(self.fact, self.dimension, on, take).unionByName(attach(self.hot_fact, self.hot_dimension, on, take))

    def grouped(self, attribute: str, sums: dict[str, Column]) -> DataFrame:
        """Sums of the fact's columns per known attribute of the dimension.

        ``sums`` are aggregates that add up, such as counts and sums. They are formed per key in the buckets, joined there, and only
        sums per attribute are shuffled. Keys that repeat in the dimension count as the row-wise join counts them.
        """
        on = {self.key: self.key}
        measures = [c.alias(n) for n, c in sums.items()]
        parts = [attach(fact.groupBy(self.key).agg(*measures), dim, on, [attribute])
                 for fact, dim in ((self.fact, self.dimension), (self.hot_fact, self.hot_dimension))]
        both = parts[0].unionByName(parts[1])
        return known(both, attribute).groupBy(attribute).agg(*[F.sum(n).alias(n) for n in sums])

    def drop(self) -> None:
        """Take the bucketed tables out of the catalog; the files belong to whoever chose their place."""
        for name in self.names:
            self.fact.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _bucketed(df: DataFrame, key: str, buckets: int, name: str, path: str) -> DataFrame:
    """One sorted file a bucket."""
    rows = df.repartition(buckets, key)
    rows.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def lay_out(
    fact: DataFrame, dimension: Dimension, columns: Sequence[str], location: str, buckets: int = 200, take: Sequence[str] | None = None
) -> Layout:
    """Write a layout of the fact's ``columns`` by the key of a dimension, and of the dimension's columns ``take`` (all by default), below ``location``.

    Choose buckets of some 100-200 MB of the fact; there are more than asked for where they would hold over ``BUCKET_ROWS`` rows. The tables are in the session's catalog under names of their own.
    """
    key, tag = dimension.key, uuid.uuid4().hex
    rows = fact.select(key, *[c for c in columns if c != key])
    dim = dimension.frame if take is None else dimension.frame.select(key, *[c for c in take if c != key])
    buckets = max(buckets, -(-rows.count() // BUCKET_ROWS))
    hot = among(key, hot_keys(rows, key, buckets))
    apart = hot | F.col(key).isNull()
    names = (f"fact_{key}_{tag}", f"dim_{key}_{tag}")
    spread = _bucketed(rows.where(~apart), key, buckets, names[0], f"{location}/{names[0]}")
    members = _bucketed(dim.where(F.col(key).isNotNull()), key, buckets, names[1], f"{location}/{names[1]}")
    hot_fact = materialise(rows.where(apart), f"{location}/hot_{names[0]}")
    hot_dim = materialise(dim.where(hot), f"{location}/hot_{names[1]}")
    few = hot_dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return Layout(key, spread, members, hot_fact, F.broadcast(hot_dim) if few else hot_dim, names)
