"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, with DataFrame functions only.

The ring has ``2 ** bits`` equal arcs; each shard owns virtual nodes at hashed arcs,
and a key belongs to the first virtual node clockwise of its own arc. A shard takes
no more than its bound; keys that find it full continue clockwise to the next virtual
node with room. The bounds are exact: the shards' bounds add up to the number of rows
and differ by one at most, so the law ``rows`` holds.

Which shard a run of keys reaches depends only on how many keys each arc has, so the
walk is made over the counts of the arcs (``2 ** bits`` numbers, whatever the size of
the data) and gives ranges of ranks within an arc; rows find theirs by their rank.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

RING_BITS, NODES_PER_SHARD = 12, 64


def virtual_nodes(shards: int, bits: int = RING_BITS, per_shard: int = NODES_PER_SHARD) -> dict[int, int]:
    """Arc -> shard. A taken arc sends a node to the next free one, so all nodes stand for any number of shards."""
    if shards * per_shard > 1 << bits:
        raise ValueError("the ring has fewer arcs than virtual nodes")
    nodes: dict[int, int] = {}
    for node in range(per_shard):
        for shard in range(shards):
            at = int.from_bytes(hashlib.md5(f"{shard}/{node}".encode()).digest()[:8], "big") >> (64 - bits)
            while at in nodes:
                at = (at + 1) % (1 << bits)
            nodes[at] = shard
    return nodes


def bounds(rows: int, shards: int) -> list[int]:
    """Exact bounds: they add up to the rows and differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def ranges(
    counts: dict[int, int], shards: int, bits: int = RING_BITS, per_shard: int = NODES_PER_SHARD
) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, past the last rank, shard, slot of the first rank) for all keys.

    Walks the ring clockwise. Keys reach a virtual node in the order of the ring,
    its own arcs' keys before those that come from full shards; what does not fit
    goes on. Two rounds suffice, as every shard has nodes in each.
    """
    nodes, bound, filled = virtual_nodes(shards, bits, per_shard), bounds(sum(counts.values()), shards), [0] * shards
    out: list[tuple[int, int, int, int, int]] = []
    moving: deque[tuple[int, int, int]] = deque()  # arc, first rank, keys
    for turn in range(2):
        own: deque[tuple[int, int, int]] = deque()
        for arc in range(1 << bits):
            if turn == 0 and counts.get(arc):
                own.append((arc, 0, counts[arc]))
            shard = nodes.get(arc)
            if shard is None:
                continue
            queue: deque[tuple[int, int, int]] = deque()
            for at, first, n in [*own, *moving]:
                take = min(n, bound[shard] - filled[shard])
                if take:
                    out.append((at, first, first + take, shard, filled[shard]))
                    filled[shard] += take
                if take < n:
                    queue.append((at, first + take, n - take))
            own, moving = deque(), queue
        moving.extend(own)  # keys past the last node meet the first one of the next round
    return out


def arc_of(key: Column, bits: int = RING_BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


def assign(
    rows: DataFrame, key: str, shards: int, keep: Sequence[str], bits: int = RING_BITS, per_shard: int = NODES_PER_SHARD
) -> DataFrame:
    """Columns ``keep`` of every row with ``shard`` and its ``slot``, gapless from 0 in each shard.

    Within an arc rows are ordered by the key's hash, the key and then the kept columns, so the result
    does not depend on how the input is partitioned; equal rows are interchangeable.
    Null keys are one key. Any number of rows works, none included; columns outside
    ``keep`` are left aside, kept ones named ``shard`` or ``slot`` give way.
    """
    spark = rows.sparkSession
    keep = [c for c in keep if c not in ("shard", "slot")]
    arc = arc_of(F.col(f"`{key}`"), bits)
    counts = {r[0]: r[1] for r in rows.groupBy(arc.alias("arc")).count().collect()}  # 2 ** bits rows at most
    plan = spark.createDataFrame(
        ranges(counts, shards, bits, per_shard), "_arc int, _first long, _past long, shard int, _slot long")
    kept = rows.select(*[F.col(f"`{c}`") for c in keep], arc.alias("_arc"), F.xxhash64(F.col(f"`{key}`")).alias("_hash"),
                       F.col(f"`{key}`").alias("_key"))
    order = Window.partitionBy("_arc").orderBy("_hash", "_key", *[f"`{c}`" for c in keep])
    ranked = kept.withColumn("_rank", (F.row_number().over(order) - 1).cast("long"))
    inside = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_past"))
    # some thousands of ranges at most, by the size of the ring
    return ranked.join(F.broadcast(plan), "_arc").where(inside).select(
        *[F.col(f"`{c}`") for c in keep], "shard", (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot"))
