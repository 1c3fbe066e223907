"""SimHash near-duplicates found by a generalised pigeonhole.

The 64 bits are cut into partitions, correlated bits together, and each partition
gets a threshold of its own: if the thresholds add up to the distance minus the number
of partitions plus one, two fingerprints within the distance agree within the
threshold of at least one partition. Dynamic programming picks the thresholds with
the least estimated work at the number of fingerprints there is, for every number of partitions; the cheapest of these is taken, so that
more fingerprints get wider keys. A partition of threshold -1 is not probed. Fingerprints are
indexed by the exact bits of a partition, probed with all variants within its
threshold, and verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, repeat
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import checkpointed, small_batches
from .components import roots

SEED, WORDS, DISTANCE = 42, 4, 4
#: Fingerprints that bits' correlations and candidate counts are estimated from, at most.
SAMPLE = 4_000
#: Rows of a bucket that meet in one place; larger buckets are compared block by block.
BLOCK = 4_096
#: What sending an index or probe row costs, in comparisons of two fingerprints.
ROW_COST = 200
#: Shingles whose bits are spread out at once.
AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bit i is set if more than half of the shingles' hashes have it; A-Z are lower-cased; zero without words."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)]))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at:at + AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(id, fp) for every row; fp holds the 64 bits as a signed number."""
    small_batches(rows.sparkSession)
    kind = rows.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return rows.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`")).mapInArrow(run, f"id {kind}, fp long")


def bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), bitorder="little").reshape(-1, 64)


def correlated_partitions(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in groups of near equal size; each group grows by the bit most correlated with it."""
    if len(sample) < 2:
        return [list(range(p, 64, parts)) for p in range(parts)]
    bits = bits_of(sample).astype(np.float64)
    centred = bits - bits.mean(0)
    norm = np.sqrt((centred ** 2).sum(0))
    related = np.abs(centred.T @ centred) / np.maximum(np.outer(norm, norm), 1e-9)
    free, groups = list(range(64)), []
    for p in range(parts):
        group = [free.pop(0)]
        while len(group) < 64 // parts + (p < 64 % parts):
            best = max(range(len(free)), key=lambda i: (related[free[i], group].sum(), -free[i]))
            group.append(free.pop(best))
        groups.append(sorted(group))
    return groups


def keys_of(fps: np.ndarray, bits: Sequence[int]) -> np.ndarray:
    """The bits of a partition as a number."""
    key = np.zeros(len(fps), dtype=np.uint64)
    for place, bit in enumerate(bits):
        key |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return key


def thresholds(sample: np.ndarray, groups: Sequence[Sequence[int]], distance: int = DISTANCE, rows: int = 1) -> tuple[float, list[int]]:
    """Least estimated work for each of so many fingerprints, in comparisons, and its thresholds, which add up to ``distance - partitions + 1``.

    A partition and threshold cost the candidates, by the share of pairs of the sample that agree
    within it and that of random bits, which the sample may be too small to show, and the rows to send for all variants.
    """
    a, b = sample[:1000], sample[-1000:]
    cost = []
    for bits in groups:
        apart = np.bitwise_count(keys_of(a, bits)[:, None] ^ keys_of(b, bits)[None, :]).ravel()
        within = np.cumsum(np.bincount(apart, minlength=65)) / max(1, len(apart))
        variants = np.cumsum([float(comb(len(bits), t)) for t in range(distance + 1)])
        cost.append([0.0] + [rows * (within[t] + variants[t] / 2.0 ** len(bits)) + ROW_COST * variants[t] for t in range(distance + 1)])
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for costs in cost:
        # sums are kept with one added for each partition, so that they are never negative
        following: dict[int, tuple[float, list[int]]] = {}
        for total, (spent, chosen) in best.items():
            for t in range(-1, distance + 1):
                option = (spent + costs[t + 1], [*chosen, t])
                if total + t + 1 not in following or option < following[total + t + 1]:
                    following[total + t + 1] = option
        best = following
    return best[distance + 1]


def partitions(sample: np.ndarray, rows: int, distance: int = DISTANCE) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds of the least estimated work for so many fingerprints; the fewer partitions of equal ones."""
    found = []
    for parts in range(2, max(2, distance + 1) + 1):
        groups = correlated_partitions(sample, parts)
        work, limits = thresholds(sample, groups, distance, rows)
        found.append((work, parts, groups, limits))
    return min(found)[2:]


def variants(width: int, threshold: int) -> list[int]:
    """Masks of 1 to ``threshold`` bits to flip."""
    return [sum(1 << b for b in c) for t in range(1, threshold + 1) for c in combinations(range(width), t)]


def entries(groups: Sequence[Sequence[int]], limits: Sequence[int]):
    """Function for ``mapInPandas``: index and probe rows (part, key, fp, exact) of fingerprints."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            for part, (bits, limit) in enumerate(zip(groups, limits)):
                if limit < 0:
                    continue
                keys = keys_of(fps, bits)
                found = [(keys, fps, True)]
                for mask in map(np.uint64, variants(len(bits), limit)):
                    # of two keys one bit apart, that with the bit set probes the other
                    asks = (keys & mask) != 0 if limit == 1 else np.ones(len(keys), dtype=bool)
                    found.append((keys[asks] ^ mask, fps[asks], False))
                for k, f, exact in found:
                    if len(k):
                        yield pd.DataFrame({"part": np.int32(part), "key": k.view(np.int64), "fp": f.view(np.int64), "exact": exact})

    return run


def linked(fps: np.ndarray, exact: np.ndarray, bucket: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by bucket, index rows first in each, as a forest: (fp, least fp it reaches here)."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.r_[starts, len(bucket)])
    index_rows = np.add.reduceat(exact.astype(np.int64), starts) if len(starts) else starts
    row_start, row_index = np.repeat(starts, sizes), np.repeat(index_rows, sizes)
    found: list[np.ndarray] = []
    bound = np.cumsum(row_index)
    at = 0
    while at < len(fps):
        # rows whose pairs with the index rows of their bucket are some millions
        end = max(at + 1, int(np.searchsorted(bound, (bound[at - 1] if at else 0) + 4_000_000)))
        n = row_index[at:end]
        left = np.repeat(np.arange(at, end), n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(row_start[at:end], n)
        near = (np.bitwise_count(fps[left] ^ fps[right]) <= distance) & (fps[left] != fps[right])
        if near.any():
            found.append(np.unique(np.stack([fps[left[near]], fps[right[near]]], 1), axis=0))
        at = end
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    pairs = np.concatenate(found)
    nodes, ends = np.unique(pairs, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for side in (root[a], root[b], a, b):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect exactly those within the distance.

    Each bucket of equal keys gives at most one link per fingerprint, which joins its members as all
    its pairs would. Buckets of more than ``BLOCK`` rows are cut into blocks, and
    every two blocks are compared in a place of their own.
    """
    sample = np.array([r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], dtype=np.int64).view(np.uint64)
    total = fps.count()
    groups, limits = partitions(sample, total, distance)
    rows = fps.mapInPandas(entries(groups, limits), "part int, key long, fp long, exact boolean")
    large = rows.groupBy("part", "key").count().where(F.col("count") > BLOCK).select(
        "part", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    cut = rows.join(large, ["part", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    place = F.xxhash64("part", "key", F.least("own", "other"), F.greatest("own", "other"))
    shards = max(64, total // 10_000)

    def verified(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place", "exact"], ascending=[True, False], kind="stable")
        a, b = linked(group["fp"].to_numpy().view(np.uint64), group["exact"].to_numpy(), group["place"].to_numpy(), distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = cut.select("fp", "exact", place.alias("place")).withColumn("shard", F.pmod("place", F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(verified, "a long, b long").distinct()


def components(
    rows: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE
) -> DataFrame:
    """(id, fingerprint, component_id) for every row.

    ``component_id`` is the smallest id reachable over links of ``distance`` or
    fewer differing bits; equal fingerprints are linked, those of texts without words included. Null and empty texts have no
    words. Rows with a null id are kept and take part; null if a component has no other. Repeated rows
    stay repeated; no rows give none; extra columns are ignored.

    Links are sought between distinct fingerprints, so copies never multiply.
    """
    marked = checkpointed(fingerprints(rows, id, text, words))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("id").alias("first")))
    root = roots(links(distinct.select("fp"), distance))
    at = distinct.join(root.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = at.groupBy("root").agg(F.min("first").alias("component_id"))
    named = at.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
