"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each quantised with its own codebook; a cell is a pair
of centroids, so K centroids a half give K * K cells. A query walks the cells in
order of the summed distances of its halves to the two centroids, with a heap over
centroid pairs, until the cells passed hold enough rows; these are compared with
the query on the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows the codebooks are trained on, at most.
TRAINING_ROWS = 20_000
#: Rows of a cell that one task compares; larger cells are split.
BLOCK = 2_000
#: Share of all rows that a query is compared with. On vectors without much structure (64 nearly independent
#: components) this finds some 95 of 100 true neighbours; structured ones need far less.
SHARE = 0.45
#: Rows that a query is compared with, at least, where there are so many.
LEAST_ROWS = 5_000
#: Rows of a shard, about.
SHARD_ROWS = 20_000


def usable(vector: Column) -> Column:
    """Neither null nor zero nor holding a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest_centroid(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(1)[None, :] - 2.0 * points @ book.T).argmin(1)


def codebook(points: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """K-means from evenly spaced rows of a deterministic order; empty centroids keep their place."""
    order = np.lexsort(points.T)
    book = points[order[np.linspace(0, len(points) - 1, k).astype(int)]].copy()
    for _ in range(rounds):
        at = nearest_centroid(points, book)
        n = np.bincount(at, minlength=k)
        sums = np.stack([np.bincount(at, points[:, j], k) for j in range(points.shape[1])], 1)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def cells_of(vectors: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    h = books[0].shape[1]
    return nearest_centroid(vectors[:, :h], books[0]) * len(books[1]) + nearest_centroid(vectors[:, h:], books[1])


def walk(query: np.ndarray, books: tuple[np.ndarray, np.ndarray], counts: np.ndarray, enough: int) -> list[int]:
    """Non-empty cells in order of summed distance until they hold ``enough`` rows."""
    h = books[0].shape[1]
    d1, d2 = ((books[0] - query[:h]) ** 2).sum(1), ((books[1] - query[h:]) ** 2).sum(1)
    o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
    d1, d2, k2 = d1[o1], d2[o2], len(d2)
    heap, seen, found, cells = [(d1[0] + d2[0], 0, 0)], {(0, 0)}, 0, []
    while heap and found < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]) * k2 + int(o2[j])
        if counts[cell]:
            cells.append(cell)
            found += int(counts[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(d1) and b < k2 and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (d1[a] + d2[b], a, b))
    return cells


def shard_of(cell: np.ndarray, block: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a block of a cell."""
    mixed = (cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + block.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(shards)).astype(np.int64)


def closest(queries: pd.DataFrame, rows: pd.DataFrame, k: int, n_cells: int) -> Iterator[pd.DataFrame]:
    """The k nearest rows of each query among the rows of its cells in a shard, by distance and id."""
    if not len(queries) or not len(rows):
        return
    rows = rows.sort_values("cell", kind="stable")
    ids, vectors, cell = rows["id"].to_numpy(), matrix(rows["v"]), rows["cell"].to_numpy()
    for q, v, cells in zip(queries["id"], queries["v"], queries["cells"]):
        asked = np.zeros(n_cells, dtype=bool)
        asked[cells] = True
        at = np.flatnonzero(asked[cell] & (ids != q))
        d = np.sqrt(((vectors[at] - np.asarray(v, dtype=np.float64)) ** 2).sum(1))
        best = np.lexsort((ids[at], d))[:k]
        yield pd.DataFrame({"query_id": q, "vec_id": ids[at[best]], "score": d[best]})


def search(
    vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 10,
    share: float = SHARE,
    least_rows: int = LEAST_ROWS, training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of each query, ties to the smaller id.

    Score is the Euclidean distance of the original vectors in double precision. Rows
    with a null id and vectors that are null, zero, of another length than most, or
    hold null or non-finite components take no part, as queries or candidates. A
    query finds no row of its own id; repeated rows of an id are repeated
    candidates; of several query rows with one id the smallest vector is taken. With
    fewer rows than k all are found; empty tables give no rows. Extra columns are ignored.

    Codebooks are fitted on ``training_rows`` rows at most, taken by a hash of the id;
    every row is indexed. A half has about half the square root of the number of rows in
    centroids (a power of two from 8 to 128), so the counts of all cells are 16,384 numbers at most
    and go to all tasks. A query walks cells until they hold ``share`` of all rows, and ``least_rows`` at least. Cells
    with more than ``BLOCK`` rows are split into blocks, and their queries go to each; a query goes to a shard once, with
    the list of its cells there.
    """
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    picked = [F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")]
    good = (vectors.select(*picked)).where(F.col("id").isNotNull() & usable(F.col("v")))
    lengths = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    total = lengths[0]["count"] if lengths else 0
    if not total:
        return spark.createDataFrame([], empty)
    size = lengths[0]["n"]
    good = good.where(F.size("v") == size)
    half = max(1, size // 2)
    sample = matrix(good.orderBy(F.xxhash64("id"), "id").limit(training_rows).select("v").toPandas()["v"])
    per_half = int(min(128, max(8, 2 ** round(np.log2(total ** 0.5 / 2)))))
    books = (codebook(sample[:, :half], min(per_half, len(sample))),
             codebook(sample[:, half:], min(per_half, len(sample))) if size > half else np.zeros((1, 0)))
    shared_books = spark.sparkContext.broadcast(books)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(cell=cells_of(matrix(b["v"]), shared_books.value).astype("int32"))

    indexed = good.mapInPandas(placed, "id long, v array<double>, cell int")
    n_cells = len(books[0]) * len(books[1])
    counts = np.zeros(n_cells, dtype=np.int64)
    for r in indexed.groupBy("cell").count().collect():  # 16,384 rows at most
        counts[r["cell"]] = r["count"]
    blocks = np.maximum(1, -(-counts // BLOCK))
    shared = spark.sparkContext.broadcast((counts, blocks))
    enough = int(np.ceil(max(k + 1, least_rows, share * total)))
    shards = max(64, int(total // SHARD_ROWS))

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                cell = cells_of(matrix(b["v"]), shared_books.value)
                # rows of one id may be many too, so the row's place in its batch takes part
                spread = (b["id"].to_numpy() + np.arange(len(b))) % shared.value[1][cell]
                yield pd.DataFrame({"id": b["id"], "v": b["v"], "cell": cell.astype("int32"), "shard": shard_of(cell, spread, shards)})

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for q, v in zip(b["id"], matrix(b["v"]) if len(b) else ()):
                cells = np.array(walk(v, shared_books.value, shared.value[0], enough), dtype=np.int64)
                n = shared.value[1][cells]
                each, block = np.repeat(cells, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = shard_of(each, block, shards)
                order = np.argsort(at, kind="stable")
                where, starts = np.unique(at[order], return_index=True)
                yield pd.DataFrame({"id": q, "v": [v] * len(where), "shard": where,
                                    "cells": np.split(each[order].astype("int32"), starts[1:])})

    rows = good.mapInPandas(blocked, "id long, v array<double>, cell int, shard long")
    asked = (queries.select(*picked).where(F.col("id").isNotNull() & usable(F.col("v")) & (F.size("v") == size))
             .groupBy("id").agg(F.min("v").alias("v")))
    probes = asked.mapInPandas(probed, "id long, v array<double>, shard long, cells array<int>")

    def compared(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([pd.DataFrame({"query_id": [], "vec_id": [], "score": []}), *closest(q, r, k, n_cells)]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    near = probes.groupBy("shard").cogroup(rows.groupBy("shard")).applyInPandas(
        compared, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
