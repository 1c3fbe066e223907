"""Embedding whitening with Spark MLlib's block matrices.

Entries become integers, so that sums and deviations are exact. The distinct vectors are the fit list: its
centred rows are indexed into a distributed block matrix, the transpose times the matrix is the scatter, its
eigenvectors are found on the driver (a matrix of dimension by dimension, whatever the number of rows), and the block
matrix times the whitening matrix projects the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import checkpointed

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Entries whose size is above this cannot become a long and count as not finite.
LARGEST = 2.0 ** 56
#: Values of one block, about, its columns at most, and blocks that one task multiplies and adds up.
BLOCK_VALUES, BLOCK_COLUMNS, BLOCKS_PER_TASK = 1 << 18, 1024, 8
LONG = 2 ** 63


def quantised(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, y) of the usable rows, ``y`` being floor(64 * entry) as longs.

    Rows whose vector is null or holds a null, non-finite or huge entry are left out, also those that do not have the
    commonest length (of equally common ones the greatest).
    """
    entries = F.col(f"`{vector}`").cast("array<double>")
    usable = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= LARGEST, F.lit(False)))
    y = F.when(usable, F.transform(entries, lambda c: F.floor(c * SCALE).cast("long")))
    rows = vectors.select(F.col(f"`{id}`").alias("id"), y.alias("y")).where("y IS NOT NULL")
    common = rows.groupBy(F.size("y").alias("size")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("size")).first()
    return rows.where(F.size("y") == (common["size"] if common else 0))


def numbered(table: DataFrame) -> DataFrame:
    """The rows of a written table with ``index`` from 0 without gaps: places within a partition, after the
    counts of the partitions before it. The files are fixed, so every evaluation gives the same numbers."""
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = table.select(F.spark_partition_id().alias("partition"), local.alias("place"), *table.columns)
    counts = table.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition of the table
    starts = counts.select("partition", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "partition").select((F.col("start") + F.col("place")).alias("index"), *table.columns)


def times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a times b; the sum over the inner dimension is cut into ``splits`` tasks, added up afterwards. PySpark's own method
    lacks that argument, and one task would multiply all blocks of a tall matrix."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def row_frame(matrix: IndexedRowMatrix) -> DataFrame:
    """(index, vector) of a matrix, without a way through Python."""
    return callMLlibFunc("getIndexedRows", matrix._java_matrix_wrapper._java_model)


class Fit:
    """Counts and sums of the fit list (``y``), exact, and what follows from them."""

    def __init__(self, fit: DataFrame):
        sums = fit.select(F.posexplode("y").alias("at", "y")).groupBy("at").agg(
            F.count("*").alias("n"), F.sum(F.col("y").cast("decimal(20,0)")).alias("sum"),
            F.min("y").alias("low"), F.max("y").alias("high")).orderBy("at").collect()  # one row a dimension
        self.n, self.size = (sums[0].n if sums else 0), len(sums)
        self.sums = [int(r["sum"]) for r in sums]
        self.greatest = max([0, *[abs(v) for r in sums for v in (r.low, r.high)]])
        self.reach = max([0, *[abs(self.n * v - s) for r, s in zip(sums, self.sums) for v in (r.low, r.high)]])
        self.exact = self.n * self.greatest < LONG and max([0, *map(abs, self.sums)]) < LONG and self.reach < LONG

    def off(self, y: Column) -> Column:
        """n * y - sum by dimension: longs where they hold it, else null."""
        if not self.exact:
            return F.transform(y, lambda v: F.lit(None).cast("long"))
        return F.zip_with(y, F.lit(self.sums), lambda v, s: v * F.lit(self.n).cast("long") - s.cast("long"))

    def centred(self, y: Column) -> Column:
        if self.exact:
            return F.transform(self.off(y), lambda v: v.cast("double") / self.n)
        return F.zip_with(y, F.lit([float(s) / self.n for s in self.sums]), lambda v, m: v.cast("double") - m)

    def deviation(self, y: Column) -> Column:
        """The sum of (n * y - sum) squared, a decimal; null beyond its 38 digits."""
        kind = "decimal(38,0)"
        bound = self.size * self.reach ** 2
        if not self.exact or bound >= 10 ** 37:
            return F.lit(None).cast(kind)
        if bound < LONG:
            return F.aggregate(self.off(y), F.lit(0).cast("long"), lambda a, v: a + v * v).cast(kind)
        square = lambda v: (v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast(kind)
        return F.aggregate(self.off(y), F.lit(0).cast(kind), lambda a, v: (a + square(v)).cast(kind))


RESULT = ("component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row (id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    Entries c become x = floor(64 * c) + 1000000. ``n`` distinct x vectors are the fit list; components are eigenvectors
    of their covariance (divisor n) by falling eigenvalue, at most ``components``; of either sign the one whose largest entry is
    positive. ``whitened`` is the centred x projected on the component, over the root of the eigenvalue; null for a component without
    variance. ``explained`` is the eigenvalue's share of the trace, 0 where there is no variance; ``identity_error`` the largest
    absolute entry of the whitened fit list's covariance minus the identity, over components with variance (0 without).
    ``deviation`` is the exact sum of (n * x - sum) squared. Rows left out: see ``quantised``. Repeated rows and ids stay repeated and count
    once in the fit list; null ids are kept; other columns are left aside; no usable rows give no rows.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id, vector)
    fit = checkpointed(rows.select("y").distinct())  # read several times, and numbered
    known = Fit(fit)
    if known.size == 0:
        empty = spark.createDataFrame([], RESULT)
        return rows.limit(0).select(F.col("id").alias(id)).join(empty, F.lit(False))
    n, d = known.n, known.size
    k, width = min(components, d), min(d, BLOCK_COLUMNS)
    height = max(1, BLOCK_VALUES // width)

    placed = numbered(fit)
    frame = placed.select("index", array_to_vector(known.centred(F.col("y"))).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(frame, "vector"), n, d).toBlockMatrix(height, width)
    splits = -(-n // (height * BLOCKS_PER_TASK))
    covariance = times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray() / n
    values, basis = np.linalg.eigh((covariance + covariance.T) / 2)
    values, basis = np.maximum(values[::-1], 0), basis[:, ::-1]
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(d)] < 0, -1, 1)
    varies = values[:k] > values[0] * d * np.finfo(float).eps
    whitening = np.where(varies, basis[:, :k] / np.sqrt(np.where(varies, values[:k], 1)), 0)
    trace = float(values.sum())
    shares = [float(v) / trace if trace else 0.0 for v in values[:k]]

    blocks = [((i, 0), DenseMatrix(len(b), k, b.T.ravel())) for i, b in enumerate(
        whitening[at:at + width] for at in range(0, d, width))]
    projected = times(matrix, BlockMatrix(spark.sparkContext.parallelize(blocks), width, k, d, k)).toIndexedRowMatrix()
    error = 0.0
    if varies.any():
        spread = projected.toRowMatrix().computeCovariance().toArray() * ((n - 1) / n)
        error = float(np.abs(spread - np.eye(k))[np.ix_(varies, varies)].max())

    found = row_frame(projected).select("index", vector_to_array("vector").alias("z"))
    by_vector = placed.select("y", "index", known.deviation(F.col("y")).alias("deviation"))
    each = rows.join(by_vector, "y").select("id", "index", "deviation").join(found, "index")
    return each.select(F.col("id"), "deviation", F.posexplode("z").alias("at", "z")).select(
        F.col("id").alias(id), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.lit(varies.tolist())[F.col("at")], F.col("z")).alias("whitened"),
        F.lit(shares)[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
