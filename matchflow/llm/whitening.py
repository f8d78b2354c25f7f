"""Embedding whitening with MLlib's distributed block matrices.

Vectors become whole numbers (floor of ``scale`` times the component, plus ``shift``), so that counts, sums and deviations are
exact. The fit list holds every different vector once. Its centred rows are indexed into a BlockMatrix X; X-transposed times X
is the scatter, whose d x d matrix is small and is decomposed on the driver; X times the whitening matrix projects all rows.

Blocks have a bounded number of bytes. The scatter is split along the rows, as the product of a wide and a tall matrix has one
block and would otherwise be made by one task. What the driver holds is one d x d matrix and the positions of the blocks.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchflow.session import materialise

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BLOCK_BYTES = 4 << 20
MAX_SPLITS = 100_000
NO_VARIANCE = 1e-12  # share of the largest eigenvalue below which a direction counts as constant
FARTHEST = float(1 << 62)
EXACT = "decimal(38,0)"
SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whole(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Components as whole numbers; those beyond 2^62 count as 2^62."""
    near = lambda c: F.least(F.greatest(c * float(scale), F.lit(-FARTHEST)), F.lit(FARTHEST))
    return F.transform(vector, lambda c: F.floor(near(c)) + F.lit(shift).cast("bigint"))


def finite(vector: Column) -> Column:
    """Neither null nor empty, and every component is a finite number."""
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, number), F.lit(False))


def block_matrix(rows: DataFrame, n_rows: int, columns: int, rows_per_block: int) -> BlockMatrix:
    """Blocks of rows given as (number, vector array)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("number", array_to_vector("vector").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n_rows, columns).toBlockMatrix(rows_per_block, columns)


def product(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a times b, the inner dimension dealt over ``splits`` tasks for every block of the result."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def gram(a: BlockMatrix, splits: int) -> np.ndarray:
    """a-transposed times a, which is small, as a local matrix."""
    return product(a.transpose(), a, splits).toLocalMatrix().toArray()


def local_block(matrix: np.ndarray, like: BlockMatrix) -> BlockMatrix:
    """A local matrix as one block that ``like`` can be multiplied by."""
    block = ((0, 0), Matrices.dense(*matrix.shape, matrix.flatten("F")))
    return BlockMatrix(like.blocks.ctx.parallelize([block], 1), like.colsPerBlock, matrix.shape[1])


def rows_of(matrix: BlockMatrix, name: str) -> DataFrame:
    """Rows of a block matrix as (number, array of doubles)."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("number"), vector_to_array("vector").alias(name))


def decompose(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whitening matrix, share of the variance per component and which components vary, by falling eigenvalue."""
    covariance = (scatter + scatter.T) / 2 / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    varies = values > max(NO_VARIANCE * values[0], 0.0)
    weights = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    total = np.trace(covariance)
    return vectors * weights, (np.maximum(values, 0.0) / total if total > 0 else np.zeros(len(values))), varies


def whiten(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every usable row on the first ``components`` principal directions, scaled to unit variance; one row per component.

    Columns: vec_id, component (from 1), n (different vectors), deviation (sum over dimensions of (n*x - S)^2; null if it does
    not fit a long), whitened, explained (share of the variance) and identity_error (largest difference between the
    covariance of the whitened fit list and the identity, over directions that vary).

    A vector that is null, empty or holds a null or a number that is not finite is left out, and so is one whose length is
    not the most frequent one (of equally frequent lengths the longer counts), as no covariance is defined between them.
    Repeated rows and null ids are returned row by row. A direction without variance has whitened 0.0; if there is no variance
    at all, explained is 0.0. An empty table gives no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    valid = rows.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    valid = valid.where(finite(F.col("vector")))
    lengths = valid.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], SCHEMA)
    d = lengths["d"]
    x = whole(F.col("vector"), scale, shift).alias("x")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")
    placed = materialise(valid.where(F.size("vector") == d).select("vec_id", x, F.spark_partition_id().alias("part"), place), "vectors")
    shape = placed.agg(F.max("place").alias("place"), F.max("part").alias("part")).first()
    width = shape["place"] + 1  # numbers leave gaps where a part is shorter than the longest
    placed = placed.select("vec_id", "x", (F.col("part").cast("bigint") * width + F.col("place")).alias("number"))
    fit = materialise(placed.groupBy("x").agg(F.min("number").alias("number")), "fit-list")
    n = fit.count()
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast(EXACT)).alias("s"), F.min("v").alias("low"), F.max("v").alias("high"))
    sums = sums.orderBy("i").collect()  # one row per dimension
    farthest = max(max(abs(r["low"]), abs(r["high"])) for r in sums)
    spread = max(r["high"] - r["low"] for r in sums)
    plain = n * farthest < 1 << 62 and d * (n * spread) ** 2 < 1 << 62
    kind = "bigint" if plain else EXACT
    total = F.lit([str(int(r["s"])) for r in sums]).cast(f"array<{kind}>")
    apart = F.zip_with("x", total, lambda v, s: v.cast(kind) * F.lit(n).cast(kind) - s)  # n times the centred vector
    square = (lambda a: a * a) if plain else (lambda a: F.try_multiply(a.cast(EXACT), a.cast(EXACT)).cast(EXACT))
    add = (lambda a, b: a + b) if plain else (lambda a, b: F.try_add(a, b).cast(EXACT))
    deviation = F.aggregate(apart, F.lit(0).cast(kind), lambda a, b: add(a, square(b))).try_cast("bigint")
    centred = F.transform(apart, lambda v: v.cast("double") / float(n)).alias("vector")

    n_rows = (shape["part"] + 1) * width
    rows_per_block = max(1, block_bytes // (8 * d))
    splits = min(-(-n_rows // rows_per_block), MAX_SPLITS)
    fitted = block_matrix(fit.select("number", centred), n_rows, d, rows_per_block)
    matrix, explained, varies = decompose(gram(fitted, splits), n, components)
    weights = local_block(matrix, fitted)
    unit = gram(product(fitted, weights), splits) / n
    error = float(np.abs(unit - np.eye(len(unit)))[np.ix_(varies, varies)].max(initial=0.0))
    every = block_matrix(placed.select("number", centred), n_rows, d, rows_per_block)
    projected = rows_of(product(every, weights), "values")
    named = placed.select("number", "vec_id", deviation.alias("deviation"))
    out = named.join(projected, "number").select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened"))
    shares = F.lit([float(e) for e in explained])
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
