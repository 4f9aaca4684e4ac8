"""Embedding whitening with Spark MLlib's BlockMatrix.

Entries become whole numbers, x = floor(1024 * c) + 100000, so sums are exact.
Centred rows are indexed without gaps and dealt into distributed blocks; the
transpose times the blocks gives the scatter matrix, with the middle dimension
split so that no task meets all blocks of a row. Only that matrix (dimensions
squared) reaches the driver, where ``eigh`` decomposes it. The blocks times the
whitening matrix (unit eigenvectors over the root of their eigenvalues) are the
projected rows.

Cases: a vector that is null, or holds a null, a non-finite entry or one whose
x is not exact as a double (2^53 and above), is dropped; so is one that is
shorter than the longest that is left, its missing entries being null. Null
and repeated ids are rows like others. A component without variance (an
eigenvalue of at most ``FLAT`` of the largest) can't be whitened and has no
rows; nor have any when all vectors are equal, or the table is empty. A
deviation beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stage_table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
ROWS_PER_BLOCK = 4_096
#: Row blocks whose products one task adds up.
BLOCKS_PER_TASK = 16
#: Dimensions up to which the scatter matrix is sent to the driver (128 MB).
MAX_DIMENSIONS = 4_096
FLAT = 1e-12
EXACT = float(1 << 53)


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the vectors that are left, as entries of 64 bits."""
    scaled = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE))
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < EXACT - SHIFT))
    rows = vectors.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & sound)
    return rows.select("vec_id", F.transform(scaled, lambda x: x + F.lit(SHIFT)).alias("x"))


def indexed(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """The longest rows, numbered from 0 without gaps and staged; how many they are, and their dimensions.

    A task numbers its rows; the counts of the tasks before it are added when
    the table is read. There is one count a task, so they are broadcast.
    """
    local = rows.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", 33).alias("_part")
    table, sizes = stage_table(local, "whitening_rows", {"dim": F.max(F.size("x"))})
    d = sizes["dim"] or 0
    table = table.where(F.size("x") == d)
    # Numbers within a task may have gaps where shorter rows were; ranks close them.
    if not d:
        return table.where(F.lit(False)).withColumn("_index", F.col("_at")), 0, 0
    counts = table.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("_at").bitwiseAND((1 << 33) - 1)).alias("top"))
    order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("n").over(order), F.lit(0)))
    starts = stage_table(starts, "whitening_starts")[0]
    total = starts.agg(F.sum("n").alias("n"), F.max(F.col("top") + 1 - F.col("n")).alias("gaps")).first()
    placed = table.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(starts.select("_part", "_start")), "_part")
    seq = F.col("_at").bitwiseAND((1 << 33) - 1)
    if total["gaps"]:
        seq = F.row_number().over(Window.partitionBy("_part").orderBy("_at")) - 1
    return placed.select("vec_id", "x", (F.col("_start") + seq).alias("_index")), int(total["n"]), d


def sums(rows: DataFrame, d: int) -> list[int]:
    """The exact sum of every dimension."""
    cells = rows.select(F.posexplode("x").alias("dim", "value"))
    found = dict(cells.groupBy("dim").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect())
    return [int(found[k]) for k in range(d)]


def block_matrix(rows: DataFrame, column: str, n: int, d: int) -> BlockMatrix:
    """Blocks of the vectors in ``column``, numbered by ``_index``."""
    vectors = rows.select(F.col("_index").alias("index"), array_to_vector(column).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, d).toBlockMatrix(
        min(ROWS_PER_BLOCK, max(1, n)), d
    )


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, on the driver; its middle dimension is dealt over tasks."""
    tasks = max(1, -(-blocks.numRowBlocks // BLOCKS_PER_TASK))
    turned = blocks.transpose()
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, tasks)
    return BlockMatrix(product, turned.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def times(blocks: BlockMatrix, small: np.ndarray, spark) -> DataFrame:
    """_index and the row of the matrix times ``small``, whose rows are the matrix' columns."""
    one = ((0, 0), Matrices.dense(*small.shape, small.ravel("F").tolist()))
    right = BlockMatrix(spark.sparkContext.parallelize([one], 1), *small.shape)
    rows = blocks.multiply(right).toIndexedRowMatrix()
    table = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return table.select(F.col("index").alias("_index"), vector_to_array("vector").alias("whitened"))


@dataclass
class Whitening:
    """What was learned: sums, and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # dimensions x components
    values: np.ndarray
    trace: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def decompose(scattered: np.ndarray, n: int, total: list[int], components: int) -> Whitening:
    covariance = scattered / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > FLAT * max(values[0], 0.0)).sum())) if values[0] > 0 else 0
    return Whitening(n, total, vectors[:, :keep], values[:keep], float(np.trace(covariance)))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float]:
    """_index, vec_id, deviation and whitened array of every row left; the model; the identity error."""
    spark = vectors.sparkSession
    rows, n, d = indexed(whole_numbers(vectors))
    empty = spark.createDataFrame([], "_index long, vec_id long, deviation long, whitened array<double>")
    if not n:
        return empty, None, 0.0
    if d > MAX_DIMENSIONS:
        raise ValueError(f"{d} dimensions; the scatter matrix is made for at most {MAX_DIMENSIONS}")
    total = sums(rows, d)
    # n * x - S is a whole number: exact, and so is its square; centring divides it by n.
    spread = F.zip_with("x", F.lit(total).cast("array<bigint>"), lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(n).cast("bigint")), s))
    squares = F.aggregate("spread", F.lit(0).cast("bigint"), lambda acc, v: F.try_add(acc, F.try_multiply(v, v)))
    mean = [s / n for s in total]
    centred = F.zip_with("x", F.lit(mean).cast("array<double>"), lambda x, m: x - m)
    centred = F.zip_with("spread", centred, lambda v, c: F.coalesce(v / F.lit(n), c))
    rows = rows.withColumn("spread", spread).select(
        "_index", "vec_id", squares.alias("deviation"), centred.alias("centred")
    )
    rows = stage_table(rows, "whitening_centred")[0]
    blocks = block_matrix(rows, "centred", n, d)
    model = decompose(scatter(blocks), n, total, components)
    k = len(model.values)
    if not k:
        return empty, model, 0.0
    projected = stage_table(times(blocks, model.projection, spark), "whitening_projected")[0]
    means = projected.agg(*[F.avg(F.col("whitened")[j]).alias(str(j)) for j in range(k)]).first()
    left = F.zip_with("whitened", F.lit(list(means)).cast("array<double>"), lambda w, m: w - m)
    check = scatter(block_matrix(projected.select("_index", left.alias("left")), "left", n, k)) / n
    error = float(np.abs(check - np.eye(k)).max())
    return rows.select("_index", "vec_id", "deviation").join(projected, "_index"), model, error


def whitened_rows(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector left and component: the columns of the contract."""
    rows, model, error = whiten(vectors, components)
    explained = [] if model is None else (model.values / model.trace).tolist()
    n = 0 if model is None else model.n
    cells = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_k", "whitened"))
    share = F.element_at(F.lit(explained or [0.0]).cast("array<double>"), F.col("_k") + 1)
    return cells.select(
        "vec_id", (F.col("_k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"),
    )
