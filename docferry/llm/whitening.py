"""Whitening of embeddings with MLlib's BlockMatrix.

Entries become integers, so that counts and sums are exact and equal vectors are recognised. The fit list has every vector
once. Its rows, centred, are indexed into a BlockMatrix; its transpose times itself, the middle dimension split over many
tasks, is the scatter matrix, as many rows and columns as a vector has entries. Its eigenvectors are found on the
driver (numpy.linalg.eigh), and a second BlockMatrix product with the whitening matrix projects all rows. The projected
fit list is centred and multiplied with its transpose again, which tells how far the result is from the identity.

Centring comes before any product: an entry of a row is (n * x - S) / n, whose numerator is exact in 64 bits.

Defined results: vectors that are null or hold null or non-finite entries give no rows; shorter vectors are filled up with zeros;
repeated rows and null ids give rows of their own, and count once in the fit. Components whose eigenvalue is zero to double
precision cannot be whitened and are left out (all of them, if all vectors are equal); no usable vector, no rows.
Entries or deviations beyond 64 bits are an error. Other columns of the input do not matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm.common import shuffle_partitions
from docferry.session import written

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Rows of a block.
BLOCK_ROWS = 4096

RESULT = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: int, offset: int) -> DataFrame:
    """vec_id and x, the integer entries of the vectors that take part."""
    c = F.col(f"`{vector}`").cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    whole = lambda v: F.floor(v * F.lit(float(scale))).cast("long") + F.lit(offset).cast("long")
    return df.where(c.isNotNull() & F.forall(c, finite)).select(F.col(f"`{vec_id}`").alias("vec_id"), F.transform(c, whole).alias("x"))


def _filled(rows: DataFrame, dim: int, fill: int) -> DataFrame:
    more = F.array_repeat(F.lit(fill).cast("long"), F.lit(dim) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") < dim, F.concat("x", more)).otherwise(F.col("x")))


def _numbered(rows: DataFrame, label: str) -> DataFrame:
    """The rows with a dense ``index`` from 0: their place in a written table, its files one after the other."""
    table, path = written(rows, label)
    at = table.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = at.groupBy("_file").agg(F.count("*").alias("n")).orderBy("_file").toArrow()
    before = np.concatenate([[0], np.cumsum(counts.column("n").to_numpy())[:-1]]).astype(int).tolist() if counts.num_rows else []
    # a row per file of the table
    offsets = rows.sparkSession.createDataFrame(list(zip(counts.column("_file").to_pylist(), before, strict=True)), "_file string, _before long")
    return at.join(F.broadcast(offsets), "_file").withColumn("index", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def _centred(sums: list[int], n: int) -> tuple[Column, Column]:
    """n * x - S, exact, and the same divided by n as a vector."""
    total = F.array(*(F.lit(s).cast("long") for s in sums))
    exact = F.zip_with("x", total, lambda x, s: x * F.lit(n).cast("long") - s)
    return exact, array_to_vector(F.transform(exact, lambda v: v.cast("double") / F.lit(float(n))))


def block_matrix(df: DataFrame, index: str, vector: str, dim: int) -> BlockMatrix:
    """Rows as blocks of BLOCK_ROWS rows and all columns."""
    rows = MLUtils.convertVectorColumnsFromML(df.select(F.col(index).alias("index"), F.col(vector).alias("vector")), "vector")
    return IndexedRowMatrix(rows, 0, dim).toBlockMatrix(BLOCK_ROWS, dim)


def scatter(spark: SparkSession, a: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix; rows are split over as many tasks as there are shuffle partitions."""
    splits = max(1, min(shuffle_partitions(spark), a.numRowBlocks))
    flipped, own = a.transpose(), a
    product = flipped._java_matrix_wrapper.call("multiply", own._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, own.colsPerBlock, own.colsPerBlock).toLocalMatrix().toArray()


def project(spark: SparkSession, a: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """index and y (array): the rows times the weights."""
    whole = Matrices.dense(*weights.shape, weights.ravel(order="F"))
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), whole)], 1), *weights.shape)
    rows = a.multiply(right).toIndexedRowMatrix()
    listed = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return listed.select("index", vector_to_array("vector").alias("y"))


@dataclass(frozen=True)
class Whitening:
    """What the fit list gave: vectors are centred at sums / n and multiplied with ``weights``."""

    n: int
    sums: list[int]
    weights: np.ndarray  # a column per component
    explained: list[float]


def components(covariance: np.ndarray, n: int, sums: list[int], k: int) -> Whitening:
    """The first k components that have variance."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    usable = values > len(values) * np.finfo(float).eps * max(values[0], 0.0)
    kept = min(k, int(usable.sum()))
    return Whitening(n, sums, vectors[:, :kept] / np.sqrt(values[:kept]), (values[:kept] / np.trace(covariance)).tolist() if kept else [])


def whiten(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for every usable row and component."""
    spark = df.sparkSession
    rows = integer_vectors(df, vec_id, vector, scale, offset)
    kind = dict(rows.dtypes)["vec_id"]
    empty = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dim = rows.agg(F.max(F.size("x"))).first()[0]
    if not dim:
        return spark.createDataFrame([], empty)
    rows = _numbered(_filled(rows, dim, offset), "whitening-rows")
    fit = _numbered(rows.select("x").distinct(), "whitening-fit")
    per_entry = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s"), F.count("*").alias("n")).orderBy("i").collect()
    sums, n = [r.s for r in per_entry], per_entry[0].n

    exact, centred = _centred(sums, n)
    fitted = block_matrix(fit.withColumn("y", centred), "index", "y", dim)
    model = components(scatter(spark, fitted) / n, n, sums, k)
    kept = len(model.explained)
    if not kept:
        return spark.createDataFrame([], empty)

    # the projected fit list, centred once more, against the identity
    check, _ = written(project(spark, fitted, model.weights), "whitening-check")
    means = check.select([F.avg(F.col("y")[i]) for i in range(kept)]).first()
    again = array_to_vector(F.zip_with("y", F.array(*map(F.lit, means)), lambda y, m: y - m))
    rest = scatter(spark, block_matrix(check.withColumn("z", again), "index", "z", kept)) / n
    error = float(np.abs(rest - np.eye(kept)).max())

    deviation = F.aggregate(exact, F.lit(0).cast("long"), lambda a, v: a + v * v)
    projected = project(spark, block_matrix(rows.withColumn("y", centred), "index", "y", dim), model.weights)
    joined = rows.select("index", "vec_id", deviation.alias("deviation")).join(projected, "index")
    spread = joined.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened"))
    share = F.element_at(F.array(*map(F.lit, model.explained)), F.col("component"))
    out = spread.withColumn("component", F.col("at") + 1).withColumn("explained", share)
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
