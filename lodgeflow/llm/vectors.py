"""Embedding tables as whole numbers: what the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector is not null and holds finite entries alone; each
    entry c becomes the long floor(256 * c), c as double."""
    vector = F.col("embedding").cast("array<double>")
    strange = F.exists(vector, lambda c: F.coalesce(
        c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(True)))
    return (embeddings.where(vector.isNotNull() & ~strange)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c).cast("long")).alias("x")))


def width(vectors: DataFrame) -> int:
    """The length of the longest ``x``; 0 for an empty table."""
    return vectors.agg(F.max(F.size("x"))).first()[0] or 0


def padded(vectors: DataFrame, dims: int) -> DataFrame:
    """``x`` of exactly ``dims`` entries: zeros follow a shorter vector."""
    return vectors.withColumn("x", F.concat("x", F.array_repeat(
        F.lit(0).cast("long"), F.greatest(F.lit(dims) - F.size("x"), F.lit(0)))))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths, none null, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of whole numbers: in doubles where every partial sum is below 2**53, else
    in 64-bit numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 2.0 ** 63:
        raise OverflowError("inner products of these vectors do not fit 64 bits")
    return a @ b.T
