"""Vector arithmetic on ``array`` columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; the cosine when both vectors have unit length."""
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    squares = F.transform(as_double(a), lambda x: x * x)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when a vector has no direction."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def l2_normalize(a: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    length = norm(a)
    return F.when(length > 0, F.transform(as_double(a), lambda x: x / length)).otherwise(as_double(a))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """An Arrow list column as a dense ``n x d`` matrix."""
    n = len(column)
    if n == 0:
        return np.empty((0, 0))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(n, -1)


def list_array(rows: np.ndarray) -> pa.ListArray:
    """The inverse of :func:`matrix`."""
    n, d = rows.shape
    offsets = np.arange(0, (n + 1) * d, d, dtype=np.int32) if d else np.zeros(n + 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))
