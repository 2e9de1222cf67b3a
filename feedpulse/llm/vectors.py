"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is not null, has only finite components, and one that isn't zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.col(vector)
    return F.coalesce(v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def as_doubles(vector: str) -> Column:
    return F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of numbers as the rows of a matrix; shorter ones are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    counts = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (counts == width).all():
        return flat.reshape(len(counts), width)
    out = np.zeros((len(counts), width))
    out[np.arange(width)[None, :] < counts[:, None]] = flat
    return out


def bounded_sample(rows: DataFrame, key: str, vector: str, size: int, width: int) -> np.ndarray:
    """Vectors of at most ``size`` rows, the first by a hash of their key."""
    chosen = rows.orderBy(F.xxhash64(key), key).select(vector).limit(size)
    return matrix(pa.array([r[0] for r in chosen.collect()], pa.list_(pa.float64())), width)
