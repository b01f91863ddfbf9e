"""Vectors of a table as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """Whether a vector takes part: not null or empty, no null or non-finite component, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def dimensions(df: DataFrame, vector: str = "embedding") -> list[int]:
    """The lengths of the usable vectors, ascending: one per kind of embedding in the table."""
    return sorted(r["d"] for r in df.where(usable(vector)).select(F.size(vector).alias("d")).distinct().collect())


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of a list column, all of length ``d``, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, d))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), d)


def unpack(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of a binary column of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), d)


def pack(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows, dtype="<f8")], pa.binary())
