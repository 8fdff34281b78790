"""Embedding columns in tasks, shared by the operators on vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there, and all its components are finite numbers."""
    inside = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(inside, F.lit(False))  # NaN counts as larger than any number


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and double matrix of the vectors of each length, of a
    column without nulls."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows][:, None] + np.arange(size)]


def packed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    data, width = np.ascontiguousarray(rows).tobytes(), rows.shape[1] * rows.itemsize
    return pa.array([data[i * width:(i + 1) * width] for i in range(len(rows))], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """The matrix of binary values of one width."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)
