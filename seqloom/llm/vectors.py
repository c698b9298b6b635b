"""Embedding columns as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(embedding: Column) -> Column:
    """Whether a vector is not null or empty and all its components are finite numbers."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.when(F.size(embedding) > 0, fine), F.lit(False))


def width(vectors: DataFrame, column: str) -> int:
    """The largest number of components; shorter vectors count as if filled up with zeros."""
    return vectors.agg(F.max(F.size(column))).first()[0] or 1


def matrix(column: pa.ListArray, columns: int, kind: type = np.float64) -> np.ndarray:
    """Rows of a list column without nulls, filled up with zeros."""
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == columns).all():
        return flat.reshape(-1, columns).astype(kind)
    out = np.zeros((len(lengths), columns), kind)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def unpack(blobs: pa.Array | pa.ChunkedArray, columns: int, kind: str) -> np.ndarray:
    """Rows of a binary column that holds one packed vector each."""
    return np.frombuffer(b"".join(blobs.to_pylist()), kind).reshape(-1, columns)


def packed(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * size).astype(np.int32)), pa.py_buffer(rows)])


Batches = Iterator[pa.RecordBatch]
