"""Embedding columns as numpy matrices inside tasks, and validity of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def usable(column: str) -> Column:
    """True for vectors that are not null and hold no null or non-finite component."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & ~F.coalesce(bad, F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column without nulls as doubles, padded with zeros to ``dims``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    cols = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, cols] = flat
    return out
