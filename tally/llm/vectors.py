"""Vectors of Arrow list columns, and which of them take part in a comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """True where a vector has components, none of them null, NaN or infinite."""
    x = F.col(vector)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & sound, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long vectors as rows of doubles."""
    rows = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
