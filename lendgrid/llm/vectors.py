"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component."""
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def nonzero(v: Column) -> Column:
    return F.exists(v, lambda x: x != 0)


def matrix(column: pa.ListArray, dtype=np.float64) -> np.ndarray:
    """A list column whose rows have one length -> a 2-d array."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
