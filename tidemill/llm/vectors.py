"""Vector columns inside Arrow functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column whose rows all have ``width`` values, none null, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    offsets = np.arange(0, values.size + 1, max(values.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(values).reshape(-1))


def sound(vector: Column, width: int) -> Column:
    """Whether a vector has ``width`` components, none of them null, infinite or NaN. Never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) == width) & finite, F.lit(False))
