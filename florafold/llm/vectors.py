"""Vector columns: which rows can be used, and Arrow list columns as matrices."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vec_col: str) -> Column:
    """Not null, not empty, and every entry a finite number."""
    v = F.col(vec_col)
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, entry), F.lit(False))


def common_dimension(vectors: DataFrame, vec_col: str) -> int:
    """The most frequent length of the vectors, the larger of equally frequent ones; 0 for no vectors. One row is read."""
    row = (vectors.groupBy(F.size(vec_col).alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .agg(F.max(F.struct("n", "d")).alias("top")).first())
    return row["top"]["d"] if row["top"] is not None else 0


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of a list column of equal lengths, without nulls."""
    flat = column.flatten() if isinstance(column, pa.Array) else pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)
