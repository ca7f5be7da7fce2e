"""Embedding rows as integer vectors, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a component is multiplied with before it is rounded down.
SCALE = 256


def usable(vector: str) -> Column:
    """Whether a vector and all of its components are there and finite."""
    finite = f"forall(`{vector}`, c -> coalesce(abs(c) < double('infinity') AND NOT isnan(c), false))"
    return F.expr(f"`{vector}` IS NOT NULL AND {finite}")


def integer_vector(vector: str) -> Column:
    """Each component c as the long floor(256 * c), c as double; beyond long an error is raised."""
    return F.expr(f"transform(`{vector}`, c -> CAST(floor({SCALE}D * CAST(c AS DOUBLE)) AS BIGINT))")


def one_size(frame: DataFrame, vector: str = "x") -> int | None:
    """The length that all vectors have, None for an empty table."""
    sizes = frame.select(F.size(vector).alias("n")).agg(F.min("n"), F.max("n")).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} and of {sizes[1]} components in one table")
    return sizes[0]


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column without nulls as int64 rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def largest(values: np.ndarray) -> int:
    """The largest absolute value, as a Python integer (the least int64 has no absolute one)."""
    return max(int(values.max()), -int(values.min())) if values.size else 0
