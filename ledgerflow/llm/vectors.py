"""Embedding columns: which vectors take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as a matrix of doubles."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(column), -1)


def by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of list in the column."""
    lengths = np.diff(column.offsets.to_numpy())
    return [(at, matrix(column.take(pa.array(at))))
            for at in (np.flatnonzero(lengths == n) for n in np.unique(lengths))]
