"""Vectors of Arrow batches as numpy matrices."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def usable(vector: Column) -> Column:
    """Whether an array of numbers is not null, not zero and has only finite parts."""
    part = vector.cast("array<double>")
    finite = F.forall(part, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(part, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), -1)


def rotations(dim: int, count: int, seed: int) -> np.ndarray:
    """``count`` random orthogonal matrices of size ``dim``, stacked as rows."""
    rng = np.random.default_rng([seed, dim])
    blocks = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        blocks.append((q * np.sign(np.diag(r))).T)
    return np.vstack(blocks)
