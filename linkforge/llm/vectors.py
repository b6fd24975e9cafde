"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(v: Column) -> Column:
    """Whether v is an array without null, NaN or infinite components."""
    return v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def by_dimension(vectors: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, double matrix) for every dimension that occurs."""
    at = vectors.offsets.to_numpy()
    flat, size = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64), np.diff(at)
    out = []
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        out.append((rows, flat[(at[rows][:, None] + np.arange(d)).ravel()].reshape(len(rows), d)))
    return out
