"""Helpers for the vector operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def stacked(column) -> np.ndarray:
    """A column of equally long arrays as a matrix of doubles."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
