"""Vector arithmetic on ARRAY<FLOAT> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when a vector has no length or the widths differ."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), norms))


def has_width(c: Column, width: int) -> Column:
    return F.size(c) == width
