"""Unions and differences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.operators.columns import tagged


def union_conformed(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, parts)


def union_tagged(parts: dict[str, DataFrame], tag: str, stamp: Column | None = None) -> DataFrame:
    """UNION ALL with the source's name in ``tag`` and, if given, one stamp for all rows."""
    out = union_conformed([tagged(df, **{tag: name}) for name, df in parts.items()])
    return out if stamp is None else out.withColumn("process_timestamp", stamp)


def unexpected_values(df: DataFrame, column: str, expected: Iterable[str]) -> DataFrame:
    """Distinct values that are not in the expected list; null is unexpected."""
    c = F.col(column)
    return df.where(c.isNull() | ~c.isin(*expected)).select(column).distinct()


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that do not occur in ``right``."""
    return left.subtract(right)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))
