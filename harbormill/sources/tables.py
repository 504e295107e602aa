"""Table sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_filtered(spark: SparkSession, name: str, columns: Sequence[str], predicate: Column) -> DataFrame:
    """Column list and predicate, both of which reach the scan."""
    return spark.table(name).where(predicate).select(*columns)


def read_jdbc_filtered(
    spark: SparkSession, url: str, table: str, columns: Sequence[str], predicate: Column, **options: str
) -> DataFrame:
    """The same against a remote store; Spark pushes both into the query it sends.

    Give partitionColumn, lowerBound, upperBound and numPartitions among the
    options to read a large table in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**options).load().where(predicate).select(*columns)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows given in code; fields declared NOT NULL are checked."""
    return spark.createDataFrame(list(rows), schema, verifySchema=True)


def sample_model(
    df: DataFrame, method: str, rows: int | None = None, fraction: float | None = None, seed: int = 7
) -> DataFrame:
    """Preview by a model's sampling hint: the first ``rows`` or a random ``fraction``, which the caller names."""
    if method == "head" and rows is not None:
        return df.limit(rows)
    if method == "random" and fraction is not None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    raise ValueError(f"unknown sampling {method!r}, or its size is missing")
