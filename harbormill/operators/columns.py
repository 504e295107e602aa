"""Projection operators: conforming, filling, melting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.models import Model


def conform(df: DataFrame, model: Model, safe: bool = False) -> DataFrame:
    """Select the model's columns in its order and cast them.

    ``safe`` turns values that do not fit (such as a decimal overflow) into
    nulls instead of failing the job; pair it with a null-share check.
    """
    out = []
    for field in model.schema.fields:
        c = F.col(f"`{field.name}`")
        c = c.try_cast(field.dataType) if safe else c.cast(field.dataType)
        out.append(c.alias(field.name, metadata=field.metadata))
    return df.select(*out)


def conform_fill(df: DataFrame, model: Model, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, add the model's missing columns as nulls, and order them."""
    renamed = df.withColumnsRenamed(dict(renames or {}))
    present = set(renamed.columns)
    return renamed.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in model.schema.fields
        ]
    )


def cast_columns(df: DataFrame, casts: Mapping[str, str] | None = None) -> DataFrame:
    """Apply a per-column cast map; without one, zoned timestamps lose their zone."""
    if casts:
        return df.select(*[F.col(c).cast(t).alias(c) for c, t in casts.items()])
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


def tagged(df: DataFrame, **constants: object) -> DataFrame:
    """Add provenance columns with one constant value each."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def melt(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    name: str = "metric",
    value: str = "value",
) -> DataFrame:
    """Wide to long: one row per (input row, melted column)."""
    return df.unpivot(list(ids), list(columns), name, value)


def stack_prices(
    df: DataFrame,
    date: str,
    tickers: Sequence[str],
    measures: Mapping[str, str],
    separator: str = "_",
) -> DataFrame:
    """Wide panel ``<measure>_<ticker>`` to one row per (date, ticker) with a column per measure."""
    per_ticker = F.array(
        *[
            F.struct(
                F.lit(t).alias("symbol"),
                *[F.col(f"`{m}{separator}{t}`").alias(out) for m, out in measures.items()],
            )
            for t in tickers
        ]
    )
    return df.select(F.col(date).alias("date"), F.inline(per_ticker)).select("symbol", "date", *measures.values())


def mask_column(df: DataFrame, column: str, hidden: Column, token: str = "*****") -> DataFrame:
    """Replace the value by a token where ``hidden`` holds."""
    return df.withColumn(column, F.when(hidden, F.lit(token)).otherwise(F.col(column).cast("string")))


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly over two tasks a core, for slow work on rows that come from few or unequal files; a Python task has
    some costs of its own, so there are no more."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
