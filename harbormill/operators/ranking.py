"""Ordering, limits and bracket lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_first(df: DataFrame, column: str, ties: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """All rows, or the first ``limit``."""
    ordered = df.orderBy(F.col(column).desc(), *ties)
    return ordered if limit is None else ordered.limit(limit)


def ranked(df: DataFrame, column: str, ties: Sequence[str] = ()) -> DataFrame:
    """Descending rank list; ``ties`` make it deterministic."""
    return df.orderBy(F.col(column).desc(), *ties)


def first_or_null(df: DataFrame, order: Sequence[Column], request: dict[str, object]) -> DataFrame:
    """The first row, or one row of nulls that repeats the request.

    A global aggregate always returns exactly one row and needs no sort.
    """
    ranked_row = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*df.columns).alias("_row"))
    best = df.agg(F.max(ranked_row)["_row"].alias("_row"))
    cols = [F.col("_row")[c].alias(c) for c in df.columns]
    out = best.select(*cols)
    for name, value in request.items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))
    return out


def bracket_targets(df: DataFrame, low: str, high: str, targets: Sequence[float], name: str = "target") -> DataFrame:
    """One row per (bracket, target) with ``low < target <= high``.

    The targets are a short list given by the caller and travel as a literal
    array, so no join is needed.
    """
    hits = F.filter(
        F.array(*[F.lit(t) for t in targets]),
        lambda t: (t > F.col(low)) & (t <= F.col(high)),
    )
    return df.withColumn(name, F.explode(hits))
