"""Joins that stay balanced when one key holds a large share of the rows.

The fact side is aggregated by the join key before it meets the dimension, so a
hot key is already folded by the map-side combine when the shuffle starts. Where
whole fact rows have to be joined, adaptive execution splits the hot partition.
No side is broadcast by hint: Spark does so itself when the size it measured is
below its threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


OTHER = "_other_"


def renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns under a prefix, so that a side derived from the other stays distinguishable."""
    return df.withColumnsRenamed({k: OTHER + k for k in keys})


def same_keys(keys: Sequence[str]) -> Column:
    """Equality with the renamed keys of the other side, where null equals null."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(OTHER + k)) for k in keys])


def enrich_with_totals(
    dimension: DataFrame,
    facts: DataFrame,
    key: str,
    totals: Mapping[str, Column],
    fill: Mapping[str, object],
) -> DataFrame:
    """LEFT join of per-key totals to a dimension; missing totals get their fill value."""
    per_key = facts.groupBy(key).agg(*[c.alias(name) for name, c in totals.items()])
    joined = dimension.join(per_key, key, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in fill.items()})


def convert_by_date(facts: DataFrame, rates: DataFrame, date: str, amount: str, rate: str, out: str) -> DataFrame:
    """Multiply by the rate of the exact date; dates without a rate give null."""
    daily = rates.select(F.col(date), F.col(rate))
    return facts.join(daily, date, "left").withColumn(out, F.round(F.col(amount) * F.col(rate), 2)).drop(rate)


def orphan_count(facts: DataFrame, dimension: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """One row: total facts and facts whose key has no parent (a null key has none)."""
    parents = dimension.select(F.col(parent_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    found = per_key.join(parents.withColumn("known", F.lit(True)), key, "left")
    return found.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("rows"))), F.lit(0)).alias("orphans"),
    )


def children_of(parents: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """One row: how many of ``parents`` have facts, and how many facts those are."""
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    hit = parents.select(key).distinct().join(per_key, key)
    return hit.agg(
        F.count(F.lit(1)).alias("parents"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("children"),
    )


def map_codes(c: Column, codes: Mapping[str, str]) -> Column:
    """Replace listed codes; others stay as they are."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    return F.coalesce(F.try_element_at(table, c), c)


def not_yet_done(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among those already processed."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def repeated_keys(dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: keys that stand with differing values of ``columns``; rows that repeat each other are one."""
    told_apart = F.xxhash64(*columns) if columns else F.lit(0)
    per_key = dimension.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(told_apart).alias("lo"), F.max(told_apart).alias("hi"))
    return per_key.where("lo <> hi").agg(F.count(F.lit(1)).alias("repeated_keys"))


def one_row_per_key(dimension: DataFrame, key: str, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Dimension reduced to one row per key, so that joining it cannot multiply facts.

    A key that stands with differing values fails the job: no row of them is picked. That is counted over the whole dimension by a
    subquery of its own, so ``where``, on the key and the columns, still reaches the scan.
    """
    wanted = [c for c in columns if c != key]
    rows = dimension.where(F.col(key).isNotNull())
    once = (rows if where is None else rows.where(where)).select(key, *wanted).distinct()
    if not wanted:
        return once
    repeated = repeated_keys(dimension, key, wanted).scalar()
    message = F.concat(repeated.cast("string"), F.lit(f" values of {key} stand with differing {', '.join(wanted)}"))
    return once.where(F.when(repeated > 0, F.raise_error(message).cast("boolean")).otherwise(True))
