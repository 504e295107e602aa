"""Grouped aggregation patterns. All of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.functions.numeric import ratio
from harbormill.operators.exact import exact_totals


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; 0, not null, for an empty group."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def share_where(condition: Column, scale: int = 4) -> Column:
    return ratio(count_where(condition), F.count(F.lit(1)), scale)


def cost_per(total: Column, count: Column, scale: int = 2) -> Column:
    """Total per counted item; 0 when nothing was counted."""
    return ratio(total, count, scale)


# Decimals that a sum in one pass keeps: all 17 digits of a double from 1 on.
SUM_SCALE = 16


def exact_sum(c: Column, scale: int = SUM_SCALE) -> Column:
    """Sum that does not depend on row order, as double, in the one pass of its group.

    Decimals beyond ``scale`` are rounded, and a sum of more than 22 whole digits fails; ``exact.exact_totals`` has neither limit.
    """
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double")


def exact_mean(c: Column, scale: int = SUM_SCALE) -> Column:
    """Mean that does not depend on row order, as double; null for an empty group."""
    return F.try_divide(exact_sum(c, scale), F.count(c).cast("double"))


def pivot_by_type(
    df: DataFrame, keys: Sequence[str], kind: str, value: str, columns: dict[str, str], dtype: str
) -> DataFrame:
    """One column per listed kind with the greatest value of that kind."""
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(kind) == label, F.col(value)).try_cast(dtype)).alias(name)
            for name, label in columns.items()
        ]
    )


def pivot_mean(df: DataFrame, keys: Sequence[str], metric: str, value: str, metrics: Sequence[str]) -> DataFrame:
    """Long to wide; duplicates give their mean, rows without any value are dropped."""
    listed = df.where(F.col(metric).isin(*metrics))
    # groups of a few rows each: one pass over decimals, rather than bands that are put together per group
    wide = listed.groupBy(*keys).agg(*[exact_mean(F.when(F.col(metric) == m, F.col(value))).alias(m) for m in metrics])
    return wide.dropna(how="all", subset=list(metrics))


def year_end_last(df: DataFrame, key: str, date: str, value: str, one_per_date: bool = False) -> DataFrame:
    """Last non-null value of every year, dated 31 December; a year of nulls stays as null.

    Of several values on one date the greatest counts. ``one_per_date`` states
    that there is never more than one and saves a grouping.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(key, date, value)
    if not one_per_date:
        rows = rows.groupBy(key, date).agg(F.max(value).alias(value))
    # plain value and ordering types keep this in a hash aggregate
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(date)))
    yearly = rows.groupBy(key, F.year(date).alias("_year")).agg(last.alias(value))
    return yearly.select(key, F.make_date("_year", F.lit(12), F.lit(31)).cast("timestamp_ntz").alias(date), value)


def yearly_sum(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Sum per key and calendar year; nulls count as 0 and null keys are dropped."""
    rows = df.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(key, F.year(date).alias("year"), F.col(value).alias("_v"))
    totals = exact_totals(rows, [key, "year"], {"_total": F.col("_v")})
    return totals.select(key, "year", F.coalesce("_total", F.lit(0.0)).alias(value))


def tier_brackets(df: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """Collapse the tiers of a group to one bracket from the lowest to the highest bound."""
    return df.groupBy(*keys).agg(F.min(low).alias(low), F.max(high).alias(high))


def best_rate(df: DataFrame, keys: Sequence[str], rate: str, lowest: bool = False) -> DataFrame:
    """Highest (deposits) or lowest (loans) rate per group."""
    pick = F.min if lowest else F.max
    return df.groupBy(*keys).agg(pick(rate).alias(rate))


def value_set(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
