"""Window operators.

They run on grouped rows (one per key and period), so a window partition holds
the periods of a key and not its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harbormill.functions.numeric import divide


def pct_change(df: DataFrame, keys: Sequence[str], order: str, columns: dict[str, str]) -> DataFrame:
    """Relative change to the previous row of the key, after filling nulls forward.

    [1, null, 2, 0, 3] gives [null, 0, 1, -1, inf]. Input: one row per key and
    ``order`` value. ``columns`` maps the new column to its source.
    """
    ordered = Window.partitionBy(*keys).orderBy(order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for name, source in columns.items():
        current = F.last(source, ignorenulls=True).over(upto)
        previous = F.last(source, ignorenulls=True).over(before)
        out[name] = divide(current, previous) - 1
    return df.withColumns(out)


def next_tier(df: DataFrame, keys: Sequence[str], lower: str, upper: str) -> DataFrame:
    """The lower bound of the following tier becomes the upper bound of this one."""
    w = Window.partitionBy(*keys).orderBy(lower)
    return df.withColumn(upper, F.lead(lower).over(w))


def first_seen(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order.

    Rows are compared by the order columns and then by all others, so the
    outcome does not depend on how the input is partitioned. The rank limit is applied
    before the shuffle too: each task sends one row per key, however often it occurs.
    """
    return _one_per_key(df, [key], [c.asc_nulls_first() for c in order], [F.col(c).asc_nulls_first() for c in df.columns])


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last row of every key in the given order, ties by all columns."""
    return _one_per_key(df, key, [c.desc_nulls_last() for c in order], [F.col(c).desc_nulls_last() for c in df.columns])
