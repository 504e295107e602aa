"""As-of join: for every left row the latest right row at or before its time.

Plan. Both sides are cut into time slices. One window per (key, slice) finds the
latest right row inside the slice; the last right row of each slice, one row per
(key, slice), is carried forward to the slices after it. A key that holds most of the
data is thus spread over its slices instead of landing in one task, and left rows are
shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harbormill.functions.temporal import epoch_seconds
from harbormill.operators.windows import latest_by
from harbormill.session import checkpointed

DAY = 86_400
SLICE_ROWS = 1_000_000


def measured_slice(df: DataFrame, by: Sequence[str], on: str, rows: int = SLICE_ROWS) -> int:
    """A slice width in seconds that gives the densest (key, hour) about ``rows`` rows, an hour at most."""
    hour = F.floor(epoch_seconds(F.col(on)) / 3600)
    densest = df.groupBy(*by, hour.alias("_hour")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).head()[0] or 1
    return max(1, 3600 // math.ceil(densest / rows))


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, slice_seconds: int = DAY) -> DataFrame:
    """All left rows with the right columns of the latest match (null without one).

    Of several right rows with one (key, time) the greatest wins. Null keys and times match nothing, and their
    rows go around the windows. ``slice_seconds`` bounds what one task sorts: see ``measured_slice``.
    """
    by = list(by)
    payload = [c for c in right.columns if c not in (*by, on)]
    extra = [c for c in left.columns if c not in (*by, on)]
    known = reduce(and_, [F.col(c).isNotNull() for c in (*by, on)])
    time_slice = F.floor(epoch_seconds(F.col(on)) / slice_seconds).alias("_slice")

    matches = right.where(known).select(*by, on, time_slice, F.struct(*payload).alias("_hit"))
    asked = left.where(known).select(*by, on, time_slice, F.struct(F.lit(True).alias("_is"), *extra).alias("_own"))
    both = asked.unionByName(matches, allowMissingColumns=True)

    # right rows sort before left rows of the same time, the greatest last: an exact match counts
    in_slice = (
        Window.partitionBy(*by, "_slice")
        .orderBy(F.col(on), F.col("_own").isNotNull(), F.col("_hit"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    within = both.withColumn("_found", F.last("_hit", ignorenulls=True).over(in_slice)).where(F.col("_own").isNotNull())

    # what a slice hands on is its last right row; each task sends one row per slice, for slices that only ask as well
    hit_type = matches.schema["_hit"].dataType
    asks = asked.select(*by, "_slice", F.lit(None).cast(right.schema[on].dataType).alias(on), F.lit(None).cast(hit_type).alias("_hit"))
    per_slice = latest_by(matches.select(*by, "_slice", on, "_hit").unionByName(asks), [*by, "_slice"], [F.col(on), F.col("_hit")])
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(*by, "_slice", F.last("_hit", ignorenulls=True).over(earlier).alias("_carry")).where(
        F.col("_carry").isNotNull()
    )
    answered = within.join(carried, [*by, "_slice"], "left").withColumn("_found", F.coalesce("_found", "_carry"))
    out = answered.select(
        *by, on, *[F.col("_own")[c].alias(c) for c in extra], *[F.col("_found")[c].alias(c) for c in payload]
    )
    columns = [*left.columns, *payload]
    aside = left.where(~known).select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in payload])
    return out.select(*columns).unionByName(aside)


def asof_scan(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, partitions: int | None = None) -> DataFrame:
    """The same join as a distributed prefix scan, for keys that are dense in time: no window holds a key, or a slice of one.

    Rows of both sides are dealt into ``partitions`` (by default the session's number) ranges of (key, time, row), so rows of one key
    are spread over as many ranges as their number asks for, even if all lie at one instant. A window inside each range finds matches
    there. A second pass over one row for each range carries the last right row on to the ranges behind it.

    The ranges are written to the session's checkpoint folder first: both passes must see the same ones.
    """
    by = list(by)
    payload = [c for c in right.columns if c not in (*by, on)]
    extra = [c for c in left.columns if c not in (*by, on)]
    known = reduce(and_, [F.col(c).isNotNull() for c in (*by, on)])
    partitions = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    matches = right.where(known).select(*by, on, F.struct(*payload).alias("_hit"))
    asked = left.where(known).select(*by, on, F.struct(F.lit(True).alias("_is"), *extra).alias("_own"))
    both = asked.unionByName(matches, allowMissingColumns=True)
    # right rows before left rows of the same time, the greatest last; left rows of one time lie in the order of their hash
    order = [F.col(on), F.col("_own").isNotNull(), F.col("_hit")]
    ranged = both.repartitionByRange(partitions, *by, *order, F.xxhash64("_own"))
    placed = checkpointed(ranged.withColumn("_range", F.spark_partition_id()))

    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumn("_found", F.last("_hit", ignorenulls=True).over(inside)).where(F.col("_own").isNotNull())

    # the greatest (key, time, row) of each range, and then of all ranges before: one row a range
    last = F.max(F.when(F.col("_hit").isNotNull(), F.struct(*by, on, "_hit")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy("_range").agg(last.alias("_last")).select("_range", F.max("_last").over(before).alias("_carry"))

    same = reduce(and_, [F.col("_carry")[c] == F.col(c) for c in by])
    answered = within.join(carried, "_range").withColumn("_found", F.coalesce("_found", F.when(same, F.col("_carry")["_hit"])))
    out = answered.select(*by, on, *[F.col("_own")[c].alias(c) for c in extra], *[F.col("_found")[c].alias(c) for c in payload])
    aside = left.where(~known).select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in payload])
    return out.select(*left.columns, *payload).unionByName(aside)
