"""Interval self-comparison without a self-join.

A row is in conflict when another row of the same key, at most ``seconds`` away,
has a different value. Time is cut into slices exactly ``seconds`` wide. For a
row in slice b the whole of slice b is in reach, and of its neighbours a
suffix of b-1 and a prefix of b+1. So it is enough to know, per (key, slice),
the two values seen latest and the two seen earliest: if the latest value equals
the row's own, the runner-up decides.

Those summaries come from grouped minima and maxima with map-side combine, and
rows meet them in an equi-join that adaptive execution can split. No task ever
holds all rows of a key, nor all rows of a (key, slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harbormill.functions.temporal import epoch_micros
from harbormill.operators.joins import renamed_keys, same_keys


def _neighbour_summary(values: DataFrame) -> DataFrame:
    """One row per (key, slice): what its rows need to know of their surroundings.

    ``values`` has one row per (key, slice, value). Every slice ranks its values
    from the latest and from the earliest, keeps two of each, and sends the
    former to the next slice and the latter to the previous one. A runner-up
    also tells the slice itself that it holds more than one value.
    """
    directed = values.select(
        "_key",
        "_slice",
        "_value",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("_way"), (-F.col("_latest")).alias("_order"), F.col("_latest").alias("_time")),
                F.struct(F.lit(-1).alias("_way"), F.col("_first").alias("_order"), F.col("_first").alias("_time")),
            )
        ),
    )
    w = Window.partitionBy("_key", "_slice", "_way").orderBy("_order", "_value")
    # Spark applies this limit before the shuffle too, so tasks send two rows per group
    leading = directed.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= 2)

    to_neighbour = F.struct((F.col("_slice") + F.col("_way")).alias("_slice"), F.col("_way"))
    to_itself = F.struct(F.col("_slice"), F.lit(0).alias("_way"))
    receivers = F.when(
        (F.col("_way") == 1) & (F.col("_rank") == 2), F.array(to_neighbour, to_itself)
    ).otherwise(F.array(to_neighbour))
    sent = leading.select("_key", "_value", "_time", "_rank", F.inline(receivers))

    def received(way: int, rank: int, column: str) -> Column:
        return F.max(F.when((F.col("_way") == way) & (F.col("_rank") == rank), F.col(column)))

    return sent.groupBy("_key", "_slice").agg(
        received(1, 1, "_value").alias("before_value"),
        received(1, 1, "_time").alias("before_time"),
        received(1, 2, "_time").alias("before_other_time"),
        received(-1, 1, "_value").alias("after_value"),
        received(-1, 1, "_time").alias("after_time"),
        received(-1, 2, "_time").alias("after_other_time"),
        (F.max(F.when(F.col("_way") == 0, 1)).isNotNull()).alias("mixed"),
    )


def conflicts_within(df: DataFrame, key: str, time: str, value: str, seconds: int = 3600) -> DataFrame:
    """Rows of ``df`` with a different ``value`` of the same key within ``seconds`` (inclusive).

    A null value differs from every other value, and null keys form one group.
    """
    reach = seconds * 1_000_000
    micros = epoch_micros(F.col(time))
    rows = df.where(F.col(time).isNotNull()).withColumns(
        {
            "_micros": micros,
            "_slice": F.floor(micros / F.lit(reach)),
            "_key": F.col(key),
            # a prefix keeps the empty text apart from null
            "_value": F.coalesce(F.concat(F.lit("="), F.col(value).cast("string")), F.lit("")),
        }
    )
    values = rows.groupBy("_key", "_slice", "_value").agg(
        F.min("_micros").alias("_first"), F.max("_micros").alias("_latest")
    )
    latest_other = F.when(F.col("before_value") == F.col("_value"), F.col("before_other_time")).otherwise(
        F.col("before_time")
    )
    earliest_other = F.when(F.col("after_value") == F.col("_value"), F.col("after_other_time")).otherwise(
        F.col("after_time")
    )
    in_conflict = (
        F.col("mixed")
        | (latest_other >= F.col("_micros") - reach)
        | (earliest_other <= F.col("_micros") + reach)
    )
    place = ["_key", "_slice"]
    summary = renamed_keys(_neighbour_summary(values), place)
    return rows.join(summary, same_keys(place)).where(in_conflict).select(*df.columns)
