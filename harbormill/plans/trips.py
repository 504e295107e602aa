"""Trip metrics per pickup zone and a summary of pipeline runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harbormill.operators import exact


def trip_metrics(trips: DataFrame) -> DataFrame:
    """Trips (pickup_zip, fare) counted and averaged per zone; counts are bigint until published."""
    zones = exact.with_units(trips.where(F.col("pickup_zip").isNotNull()), {"fare": F.col("fare")})
    partial = zones.groupBy("pickup_zip", "_b_fare").agg(F.count(F.lit(1)).alias("_trips"), *exact.partial_sums("fare"))
    mean = F.try_divide(exact.total_of("fare"), F.sum("_n_fare").cast("double"))
    return partial.groupBy("pickup_zip").agg(F.sum("_trips").alias("trip_count"), F.coalesce(mean, F.lit(0.0)).alias("avg_fare"))


def pipeline_summary(outcomes: DataFrame) -> DataFrame:
    """Rows per pipeline with their status, from per-row outcomes (pipeline, ok)."""
    return outcomes.groupBy("pipeline").agg(
        F.when(F.coalesce(F.every("ok"), F.lit(False)), "success").otherwise("failed").alias("status"),
        F.count(F.lit(1)).alias("rows_processed"),
    )
