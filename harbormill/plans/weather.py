"""Weather readings of two providers in one model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.functions.temporal import utc_timestamp
from harbormill.models import catalog
from harbormill.operators.columns import conform
from harbormill.operators.sets import union_tagged

# The parts of each provider's response that are used.
FIRST_PROVIDER = "open-meteo"
SECOND_PROVIDER = "wttr.in"
FIRST_JSON = (
    "current struct<time:string,temperature_2m:double,relative_humidity_2m:double,wind_speed_10m:double>"
)
SECOND_JSON = "current_condition array<struct<temp_C:string,humidity:string,windspeedKmph:string>>"


def first_provider(landed: DataFrame, body: str = "value") -> DataFrame:
    """Landed responses (city, JSON text) whose reading carries its own time."""
    parsed = landed.select("city", F.from_json(body, FIRST_JSON)["current"].alias("c"))
    return conform(
        parsed.select(
            "city",
            utc_timestamp(F.col("c.time")).alias("timestamp"),
            F.col("c.temperature_2m").alias("temperature_c"),
            F.col("c.relative_humidity_2m").alias("humidity_pct"),
            F.col("c.wind_speed_10m").alias("wind_speed_kmh"),
        ),
        catalog.OPEN_METEO,
    )


def second_provider(landed: DataFrame, loaded_at: Column, body: str = "value") -> DataFrame:
    """Landed responses (city, JSON text) with numbers as text; stamped with the load time."""
    reading = F.get(F.from_json(body, SECOND_JSON)["current_condition"], F.lit(0))
    parsed = landed.select("city", loaded_at.alias("timestamp"), reading.alias("c"))
    return conform(
        parsed.select(
            "city",
            "timestamp",
            F.col("c.temp_C").alias("temperature_c"),
            F.col("c.humidity").alias("humidity_pct"),
            F.col("c.windspeedKmph").alias("wind_speed_kmh"),
        ),
        catalog.WTTR,
    )


def unified_weather(first: DataFrame, second: DataFrame, processed_at: Column) -> DataFrame:
    both = union_tagged({FIRST_PROVIDER: first, SECOND_PROVIDER: second}, "provider", processed_at)
    return conform(both, catalog.UNIFIED_WEATHER)
