"""Business rules of the CRM products as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from harbormill.functions.numeric import ratio

# Labels and thresholds of the coverage rule.
UNDER_SERVED = "Under-served high-value"
WELL_SERVED = "Well-served high-value"
OVER_SERVED = "Over-served low-value"
ADEQUATE = "Adequate"
LOW_REALIZATION = "0.25"


def realization_ratio(actual: Column, potential: Column) -> Column:
    return ratio(actual, potential, 4, "half_even")


def positive_rate(positives: Column, touches: Column) -> Column:
    return ratio(positives, touches, 4, "half_even")


def coverage_flag(
    tier: Column,
    potential: Column,
    actual: Column,
    touches: Column,
    positives: Column,
    negatives: Column,
    face_to_face: Column,
) -> Column:
    """Label of how well an account is covered; a null potential is not positive."""
    high = F.upper(tier) == "HIGH"
    # actual / potential < 0.25 without a division
    under_realized = (potential > 0) & (
        actual.cast("decimal(20,2)") < potential.cast("decimal(20,2)") * F.lit(LOW_REALIZATION).cast("decimal(3,2)")
    )
    return (
        F.when(high & under_realized & (touches <= 2), UNDER_SERVED)
        .when(high & (touches >= 3) & (positives == touches), WELL_SERVED)
        .when((F.upper(tier) == "LOW") & (face_to_face >= 1) & (negatives >= 1), OVER_SERVED)
        .otherwise(ADEQUATE)
    )


def is_hq_campaign(rep: Column, territory: Column) -> Column:
    return F.upper(rep).like("MKTG%") | (territory == "T-MKT")


def register_sql_functions(spark: SparkSession) -> None:
    """Make the three rules callable from SQL; the bodies are expressions, not Python."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION realization_ratio(actual DOUBLE, potential DOUBLE) RETURNS DECIMAL(20,4) "
        "RETURN IF(potential > 0, bround(CAST(actual AS DECIMAL(20,2)) / CAST(potential AS DECIMAL(20,2)), 4), 0)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION positive_rate(positives BIGINT, touches BIGINT) RETURNS DECIMAL(20,4) "
        "RETURN IF(touches > 0, bround(CAST(positives AS DECIMAL(20,2)) / CAST(touches AS DECIMAL(20,2)), 4), 0)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION coverage_flag(tier STRING, potential DOUBLE, actual DOUBLE, "
        "touches BIGINT, positives BIGINT, negatives BIGINT, f2f BIGINT) RETURNS STRING RETURN CASE "
        "WHEN upper(tier) = 'HIGH' AND potential > 0 AND CAST(actual AS DECIMAL(20,2)) < "
        f"CAST(potential AS DECIMAL(20,2)) * {LOW_REALIZATION} AND touches <= 2 THEN '{UNDER_SERVED}' "
        f"WHEN upper(tier) = 'HIGH' AND touches >= 3 AND positives = touches THEN '{WELL_SERVED}' "
        f"WHEN upper(tier) = 'LOW' AND f2f >= 1 AND negatives >= 1 THEN '{OVER_SERVED}' ELSE '{ADEQUATE}' END"
    )
