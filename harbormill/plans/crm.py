"""CRM products over accounts and field activities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harbormill.functions.engagement import coverage_flag, is_hq_campaign, positive_rate, realization_ratio
from harbormill.functions.numeric import mean_of
from harbormill.models import catalog
from harbormill.operators.aggregates import cost_per, count_where, share_where
from harbormill.operators.columns import conform
from harbormill.operators.joins import enrich_with_totals
from harbormill.sinks.tables import append_table, refresh_table
from harbormill.sources.files import read_csv_strict

# Fixed values of the activity feed.
POSITIVE = "Positive"
NEGATIVE = ("Negative", "No Response")
FACE_TO_FACE = "F2F"
DIGITAL = ("Email", "Remote", "Virtual Event")


def _mean_score():
    score = F.col("engagement_score")
    return mean_of(F.sum(score.cast("decimal(18,2)")), F.count(score), 2)


def _is_positive():
    return F.col("response") == POSITIVE


def load_crm(spark: SparkSession, account_csv: str, activity_csv: str, account_table: str, activity_table: str) -> None:
    """Load both feeds; one bad row aborts before anything is replaced."""
    for path, model, table in (
        (account_csv, catalog.ACCOUNT, account_table),
        (activity_csv, catalog.ACTIVITY, activity_table),
    ):
        refresh_table(read_csv_strict(spark, path, model.schema), table)


def channel_effectiveness(activity: DataFrame) -> DataFrame:
    cost = F.sum("estimated_cost_usd")
    out = activity.groupBy("channel").agg(
        F.count(F.lit(1)).alias("activity_count"),
        _mean_score().alias("avg_engagement_score"),
        share_where(_is_positive()).alias("positive_rate"),
        share_where(F.col("on_preferred_channel")).alias("on_preferred_channel_rate"),
        cost.alias("total_cost_usd"),
        cost_per(cost, count_where(_is_positive())).alias("cost_per_positive_usd"),
    )
    return conform(out, catalog.CHANNEL_EFFECTIVENESS)


def monthly_trends(activity: DataFrame) -> DataFrame:
    channel = F.col("channel")
    out = activity.groupBy("activity_month").agg(
        F.count(F.lit(1)).alias("activity_count"),
        _mean_score().alias("avg_engagement_score"),
        share_where(_is_positive()).alias("positive_rate"),
        share_where(channel == FACE_TO_FACE).alias("f2f_share"),
        share_where(channel.isin(*DIGITAL)).alias("digital_share"),
        F.sum("estimated_cost_usd").alias("total_cost_usd"),
    )
    return conform(out, catalog.MONTHLY_TRENDS).orderBy("activity_month")


def rep_territory_scorecard(activity: DataFrame) -> DataFrame:
    cost = F.col("estimated_cost_usd")
    out = activity.groupBy("rep_id", "territory_id").agg(
        F.count(F.lit(1)).alias("activity_count"),
        F.count_distinct("account_id").alias("distinct_accounts"),
        F.coalesce(_mean_score(), F.lit(0)).alias("avg_engagement_score"),
        share_where(_is_positive()).alias("positive_rate"),
        F.coalesce(F.sum(cost), F.lit(0)).alias("total_cost_usd"),
        F.coalesce(mean_of(F.sum(cost.cast("decimal(18,2)")), F.count(cost), 2), F.lit(0)).alias(
            "avg_cost_per_activity_usd"
        ),
    )
    flagged = out.withColumn("is_hq_campaign", is_hq_campaign(F.col("rep_id"), F.col("territory_id")))
    return conform(flagged, catalog.REP_TERRITORY_SCORECARD)


def build_scorecard(spark: SparkSession, activity_table: str, target_table: str) -> int:
    """Procedure form: read one table, append to another, return the rows written."""
    return append_table(rep_territory_scorecard(spark.table(activity_table)), target_table)


def account_coverage(account: DataFrame, activity: DataFrame) -> DataFrame:
    totals = {
        "touch_count": F.count("activity_id"),
        "total_cost_usd": F.sum("estimated_cost_usd"),
        "avg_engagement_score": _mean_score(),
        "positives": count_where(_is_positive()),
        "negatives": count_where(F.col("response").isin(*NEGATIVE)),
        "face_to_face": count_where(F.col("channel") == FACE_TO_FACE),
    }
    columns = ["account_value_tier", "segment", "specialty", "territory_id", "potential_value_usd", "actual_value_usd"]
    joined = enrich_with_totals(
        account.select("account_id", *columns), activity, "account_id", totals, dict.fromkeys(totals, 0)
    )
    potential, actual, touches = (F.col(c) for c in ("potential_value_usd", "actual_value_usd", "touch_count"))
    out = joined.withColumns(
        {
            "value_gap_usd": potential - actual,
            "realization_ratio": realization_ratio(actual, potential),
            "positive_rate": positive_rate(F.col("positives"), touches),
            "coverage_flag": coverage_flag(
                F.col("account_value_tier"),
                potential,
                actual,
                touches,
                F.col("positives"),
                F.col("negatives"),
                F.col("face_to_face"),
            ),
        }
    )
    return conform(out, catalog.ACCOUNT_COVERAGE)
