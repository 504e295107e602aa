"""The CRM metric views."""

from __future__ import annotations

from harbormill.models import catalog
from harbormill.semantic.layer import ALL_ROWS, Metric, MetricView

ACCOUNT_METRICS = MetricView(
    "account_metrics",
    catalog.ACCOUNT,
    (
        Metric("TOTAL_REVENUE", "sum", "actual_value_usd", "Realised revenue of all accounts in dollars"),
        Metric("TOTAL_POTENTIAL_VALUE", "sum", "potential_value_usd", "Addressable value of all accounts in dollars"),
        Metric("ACCOUNT_COUNT", "count", ALL_ROWS, "Number of accounts"),
    ),
    "Revenue and value metrics over accounts.",
)

ACTIVITY_METRICS = MetricView(
    "activity_metrics",
    catalog.ACTIVITY,
    (
        Metric("ACTIVITY_COUNT", "count", ALL_ROWS, "Number of field activities"),
        Metric("TOTAL_COST", "sum", "estimated_cost_usd", "Estimated cost of all activities in dollars"),
        Metric("AVG_ENGAGEMENT_SCORE", "avg", "engagement_score", "Mean engagement, 0 to 100"),
    ),
    "Engagement metrics over activities.",
)

VIEWS = (ACCOUNT_METRICS, ACTIVITY_METRICS)
