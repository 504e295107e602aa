"""CRM products on orders (activities) and customers (accounts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from harbormill.functions.engagement import register_sql_functions
from harbormill.plans import crm
from workloads.inputs import ACCOUNT, ACTIVITY
from workloads.registry import half_even, half_up, workload

POS = "count(*) FILTER (response = 'Positive')"
AVG = half_up("sum(engagement_score)", "count(engagement_score)", 2)


@workload(
    "channel_effectiveness",
    "E02 A01 A02 A03 A04 P01 P07 F19 F20",
    f"""SELECT channel, count(*) AS activity_count, {AVG} AS avg_engagement_score,
        {half_up(POS, 'count(*)', 4)} AS positive_rate,
        {half_up('count(*) FILTER (on_preferred_channel)', 'count(*)', 4)} AS on_preferred_channel_rate,
        CAST(sum(estimated_cost_usd) AS BIGINT) AS total_cost_usd,
        coalesce({half_up('sum(estimated_cost_usd)', POS, 2)}, 0.0) AS cost_per_positive_usd
        FROM {ACTIVITY.sql} GROUP BY channel""",
)
def channel_effectiveness(spark, d):
    return crm.channel_effectiveness(ACTIVITY.df(spark, d))


@workload(
    "monthly_trends",
    "E03 A05 F16 O01",
    f"""SELECT activity_month, count(*) AS activity_count, {AVG} AS avg_engagement_score,
        {half_up(POS, 'count(*)', 4)} AS positive_rate,
        {half_up("count(*) FILTER (channel = 'F2F')", 'count(*)', 4)} AS f2f_share,
        {half_up("count(*) FILTER (channel IN ('Email','Remote','Virtual Event'))", 'count(*)', 4)} AS digital_share,
        CAST(sum(estimated_cost_usd) AS BIGINT) AS total_cost_usd
        FROM {ACTIVITY.sql} GROUP BY activity_month ORDER BY activity_month""",
)
def monthly_trends(spark, d):
    return crm.monthly_trends(ACTIVITY.df(spark, d))


@workload(
    "rep_territory_scorecard",
    "E04 A06 F33 F07",
    f"""SELECT rep_id, territory_id, upper(rep_id) LIKE 'MKTG%' OR territory_id = 'T-MKT' AS is_hq_campaign,
        count(*) AS activity_count, count(DISTINCT account_id) AS distinct_accounts,
        coalesce({AVG}, 0.0) AS avg_engagement_score, {half_up(POS, 'count(*)', 4)} AS positive_rate,
        CAST(sum(estimated_cost_usd) AS BIGINT) AS total_cost_usd,
        {half_up('sum(estimated_cost_usd)', 'count(*)', 2)} AS avg_cost_per_activity_usd
        FROM {ACTIVITY.sql} GROUP BY rep_id, territory_id""",
)
def rep_territory_scorecard(spark, d):
    return crm.rep_territory_scorecard(ACTIVITY.df(spark, d))


COVERAGE_SQL = f"""WITH act AS (SELECT account_id, count(activity_id) AS touch_count,
            CAST(sum(estimated_cost_usd) AS BIGINT) AS total_cost_usd, coalesce({AVG}, 0.0) AS avg_engagement_score,
            {POS} AS pos, count(*) FILTER (response IN ('Negative','No Response')) AS neg,
            count(*) FILTER (channel = 'F2F') AS f2f FROM {ACTIVITY.sql} GROUP BY account_id),
        j AS (SELECT a.*, coalesce(touch_count, 0) AS touch_count, coalesce(total_cost_usd, 0) AS total_cost_usd,
            coalesce(avg_engagement_score, 0.0) AS avg_engagement_score, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg,
            coalesce(f2f, 0) AS f2f FROM {ACCOUNT.sql} a LEFT JOIN act USING (account_id))
        SELECT account_id, account_value_tier, segment, specialty, territory_id, potential_value_usd, actual_value_usd,
            potential_value_usd - actual_value_usd AS value_gap_usd,
            coalesce({half_even('actual_value_usd', 'potential_value_usd', 4)}, 0.0) AS realization_ratio,
            touch_count, total_cost_usd, avg_engagement_score,
            coalesce({half_even('pos', 'touch_count', 4)}, 0.0) AS positive_rate,
            CASE WHEN upper(account_value_tier) = 'HIGH' AND potential_value_usd > 0
                    AND 4 * actual_value_usd < potential_value_usd AND touch_count <= 2 THEN 'Under-served high-value'
                WHEN upper(account_value_tier) = 'HIGH' AND touch_count >= 3 AND pos = touch_count
                    THEN 'Well-served high-value'
                WHEN upper(account_value_tier) = 'LOW' AND f2f >= 1 AND neg >= 1 THEN 'Over-served low-value'
                ELSE 'Adequate' END AS coverage_flag FROM j"""


@workload("account_coverage", "E01 J01 D01 D02 D03 P05 P06 P07 F07", COVERAGE_SQL)
def account_coverage(spark, d):
    return crm.account_coverage(ACCOUNT.df(spark, d), ACTIVITY.df(spark, d))


@workload(
    "coverage_sql_functions",
    "D01 D02 D03",
    f"""SELECT account_id, coalesce({half_even('actual_value_usd', 'potential_value_usd', 4)}, 0.0) AS realization,
        {half_even('prescribing_decile', '16', 4)} AS rate, CASE WHEN upper(account_value_tier) = 'HIGH'
            AND potential_value_usd > 0 AND 4 * actual_value_usd < potential_value_usd AND prescribing_decile <= 2
            THEN 'Under-served high-value'
        WHEN upper(account_value_tier) = 'HIGH' AND prescribing_decile >= 3 THEN 'Well-served high-value'
        WHEN upper(account_value_tier) = 'LOW' AND prescribing_decile >= 1 THEN 'Over-served low-value'
        ELSE 'Adequate' END AS flag FROM {ACCOUNT.sql}""",
)
def coverage_sql_functions(spark, d):
    """The rules called from SQL; the decile stands in for every count."""
    register_sql_functions(spark)
    n = "prescribing_decile"
    return ACCOUNT.df(spark, d).select(
        "account_id",
        F.expr("realization_ratio(actual_value_usd, potential_value_usd)").alias("realization"),
        F.expr(f"positive_rate({n}, 16L)").alias("rate"),
        F.expr(f"coverage_flag(account_value_tier, potential_value_usd, actual_value_usd, {n}, {n}, {n}, {n})").alias("flag"),
    )
