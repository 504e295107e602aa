"""Risk products on events (transactions) and orders (payments)."""

from __future__ import annotations

from pyspark.sql import functions as F

from harbormill.lookups import queries as lookups
from harbormill.plans import risk
from harbormill.session import shared_dir
from harbormill.sinks.files import write_parquet
from harbormill.sources.files import read_parquet
from workloads.inputs import PAYMENTS, TRANSACTIONS
from workloads.registry import half_even, stamp, workload

MARKET = "lower(trim(regexp_replace(trim(trim(category), '''\"'), '^es_', '')))"
FLAG = "CAST(coalesce(TRY_CAST(fraud AS DOUBLE), 0) AS BIGINT)"
DENSITY_SQL = f"""SELECT market_type, count(*) AS transaction_count, CAST(sum(flag) AS BIGINT) AS fraud_event_count,
        {half_even('100*sum(flag)', 'count(*)', 2)} AS fraud_rate_pct
        FROM (SELECT {MARKET} AS market_type, {FLAG} AS flag FROM {PAYMENTS.sql}) GROUP BY market_type"""


@workload(
    "suspicious_events",
    "E11 J07 W03 W05 O01",
    f"""WITH t AS {TRANSACTIONS.sql} SELECT DISTINCT a.transaction_id, a.customer_id, {stamp('a.date')} AS date,
        a.country_code FROM t a JOIN t b ON a.customer_id IS NOT DISTINCT FROM b.customer_id
        AND b.date BETWEEN a.date - INTERVAL 1 HOUR AND a.date + INTERVAL 1 HOUR
        AND a.country_code IS DISTINCT FROM b.country_code""",
)
def suspicious_events(spark, d):
    return risk.suspicious_transactions(TRANSACTIONS.df(spark, d))


@workload("market_density", "E12 A12 F03 F04 F17 O02", DENSITY_SQL)
def market_density(spark, d):
    return risk.fraud_density(PAYMENTS.df(spark, d))


@workload(
    "clean_payments",
    "E12 P02 F04 F17 S02",
    f"""SELECT CASE WHEN step = 'n/a' THEN 0 ELSE CAST(step AS BIGINT) END AS step,
        trim(trim(customer, '''')) AS customer, trim(trim(age, '''')) AS age, trim(trim(gender, '''')) AS gender,
        trim(trim(zipcodeOri, '''')) AS zipcode_ori, trim(trim(merchant, '''')) AS merchant,
        CAST(NULL AS VARCHAR) AS zip_merchant, trim(trim(category, '''')) AS category,
        TRY_CAST(amount AS DOUBLE) AS amount, {FLAG} <> 0 AS fraud FROM {PAYMENTS.sql}""",
)
def clean_payments(spark, d):
    return risk.clean_payments(PAYMENTS.df(spark, d))


def published_density(spark, d):
    """The density as its consumers see it: written once, read by every lookup."""
    path = shared_dir(spark, "density")
    write_parquet(risk.fraud_density(PAYMENTS.df(spark, d)), path)
    return read_parquet(spark, path)


@workload(
    "all_fraud_stats",
    "R09 A18",
    f"SELECT *, count(*) OVER () AS total_categories FROM ({DENSITY_SQL})",
)
def all_fraud_stats(spark, d):
    return lookups.all_fraud_stats(published_density(spark, d))


@workload(
    "market_fraud_stats",
    "R10 F03 F04",
    f"""SELECT * FROM ({DENSITY_SQL}) WHERE market_type = 'travel'
        UNION ALL SELECT 'es_moon', 0, 0, -1.0""",
)
def market_fraud_stats(spark, d):
    density = published_density(spark, d)
    known = lookups.market_fraud_stats(density, " 'es_Travel' ")
    return known.unionByName(lookups.market_fraud_stats(density, "es_Moon"))


@workload(
    "card_amounts",
    "F21 P09 K15",
    f"""SELECT transaction_id, CAST(amount AS DOUBLE)/100 AS amount,
        CASE WHEN merchant LIKE 'M1%' THEN '*****' ELSE merchant END AS merchant
        FROM {TRANSACTIONS.sql} WHERE type NOT LIKE 'sign%'""",
)
def card_amounts(spark, d):
    from harbormill.functions.numeric import cents
    from harbormill.operators.columns import mask_column

    rows = TRANSACTIONS.df(spark, d).where(~F.col("type").like("sign%"))
    masked = mask_column(rows, "merchant", F.col("merchant").like("M1%"))
    return masked.select("transaction_id", cents(F.col("amount")).alias("amount"), "merchant")
