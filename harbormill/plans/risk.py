"""Card and payment risk products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harbormill.functions.numeric import flag_from_text, number_or_zero, percent
from harbormill.functions.text import market_key, unquote
from harbormill.models import catalog
from harbormill.operators.columns import conform_fill
from harbormill.operators.interval import conflicts_within
from harbormill.operators.ranking import ranked

PAYMENT_TEXTS = ("customer", "age", "gender", "zipcodeOri", "merchant", "zipMerchant", "category")
PAYMENT_RENAMES = {"zipcodeOri": "zipcode_ori", "zipMerchant": "zip_merchant"}


def suspicious_transactions(transactions: DataFrame, hours: int = 1, ordered: bool = True) -> DataFrame:
    """Transactions of one customer in different countries within the window."""
    narrow = transactions.select(*catalog.ANOMALIES.columns)
    found = conflicts_within(narrow, "customer_id", "date", "country_code", hours * 3600).distinct()
    return found.orderBy("customer_id", "date") if ordered else found


def clean_payments(raw: DataFrame) -> DataFrame:
    """Quotes and blanks off, numbers read tolerantly, model columns in order."""
    present = set(raw.columns)
    changes = {c: unquote(F.col(c)) for c in PAYMENT_TEXTS if c in present}
    if "step" in present:
        changes["step"] = number_or_zero(F.col("step"))
    if "amount" in present:
        changes["amount"] = F.col("amount").try_cast("double")
    if "fraud" in present:
        changes["fraud"] = flag_from_text(F.col("fraud"))
    return conform_fill(raw.withColumns(changes), catalog.BANKSIM_TRANSACTIONS, PAYMENT_RENAMES)


def market_counts(raw: DataFrame) -> DataFrame:
    """Payments and fraud events per market; on a stream, a running aggregate of two numbers per market."""
    flag = number_or_zero(F.col("fraud").cast("string"))
    return (
        raw.select(market_key(F.col("category")).alias("market_type"), flag.alias("flag"))
        .where(F.col("market_type").isNotNull())
        .groupBy("market_type")
        .agg(F.count("flag").alias("transaction_count"), F.sum("flag").alias("fraud_event_count"))
        .where(F.col("transaction_count") > 0)
    )


def with_rate(per_market: DataFrame) -> DataFrame:
    return per_market.withColumn("fraud_rate_pct", percent(F.col("fraud_event_count"), F.col("transaction_count")))


def fraud_density(raw: DataFrame) -> DataFrame:
    """Payments, fraud events and fraud rate per market, highest rate first."""
    return ranked(with_rate(market_counts(raw)), "fraud_rate_pct", ["market_type"])
