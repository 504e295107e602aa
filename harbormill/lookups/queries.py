"""Lookups over published tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.functions.temporal import year_range
from harbormill.functions.text import market_key
from harbormill.operators.aggregates import best_rate
from harbormill.operators.ranking import bracket_targets, first_or_null, newest_first, ranked
from harbormill.operators.vectorsearch import top_k

REVENUE_METRIC = "operating_cash_flow"  # fixed value


def _contains_any_case(column: str, text: str) -> Column:
    return F.col(column).ilike(f"%{text}%")


def bank_symbols(growth: DataFrame, year: int | None = None) -> DataFrame:
    if year is not None:
        growth = growth.where(F.col("date").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31))))
    return growth.select("symbol", "date").distinct()


def growth_of(growth: DataFrame, symbol: str | None, limit: int | None = None) -> DataFrame:
    """Newest first, all or the first ``limit``; without a symbol nothing is returned."""
    if symbol is None:
        return growth.limit(0)
    return newest_first(growth.where(_contains_any_case("symbol", symbol)), "date", ["symbol"], limit)


def dividend_sustainability_of(table: DataFrame, bank: str | None, limit: int | None = None) -> DataFrame:
    if bank is None:
        return table.limit(0)
    return newest_first(table.where(_contains_any_case("bank", bank)), "year", ["bank"], limit)


def _revenue(cash_flows: DataFrame, year: int) -> DataFrame:
    wanted = (F.col("metric") == REVENUE_METRIC) & year_range(F.col("date"), year)
    return cash_flows.where(wanted)


def revenue_of(cash_flows: DataFrame, company: str, year: int) -> DataFrame:
    """One row: the latest match, or the request with a null revenue."""
    found = _revenue(cash_flows, year).where(_contains_any_case("symbol", company))
    best = first_or_null(
        found.select("symbol", "date", F.col("value").alias("revenue")),
        [F.col("date")],
        {"symbol": company, "year": year},
    )
    return best.select("symbol", "year", "revenue")


def top_revenue(cash_flows: DataFrame, year: int) -> DataFrame:
    rows = _revenue(cash_flows, year).select("symbol", F.lit(year).alias("year"), F.col("value").alias("revenue"))
    return ranked(rows, "revenue", ["symbol"])


def banks(table: DataFrame) -> DataFrame:
    return table.select("name")


def term_rates_of(term_deposits: DataFrame, bank: str) -> DataFrame:
    return term_deposits.where(F.col("bank") == bank)


def home_loans_of(home_loan_rates: DataFrame, bank: str) -> DataFrame:
    return home_loan_rates.where(F.col("bank") == bank)


def all_fraud_stats(density: DataFrame) -> DataFrame:
    """Ranked markets beside their number; the input is one row per market."""
    total = density.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ranked(density.withColumn("total_categories", total), "fraud_rate_pct", ["market_type"])


def market_fraud_stats(density: DataFrame, market: str) -> DataFrame:
    """One market by its normalised name; an unknown one gives 0, 0 and -1.0."""
    asked = F.lit(market.strip().strip("'\"").lower())
    found = density.where(F.lower("market_type") == market_key(asked)).select(
        "market_type", "transaction_count", "fraud_event_count", "fraud_rate_pct"
    )
    best = first_or_null(found, [F.col("transaction_count")], {})
    defaults = {"market_type": asked, "transaction_count": 0, "fraud_event_count": 0, "fraud_rate_pct": -1.0}
    return best.select(
        *[
            F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)).alias(c)
            for c, v in defaults.items()
        ]
    )


def search_issues(
    vectors: DataFrame, query: Sequence[float] | DataFrame | None, k: int, most: int | None = None
) -> DataFrame:
    """The ``k`` most similar chunks with the issue's key, status and update time from the metadata.

    A caller that must not hand out more than ``most`` hits says so, and asking for more is an error.
    """
    if most is not None and k > most:
        raise ValueError(f"{k} hits asked for, at most {most} are allowed")
    hits = top_k(vectors, query, k, ties=["langchain_id"])
    meta = F.col("langchain_metadata")
    return hits.select(
        "content",
        F.get_json_object(meta, "$.key").alias("issue_key"),
        F.get_json_object(meta, "$.status").alias("status"),
        F.get_json_object(meta, "$.updated").alias("updated"),
        "score",
    )


def best_maturity_rates(term_deposits: DataFrame) -> DataFrame:
    rows = term_deposits.where((F.col("min_term") <= 12) & F.col("maturity_rate").isNotNull())
    return best_rate(rows, ["min_term", "bank"], "maturity_rate").orderBy("min_term", "bank")


def best_annual_rates(term_deposits: DataFrame) -> DataFrame:
    term = F.col("min_term")
    rows = term_deposits.where((term >= 12) & (term < 60) & F.col("annual_rate").isNotNull())
    return best_rate(rows, ["min_term", "bank"], "annual_rate").orderBy("min_term", "bank")


def best_monthly_rates(term_deposits: DataFrame) -> DataFrame:
    term = F.col("min_term")
    rows = term_deposits.where((term >= 2) & (term <= 12) & F.col("maturity_rate").isNotNull())
    return best_rate(rows, ["min_term", "bank"], "monthly_rate").orderBy("min_term", "bank")


def best_loan_rates(home_loan_rates: DataFrame, targets: Sequence[int]) -> DataFrame:
    """Lowest rate per bank and term for each loan-to-value target."""
    hits = bracket_targets(home_loan_rates, "min_lvr", "max_lvr", targets, "target_lvr")
    return best_rate(hits, ["target_lvr", "bank", "loan_term"], "rate", lowest=True).orderBy(
        "target_lvr", "loan_term", "bank"
    )
