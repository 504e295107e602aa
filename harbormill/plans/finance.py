"""Bank finance products: statements, prices, growth and dividends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harbormill.functions.numeric import cents, finite, whole_number
from harbormill.functions.nested import unnest_structs
from harbormill.functions.temporal import day_first_date, embedded_date, epoch_ms_date
from harbormill.functions.text import first_match, snake_case
from harbormill.models import catalog
from harbormill.operators.aggregates import pivot_mean, year_end_last, yearly_sum
from harbormill.operators.asof import DAY, asof_join
from harbormill.operators.columns import cast_columns, conform, melt, stack_prices, tagged
from harbormill.operators.joins import convert_by_date, map_codes
from harbormill.operators.sets import union_conformed
from harbormill.operators.windows import pct_change

# Fixed values.
GROWTH_METRICS = ("net_income", "total_revenue")
CASH_METRIC = "operating_cash_flow"
TICKER_BANKS = {"ANZ.AX": "ANZ", "MQG.AX": "Macquarie", "WBC.AX": "Westpac"}
INCOME_ACRONYMS = ("EBIT", "EBITDA", "EPS", "NI")
BALANCE_ACRONYMS = ("PPE",)
NOT_A_PAYMENT = "1H20"
PRICE_MEASURES = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Dividends": "dividends",
    "Stock Splits": "stock_splits",
}


def statements_long(wide: DataFrame, period_columns: Sequence[str], acronyms: tuple[str, ...] = ()) -> DataFrame:
    """One column per period to one row per (symbol, metric, period)."""
    named = wide.withColumn("metric", snake_case(F.col("metric"), acronyms))
    long = melt(named, ["metric", "symbol"], period_columns, "date", "value")
    return conform(long, catalog.INCOME_STATEMENTS)


def price_history(panel: DataFrame, date: str, tickers: Sequence[str], separator: str = "_") -> DataFrame:
    """Wide price panel to one row per (ticker, day)."""
    return conform(stack_prices(panel, date, tickers, PRICE_MEASURES, separator), catalog.HISTORY)


def growth(history: DataFrame, statements: DataFrame, one_price_per_day: bool = False) -> DataFrame:
    """Year-end close with its return and the latest statement known at year end."""
    yearly = year_end_last(history, "symbol", "date", "close", one_price_per_day)
    yearly = pct_change(yearly, ["symbol"], "date", {"annual_return": "close"})
    reported = pivot_mean(statements, ["symbol", "date"], "metric", "value", GROWTH_METRICS)
    reported = pct_change(
        reported,
        ["symbol"],
        "date",
        {"revenue_growth": "total_revenue", "net_income_growth": "net_income"},
    )
    joined = asof_join(
        yearly,
        reported.withColumn("date", F.col("date").cast("timestamp_ntz")),
        ["symbol"],
        "date",
        slice_seconds=366 * DAY,
    )
    measures = [c for c in joined.columns if c not in ("symbol", "date")]
    return conform(joined.withColumns({c: finite(F.col(c)) for c in measures}), catalog.GROWTH)


def sustainability_trends(
    dividends: DataFrame, cash_flows: DataFrame, bank_of: Mapping[str, str] = TICKER_BANKS
) -> DataFrame:
    """Dividend growth against cash flow growth per bank and year, all measures as double."""
    paid = yearly_sum(dividends, "bank", "payment_date", "dividend_per_share")
    cash = yearly_sum(cash_flows.where(F.col("metric") == CASH_METRIC), "symbol", "date", "value").select(
        map_codes(F.col("symbol"), bank_of).alias("bank"),
        "year",
        F.col("value").alias("operating_cash_flow_thousands"),
    )
    both = paid.join(cash, ["bank", "year"])
    trends = pct_change(
        both,
        ["bank"],
        "year",
        {"dividend_yield_trend": "dividend_per_share", "ocf_trend": "operating_cash_flow_thousands"},
    )
    # inf - inf is NaN, which Spark orders above every number: make it null first
    gap = F.nanvl(F.col("dividend_yield_trend") - F.col("ocf_trend"), F.lit(None).cast("double"))
    flagged = trends.withColumn("dividend_growth_vs_ocf_growth", gap).withColumn(
        "sustainability_flag",
        F.when(F.col("dividend_growth_vs_ocf_growth") > 0.1, "GROWING FASTER THAN OCF")
        .when(F.col("dividend_growth_vs_ocf_growth") > 0, "MODERATE GROWTH")
        .otherwise("CONSERVATIVE GROWTH"),
    )
    trends_only = ("dividend_yield_trend", "ocf_trend", "dividend_growth_vs_ocf_growth")
    return flagged.withColumns({c: finite(F.col(c)) for c in trends_only}).select(
        *catalog.DIVIDEND_SUSTAINABILITY.columns
    )


def dividend_sustainability(dividends: DataFrame, cash_flows: DataFrame) -> DataFrame:
    """The published form; an amount beyond decimal(4,2) becomes null, see the null-share check."""
    return conform(sustainability_trends(dividends, cash_flows), catalog.DIVIDEND_SUSTAINABILITY, safe=True)


def bank_a_dividends(records: DataFrame, whole_cents: bool = False) -> DataFrame:
    """Columns pay_date and dividend in cents; ``whole_cents`` keeps only the digits before the point, as the feed's rule does."""
    amount = first_match(F.col("dividend"), "[0-9]+" if whole_cents else r"[0-9]+(?:\.[0-9]+)?")
    return tagged(records, bank="ANZ").select(
        "bank",
        embedded_date(F.col("pay_date")).alias("payment_date"),
        cents(amount.try_cast("decimal(18,4)")).alias("dividend_per_share"),
    )


def bank_b_dividends(records: DataFrame) -> DataFrame:
    """Columns payment_date (day first) and dividend_per_share in cents."""
    return tagged(records, bank="Macquarie").select(
        "bank",
        day_first_date(F.col("payment_date")).alias("payment_date"),
        cents(whole_number(F.col("dividend_per_share"))).alias("dividend_per_share"),
    )


def exchange_rates(landed: DataFrame) -> DataFrame:
    """Landed rate history (array historicalPoints) to one row per point."""
    points = unnest_structs(landed.select("historicalPoints"), "historicalPoints")
    return points.select(
        epoch_ms_date(F.col("PointInTime")).alias("payment_date"),
        F.col("InterbankRate").cast("decimal(12,6)").alias("interbank_rate"),
    )


def bank_c_dividends(records: DataFrame, rates: DataFrame) -> DataFrame:
    """Columns payment_date and rate in cents of a foreign currency; converted at that day's rate."""
    amount = F.nullif(first_match(F.col("rate"), "[0-9.]+"), F.lit("")).try_cast("decimal(6,2)")
    own = records.where(F.col("payment_date") != NOT_A_PAYMENT).select(
        embedded_date(F.col("payment_date"), r"\d{2}/\d{2}/\d{4}").alias("payment_date"),
        (amount * F.lit("0.01").cast("decimal(3,2)")).alias("rate"),
    )
    converted = convert_by_date(own, rates, "payment_date", "rate", "interbank_rate", "dividend_per_share")
    return tagged(converted, bank="Westpac").select("bank", "payment_date", "dividend_per_share")


def dividends(bank_a: DataFrame, bank_c: DataFrame, bank_b: DataFrame, rates: DataFrame) -> DataFrame:
    """Payments of all banks in one model."""
    parts = [bank_a_dividends(bank_a), bank_c_dividends(bank_c, rates), bank_b_dividends(bank_b)]
    return union_conformed([conform(p, catalog.DIVIDENDS, safe=True) for p in parts])


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Zoned timestamps lose their zone before a table write."""
    return cast_columns(df)
