"""Comparable bank rates from three differently nested feeds.

Bank A: sections holding arrays of products holding arrays of rates.
Bank B: a slug that encodes product, term and tier, and a rate text.
Bank C: flat text rows (deposits) and maps keyed by product and rate code (loans).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbormill.functions.nested import unnest_map
from harbormill.functions.numeric import blank_as, whole_number
from harbormill.functions.text import first_match, matches_whole, strip_trailing_chars
from harbormill.models import Model, catalog
from harbormill.operators.aggregates import pivot_by_type, tier_brackets
from harbormill.operators.columns import conform, tagged
from harbormill.operators.sets import union_conformed
from harbormill.operators.windows import next_tier

# Fixed values of the feeds.
BANK_A, BANK_B, BANK_C = "ANZ", "Macquarie", "Westpac"
DEPOSIT_SECTION = "Deposit accounts"
DEPOSIT_PRODUCTS = ("ANZ Term Deposit", "ANZ Advance Notice Term Deposit")
DEPOSIT_RATE_TYPES = {
    "monthly_rate": "Monthly Interest",
    "annual_rate": "Annual Interest",
    "maturity_rate": "Interest at Maturity",
}
DEPOSIT_AMOUNTS = (5000, 1999999)
LOAN_SUBSECTIONS = ("HOOHLSIR", "HOOFR")
LOAN_RATE_TYPE = "Principal and Interest"
SLUG_DEPOSITS = "term_deposit_macquarie_bank_{}_%"
SLUG_LOANS = "mort_basic_fix_%"
MILLION_TIER = "_1m"
PORTFOLIO_LVR = {"HLLVR3": (0, 70), "HL": (70, 80), "HLLVR5": (80, 100)}
LOAN_BANDS = (
    ("<$150k", 0, 150000),
    ("$150k-$250k", 150000, 250000),
    ("$250k-$500k", 250000, 500000),
    ("$500k-$750k", 500000, 750000),
    ("$750k-$1mil", 750000, 1000000),
    ("$1mil+", 1000000, None),
)


def _section_rates(sections: DataFrame) -> DataFrame:
    """One row per rate; sections and products with empty arrays vanish."""
    products = sections.select(
        F.col("name").alias("section"),
        F.col("isactive").alias("section_active"),
        F.col("isfordisplay").alias("section_shown"),
        F.explode("subsection").alias("product"),
    )
    return products.select("section", "section_active", "section_shown", "product", F.explode("product.baserate").alias("rate"))


def bank_a_term_deposits(sections: DataFrame) -> DataFrame:
    tier = F.col("rate.tiername1")
    kept = _section_rates(
        sections.where(
            (F.col("isactive") == "1") & (F.col("isfordisplay") == "1") & (F.col("name") == DEPOSIT_SECTION)
        )
    ).where(
        (F.col("product.isactive") == "1")
        & (F.col("product.isfordisplay") == "1")
        & F.col("product.name").isin(*DEPOSIT_PRODUCTS)
        & F.col("rate.ratetype").isin(*DEPOSIT_RATE_TYPES.values())
        & ~tier.like("% (NOT IN USE)")
        & ~tier.like("% days %")
        & (F.col("rate.ratevalue") != "blank")
    )
    flat = kept.select(
        F.col("product.name").alias("name"),
        first_match(tier, "^([0-9]+)", 1).cast("int").alias("min_term"),
        first_match(tier, "([0-9]+) months", 1).cast("int").alias("max_term"),
        F.col("rate.ratetype").alias("kind"),
        F.col("rate.ratevalue").try_cast("decimal(4,2)").alias("value"),
    )
    wide = pivot_by_type(flat, ["name", "min_term", "max_term"], "kind", "value", DEPOSIT_RATE_TYPES, "decimal(4,2)")
    low, high = DEPOSIT_AMOUNTS
    # a deposit of exactly one year pays at maturity what it pays annually
    at_maturity = F.when(F.col("min_term") == 12, F.col("annual_rate")).otherwise(F.col("maturity_rate"))
    return tagged(wide, bank=BANK_A, min_amount=low, max_amount=high).withColumn("maturity_rate", at_maturity)


def _slug_months(title: Column, strict: bool) -> Column:
    digits = "[0-9]+" if strict else "[0-9]"
    return F.when(
        matches_whole(title, ".+[0-9]_months?.*"), first_match(title, f"({digits})_month(s?)", 1).cast("int")
    ).when(matches_whole(title, ".+[0-9]_years?.*"), first_match(title, f"({digits})_year(s?)", 1).cast("int") * 12)


def bank_b_term_deposits(slugs: DataFrame, strict: bool = True) -> DataFrame:
    """All digits of the term count; with ``strict=False`` only the last one, as the feed's own rule has it."""
    title = F.col("title")
    large = title.endswith(MILLION_TIER)
    value = F.col("value").try_cast("decimal(4,2)")
    wanted = (
        title.like(SLUG_DEPOSITS.format("monthly"))
        | title.like(SLUG_DEPOSITS.format("annually"))
        | title.like(SLUG_DEPOSITS.format("maturity"))
    )
    rows = slugs.where(wanted).select(
        F.when(large, 1000001).otherwise(5000).alias("min_amount"),
        F.when(large, None).otherwise(1000000).cast("int").alias("max_amount"),
        _slug_months(title, strict).alias("min_term"),
        F.when(title.contains("_monthly_"), value).alias("monthly_rate"),
        F.when(title.contains("_annually_"), value).alias("annual_rate"),
        F.when(title.contains("_maturity_"), value).alias("maturity_rate"),
    )
    tiers = rows.groupBy("min_amount", "max_amount", "min_term").agg(
        F.max("monthly_rate").alias("monthly_rate"),
        F.max("annual_rate").alias("annual_rate"),
        F.max("maturity_rate").alias("maturity_rate"),
    )
    bounded = next_tier(tiers.where(F.col("min_term").isNotNull()), ["min_amount"], "min_term", "max_term")
    unbounded = tiers.where(F.col("min_term").isNull()).withColumn("max_term", F.lit(None).cast("int"))
    name = F.concat(F.lit("term-deposit-"), "min_term", F.lit("months-"), "min_amount")
    return tagged(bounded.unionByName(unbounded), bank=BANK_B).withColumn("name", name)


def bank_c_term_deposits(rows: DataFrame) -> DataFrame:
    maturity = F.col("maturity_rate").try_cast("decimal(4,2)")
    typed = rows.where(
        (F.col("min_term") != "") & (F.col("max_term") != "") & ~F.col("rate_code").like("HR%")
    ).select(
        first_match(F.col("product_id"), "^[a-zA-Z]+").alias("product_name"),
        whole_number(blank_as(F.col("min_term"), "0")).alias("min_term"),
        whole_number(blank_as(F.col("max_term"), "600")).alias("max_term"),
        F.col("monthly_rate").try_cast("decimal(4,2)").alias("monthly"),
        maturity.alias("maturity"),
    )
    grouped = (
        typed.where(F.col("min_term") >= 1)
        .groupBy("product_name", "min_term", "maturity", "monthly")
        .agg(F.max("max_term").alias("max_term"))
    )
    product, term, at_maturity = F.col("product_name"), F.col("min_term"), F.col("maturity")
    monthly = (
        F.when(product == "DigitalPromo", at_maturity)
        .when(product == "FixedInterestRate", at_maturity - F.lit("0.05").cast("decimal(3,2)"))
        .otherwise(F.col("monthly"))
    )
    return tagged(grouped, bank=BANK_C, min_amount=5000, max_amount=2000000).withColumns(
        {
            "name": F.concat(product, F.lit("-"), F.col("min_amount").cast("string"), F.lit("~"), term.cast("string")),
            "monthly_rate": monthly.cast("decimal(4,2)"),
            "annual_rate": F.when(term > 12, at_maturity),
            "maturity_rate": F.when(term <= 12, at_maturity),
        }
    )


def bank_a_home_loans(sections: DataFrame) -> DataFrame:
    tier = F.col("rate.tiername1")
    low_tier = tier.endswith("<80%")
    kept = _section_rates(sections).where(
        F.col("product.code").isin(*LOAN_SUBSECTIONS) & (F.col("rate.ratetype") == LOAN_RATE_TYPE)
    )
    flat = kept.select(
        first_match(tier, r"\d+").cast("int").alias("loan_term"),
        F.when(low_tier, 0).otherwise(80).alias("min_lvr"),
        F.when(low_tier, 80).otherwise(100).alias("max_lvr"),
        F.lit(0).alias("min_loan"),
        F.lit(None).cast("int").alias("max_loan"),
        F.col("rate.ratevalue").try_cast("decimal(6,2)").alias("rate"),
    )
    return tagged(flat, bank=BANK_A, product="Fixed Home Loan")


def bank_b_home_loans(slugs: DataFrame) -> DataFrame:
    title = F.col("title")
    flat = slugs.where(title.like(SLUG_LOANS) & title.endswith("0_rate")).select(
        first_match(title, "_([0-9]+)year_", 1).cast("int").alias("loan_term"),
        F.when(title.contains("lte70"), 0)
        .when(title.contains("lte80"), 70)
        .when(title.contains("lte90"), 80)
        .alias("min_lvr"),
        F.when(title.contains("lte70"), 70)
        .when(title.contains("lte80"), 80)
        .when(title.contains("lte90"), 100)
        .alias("max_lvr"),
        F.lit(0).alias("min_loan"),
        F.lit(None).cast("int").alias("max_loan"),
        strip_trailing_chars(F.col("value"), "% pa").try_cast("decimal(6,2)").alias("rate"),
    )
    return tagged(flat, bank=BANK_B, product="Fixed Mortgage Basic")


def _case(c: Column, table: dict[str, object]) -> Column:
    out = F.lit(None).cast("int")
    for key, value in table.items():
        out = F.when(c == key, F.lit(value)).otherwise(out)
    return out


def _band(label: Column, bound: int) -> Column:
    """Loan bound by the suffix of the rate's label; the first listed suffix that fits wins."""
    out = F.lit(None).cast("int")
    for row in reversed(LOAN_BANDS):
        out = F.when(label.endswith(row[0]), F.lit(row[bound]).cast("int")).otherwise(out)
    return out


def bank_c_home_loans(portfolios: DataFrame) -> DataFrame:
    products = unnest_map(portfolios.select("portfolioid", "products"), "products", "product_name", "item")
    codes = products.select("portfolioid", F.col("item.ProductId").alias("product_id"), F.explode("item.Rates").alias("code", "detail"))
    label, rate_code = F.col("detail")["PRODUCT"], F.col("detail")["RATECODE"]
    product_id = F.col("product_id")
    # only fixed-term rates above the smallest loan band, principal and interest
    fixed = codes.where(
        rate_code.like("PAHLFX%") & ~rate_code.like("%0") & ~product_id.endswith("-InterestOnly")
    ).select(
        first_match(product_id, "[0-9]Year([A-Za-z]+)").alias("product"),
        first_match(product_id, "^[0-9]").cast("int").alias("loan_term"),
        _case(F.col("portfolioid"), {k: v[0] for k, v in PORTFOLIO_LVR.items()}).alias("min_lvr"),
        _case(F.col("portfolioid"), {k: v[1] for k, v in PORTFOLIO_LVR.items()}).alias("max_lvr"),
        _band(label, 1).alias("min_loan"),
        _band(label, 2).alias("max_loan"),
        F.col("detail")["Std_Rate"].try_cast("decimal(6,2)").alias("rate"),
    )
    merged = tier_brackets(fixed, ["product", "loan_term", "min_lvr", "max_lvr", "rate"], "min_loan", "max_loan")
    return tagged(merged, bank=BANK_C)


def term_deposits(bank_a: DataFrame, bank_b: DataFrame, bank_c: DataFrame) -> DataFrame:
    parts = [bank_c_term_deposits(bank_c), bank_a_term_deposits(bank_a), bank_b_term_deposits(bank_b)]
    return union_conformed([conform(p, catalog.TERM_DEPOSITS) for p in parts])


def home_loan_rates(bank_a: DataFrame, bank_b: DataFrame, bank_c: DataFrame) -> DataFrame:
    parts = [bank_c_home_loans(bank_c), bank_a_home_loans(bank_a), bank_b_home_loans(bank_b)]
    return union_conformed([conform(p, catalog.HOME_LOAN_RATES) for p in parts])


def flat_deposit_feed(products: DataFrame, offers: DataFrame) -> DataFrame:
    """Standard and special-offer lists (columns ProductId, Rates map) to the flat text feed."""

    def flatten(listed: DataFrame) -> DataFrame:
        rate = F.get(F.map_values("Rates"), F.lit(0))
        return listed.select(
            F.col("ProductId").alias("product_id"),
            rate["status"].alias("status"),
            rate["RATECODE"].alias("rate_code"),
            rate["PRODUCT"].alias("product"),
            rate["MinAmt"].alias("min_amount"),
            rate["MinTerm"].alias("min_term"),
            rate["MaxTerm"].alias("max_term"),
            rate["MaxAmt"].alias("max_amount"),
            rate["Maturityrate"].alias("maturity_rate"),
            rate["Monthlyrate"].alias("monthly_rate"),
            rate["HotRate"].alias("hot_rate"),
            rate["EffectiveDate"].alias("effective_date"),
        )

    return flatten(products).union(flatten(offers))


def bank_slice(rates: DataFrame, bank: str, model: Model) -> DataFrame:
    """One bank's rows, staged as text and cast to the target model."""
    staged = rates.where(F.col("bank") == bank).select(*[F.col(c).cast("string").alias(c) for c in model.columns])
    return conform(staged, model)
