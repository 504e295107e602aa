"""Bank rate products on feeds derived from part."""

from __future__ import annotations

from pyspark.sql import functions as F

from harbormill.lookups import queries as lookups
from harbormill.models import catalog
from harbormill.operators import joins, ranking
from harbormill.plans import rates
from workloads.inputs import (
    BAND_LABEL,
    FLAT_DEPOSITS,
    LOAN_CODE,
    LOAN_PRODUCT_ID,
    LOAN_TIER,
    PORTFOLIO_ID,
    PRODUCT_NAME,
    PRODUCT_SHOWN,
    RATE_TEXT,
    SECTION_ACTIVE,
    SECTION_NAME,
    SLUG_DEPOSITS,
    SLUG_LOANS,
    StandIn,
    portfolios,
    sections,
    text,
)
from workloads.registry import table, workload

DEC42 = "CAST(CAST({} AS DECIMAL(4,2)) AS DOUBLE)"

A_DEPOSITS_SQL = f"""SELECT {PRODUCT_NAME} AS name, 'ANZ' AS bank, 5000 AS min_amount, 1999999 AS max_amount,
        CAST(p_size AS BIGINT) AS min_term, CAST(p_size + 3 AS BIGINT) AS max_term,
        max({DEC42.format(RATE_TEXT)}) AS monthly_rate, max({DEC42.format("'1.' || " + text('10 + p_partkey % 90'))}) AS annual_rate,
        CASE WHEN p_size = 12 THEN max({DEC42.format("'1.' || " + text('10 + p_partkey % 90'))})
        ELSE max({DEC42.format("'2.' || " + text('10 + p_partkey % 90'))}) END AS maturity_rate
        FROM part WHERE {SECTION_NAME} = 'Deposit accounts' AND {SECTION_ACTIVE} = '1' AND {PRODUCT_SHOWN} = '1'
        AND {PRODUCT_NAME} <> 'Saver' GROUP BY 1, p_size"""

B_DEPOSITS_SQL = f"""SELECT 'term-deposit-' || min_term || 'months-' || min_amount AS name, 'Macquarie' AS bank,
        CAST(min_amount AS BIGINT) AS min_amount, CAST(max_amount AS BIGINT) AS max_amount,
        CAST(min_term AS BIGINT) AS min_term,
        CAST(CASE WHEN min_term IS NOT NULL THEN lead(min_term) OVER (PARTITION BY min_amount ORDER BY min_term NULLS LAST) END
        AS BIGINT) AS max_term, monthly_rate, annual_rate, maturity_rate FROM (
        SELECT min_amount, max_amount, min_term, max(CASE WHEN title LIKE '%\\_monthly\\_%' ESCAPE '\\' THEN v END) AS monthly_rate,
            max(CASE WHEN title LIKE '%\\_annually\\_%' ESCAPE '\\' THEN v END) AS annual_rate,
            max(CASE WHEN title LIKE '%\\_maturity\\_%' ESCAPE '\\' THEN v END) AS maturity_rate FROM (
            SELECT title, {DEC42.format('value')} AS v, CASE WHEN ends_with(title, '_1m') THEN 1000001 ELSE 5000 END AS min_amount,
            CASE WHEN ends_with(title, '_1m') THEN NULL ELSE 1000000 END AS max_amount,
            CASE WHEN regexp_full_match(title, '.+[0-9]_months?.*') THEN CAST(regexp_extract(title, '([0-9]+)_month', 1) AS INT)
                WHEN regexp_full_match(title, '.+[0-9]_years?.*') THEN CAST(regexp_extract(title, '([0-9]+)_year', 1) AS INT) * 12
            END AS min_term FROM {SLUG_DEPOSITS.sql} WHERE title LIKE 'term_deposit_macquarie_bank_monthly_%'
            OR title LIKE 'term_deposit_macquarie_bank_annually_%' OR title LIKE 'term_deposit_macquarie_bank_maturity_%')
        GROUP BY 1, 2, 3)"""

C_DEPOSITS_SQL = f"""SELECT product_name || '-5000~' || min_term AS name, 'Westpac' AS bank, 5000 AS min_amount,
        2000000 AS max_amount, CAST(min_term AS BIGINT) AS min_term, CAST(max(max_term) AS BIGINT) AS max_term,
        CAST(CASE product_name WHEN 'DigitalPromo' THEN maturity WHEN 'FixedInterestRate' THEN maturity - 0.05
            ELSE monthly END AS DOUBLE) AS monthly_rate,
        CAST(CASE WHEN min_term > 12 THEN maturity END AS DOUBLE) AS annual_rate,
        CAST(CASE WHEN min_term <= 12 THEN maturity END AS DOUBLE) AS maturity_rate FROM (
        SELECT regexp_extract(product_id, '^[a-zA-Z]+') AS product_name,
            CASE min_term WHEN '0.25' THEN 0 WHEN '0.5' THEN 1 ELSE CAST(min_term AS INT) END AS min_term,
            CAST(max_term AS INT) AS max_term, CAST(monthly_rate AS DECIMAL(4,2)) AS monthly,
            CAST(maturity_rate AS DECIMAL(4,2)) AS maturity FROM {FLAT_DEPOSITS.sql}
        WHERE min_term <> '' AND max_term <> '' AND rate_code NOT LIKE 'HR%')
        WHERE min_term >= 1 GROUP BY product_name, min_term, maturity, monthly"""


@workload("bank_a_deposits", "N01 F01 F02 F23 F25 J11 A08 P08 P09 P14", A_DEPOSITS_SQL)
def bank_a_deposits(spark, d):
    out = rates.bank_a_term_deposits(sections(spark, d))
    return out.select(*catalog.TERM_DEPOSITS.columns)


@workload("bank_b_deposits", "N02 F05 F06 F10 W01 P10 P09", B_DEPOSITS_SQL)
def bank_b_deposits(spark, d):
    return rates.bank_b_term_deposits(SLUG_DEPOSITS.df(spark, d)).select(*catalog.TERM_DEPOSITS.columns)


@workload("bank_c_deposits", "N03 P15 P08 F10", C_DEPOSITS_SQL)
def bank_c_deposits(spark, d):
    return rates.bank_c_term_deposits(FLAT_DEPOSITS.df(spark, d)).select(*catalog.TERM_DEPOSITS.columns)


DEPOSITS_SQL = f"{C_DEPOSITS_SQL} UNION ALL {A_DEPOSITS_SQL} UNION ALL {B_DEPOSITS_SQL}"


def _deposits(spark, d):
    return rates.term_deposits(sections(spark, d), SLUG_DEPOSITS.df(spark, d), FLAT_DEPOSITS.df(spark, d))


@workload("term_deposits", "E08 N01 N02 N03 U01", DEPOSITS_SQL)
def term_deposits(spark, d):
    return _deposits(spark, d)


A_LOANS_SQL = f"""SELECT 'ANZ' AS bank, 'Fixed Home Loan' AS product, CAST(1 + p_size % 5 AS BIGINT) AS loan_term,
        CASE WHEN ends_with({LOAN_TIER}, '<80%') THEN 0 ELSE 80 END AS min_lvr,
        CASE WHEN ends_with({LOAN_TIER}, '<80%') THEN 80 ELSE 100 END AS max_lvr, 0 AS min_loan,
        CAST(NULL AS BIGINT) AS max_loan, {DEC42.format(RATE_TEXT)} AS rate FROM part
        WHERE {LOAN_CODE} IN ('HOOHLSIR', 'HOOFR')"""
B_LOANS_SQL = f"""SELECT 'Macquarie' AS bank, 'Fixed Mortgage Basic' AS product,
        CAST(regexp_extract(title, '_([0-9]+)year_', 1) AS BIGINT) AS loan_term,
        CASE WHEN contains(title, 'lte70') THEN 0 WHEN contains(title, 'lte80') THEN 70 ELSE 80 END AS min_lvr,
        CASE WHEN contains(title, 'lte70') THEN 70 WHEN contains(title, 'lte80') THEN 80 ELSE 100 END AS max_lvr,
        0 AS min_loan, CAST(NULL AS BIGINT) AS max_loan, {DEC42.format("rtrim(value, '% pa')")} AS rate
        FROM {SLUG_LOANS.sql} WHERE title LIKE 'mort_basic_fix_%' AND ends_with(title, '0_rate')"""
_lows = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate((0, 150000, 250000, 500000, 750000, 1000000)))
_highs = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate((150000, 250000, 500000, 750000, 1000000)))
C_LOANS_SQL = f"""SELECT 'Westpac' AS bank, regexp_extract(product_id, '[0-9]Year[A-Za-z]+') AS product,
        CAST(substr(product_id, 1, 1) AS BIGINT) AS loan_term, min_lvr, max_lvr, min(low) AS min_loan, max(high) AS max_loan,
        rate FROM (SELECT {LOAN_PRODUCT_ID} AS product_id, {DEC42.format(RATE_TEXT)} AS rate,
            CASE {PORTFOLIO_ID} WHEN 'HLLVR3' THEN 0 WHEN 'HL' THEN 70 WHEN 'HLLVR5' THEN 80 END AS min_lvr,
            CASE {PORTFOLIO_ID} WHEN 'HLLVR3' THEN 70 WHEN 'HL' THEN 80 WHEN 'HLLVR5' THEN 100 END AS max_lvr,
            CASE p_partkey % 6 {_lows} END AS low, CASE p_partkey % 6 {_highs} END AS high
        FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 5 <> 0) GROUP BY 2, 3, min_lvr, max_lvr, rate"""


@workload("bank_a_loans", "N04 F02 F06 F23 F25 J11", A_LOANS_SQL)
def bank_a_loans(spark, d):
    return rates.bank_a_home_loans(sections(spark, d)).select(*catalog.HOME_LOAN_RATES.columns)


@workload("bank_b_loans", "N05 F05 F06", B_LOANS_SQL)
def bank_b_loans(spark, d):
    return rates.bank_b_home_loans(SLUG_LOANS.df(spark, d)).select(*catalog.HOME_LOAN_RATES.columns)


@workload("bank_c_loans", "N06 F24 F25 F06 P06 A07", C_LOANS_SQL)
def bank_c_loans(spark, d):
    return rates.bank_c_home_loans(portfolios(spark, d)).select(*catalog.HOME_LOAN_RATES.columns)


LOANS_SQL = f"{C_LOANS_SQL} UNION ALL {A_LOANS_SQL} UNION ALL {B_LOANS_SQL}"


def _loans(spark, d):
    return rates.home_loan_rates(sections(spark, d), SLUG_LOANS.df(spark, d), portfolios(spark, d))


@workload("home_loan_rates", "E09 N07 U01", LOANS_SQL)
def home_loan_rates(spark, d):
    return _loans(spark, d)


@workload("bank_slice", "E10 N09 P01 P08", f"SELECT * FROM ({DEPOSITS_SQL}) WHERE bank = 'Westpac'")
def bank_slice(spark, d):
    return rates.bank_slice(_deposits(spark, d), "Westpac", catalog.TERM_DEPOSITS)


@workload("term_rates_of_bank", "R07 P08", f"SELECT * FROM ({DEPOSITS_SQL}) WHERE bank = 'ANZ'")
def term_rates_of_bank(spark, d):
    return lookups.term_rates_of(_deposits(spark, d), "ANZ")


@workload("home_loans_of_bank", "R08 P08", f"SELECT * FROM ({LOANS_SQL}) WHERE bank = 'Macquarie'")
def home_loans_of_bank(spark, d):
    return lookups.home_loans_of(_loans(spark, d), "Macquarie")


@workload(
    "best_maturity_rates",
    "R12 A14 P13",
    f"""SELECT min_term, bank, max(maturity_rate) AS maturity_rate FROM ({DEPOSITS_SQL})
        WHERE min_term <= 12 AND maturity_rate IS NOT NULL GROUP BY 1, 2""",
)
def best_maturity_rates(spark, d):
    return lookups.best_maturity_rates(_deposits(spark, d))


@workload(
    "best_annual_rates",
    "R12 A14 P13",
    f"""SELECT min_term, bank, max(annual_rate) AS annual_rate FROM ({DEPOSITS_SQL})
        WHERE min_term >= 12 AND min_term < 60 AND annual_rate IS NOT NULL GROUP BY 1, 2""",
)
def best_annual_rates(spark, d):
    return lookups.best_annual_rates(_deposits(spark, d))


@workload(
    "best_monthly_rates",
    "R12 A14 P13",
    f"""SELECT min_term, bank, max(monthly_rate) AS monthly_rate FROM ({DEPOSITS_SQL})
        WHERE min_term BETWEEN 2 AND 12 AND maturity_rate IS NOT NULL GROUP BY 1, 2""",
)
def best_monthly_rates(spark, d):
    return lookups.best_monthly_rates(_deposits(spark, d))


@workload(
    "best_loan_rates",
    "R12 P12 A14",
    f"""SELECT CAST(t AS BIGINT) AS target_lvr, bank, loan_term, min(rate) AS rate FROM ({LOANS_SQL}),
        (VALUES (60), (70), (80), (95)) v(t) WHERE t > min_lvr AND t <= max_lvr GROUP BY 1, 2, 3""",
)
def best_loan_rates(spark, d):
    return lookups.best_loan_rates(_loans(spark, d), [60, 70, 80, 95])


@workload(
    "bracket_targets",
    "P12",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(t AS DOUBLE) AS target FROM lineitem, (VALUES (5.0), (20.0), (45.0)) v(t)
        WHERE t > l_quantity - 1 AND t <= l_quantity + 1""",
)
def bracket_targets(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity - 1 AS low", "l_quantity + 1 AS high"
    )
    return ranking.bracket_targets(rows, "low", "high", [5.0, 20.0, 45.0]).drop("low", "high")


OFFER = StandIn(
    "part",
    {
        "ProductId": f"'TermDeposit-' || {text('p_size')}",
        "Rates": "map('k', map('status', 'PUBLISHED', 'RATECODE', 'R' || CAST(p_size AS STRING), 'PRODUCT', p_name, "
        "'MinAmt', '5000', 'MaxAmt', '20000', 'MinTerm', CAST(p_size AS STRING), 'MaxTerm', '60', "
        "'Monthlyrate', '1.25', 'HotRate', '', 'EffectiveDate', '12/05/2023'))",
    },
)


@workload(
    "flat_deposit_feed",
    "U03 F26 P19",
    """SELECT 'TermDeposit-' || p_size AS product_id, 'PUBLISHED' AS status, 'R' || p_size AS rate_code, p_name AS product,
        '5000' AS min_amount, CAST(p_size AS VARCHAR) AS min_term, '60' AS max_term, '20000' AS max_amount,
        CAST(NULL AS VARCHAR) AS maturity_rate, '1.25' AS monthly_rate, '' AS hot_rate, '12/05/2023' AS effective_date
        FROM part UNION ALL SELECT 'TermDeposit-' || p_size, 'PUBLISHED', 'R' || p_size, p_name, '5000', CAST(p_size AS VARCHAR),
        '60', '20000', NULL, '1.25', '', '12/05/2023' FROM part WHERE p_type = 'PROMO'""",
)
def flat_deposit_feed(spark, d):
    all_products = OFFER.df(spark, d)
    offers = table(spark, d, "part").where("p_type = 'PROMO'").selectExpr(
        *[f"{e} AS `{n}`" for n, e in OFFER.columns.items()]
    )
    return rates.flat_deposit_feed(all_products, offers)


@workload("bank_names", "R06 S10", "SELECT DISTINCT 'Bank ' || n_name AS name FROM nation")
def bank_names(spark, d):
    return lookups.banks(table(spark, d, "nation").select(F.concat(F.lit("Bank "), "n_name").alias("name")))


@workload(
    "tier_brackets",
    "A07 W01",
    """SELECT brand, size, lead(size) OVER (PARTITION BY brand ORDER BY size) AS next_size, low, high FROM (
        SELECT p_brand AS brand, CAST(p_size AS BIGINT) AS size, min(p_retailprice) AS low, max(p_retailprice) AS high FROM part GROUP BY 1, 2)""",
)
def tier_brackets(spark, d):
    from harbormill.operators.aggregates import tier_brackets as collapse
    from harbormill.operators.windows import next_tier

    rows = table(spark, d, "part").selectExpr(
        "p_brand AS brand", "p_size AS size", "p_retailprice AS low", "p_retailprice AS high"
    )
    return next_tier(collapse(rows, ["brand", "size"], "low", "high"), ["brand"], "size", "next_size")


@workload(
    "orphan_share",
    "J04",
    """SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (c.c_custkey IS NULL) AS BIGINT) AS orphans FROM orders o
        LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') c ON o.o_custkey = c.c_custkey""",
)
def orphan_share(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("key"))
    customers = table(spark, d, "customer").where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("key"))
    return joins.orphan_count(orders, customers, "key")
