"""Model-shaped inputs derived from the supplied tables.

A stand-in is a table, a list of expressions and an optional filter. The
expressions are valid in Spark SQL and in DuckDB, so both sides start from the
same rows. Nested feeds are built row by row: one input row gives one feed
document with a small fixed number of entries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from workloads.registry import table


@dataclass(frozen=True)
class StandIn:
    source: str
    columns: dict[str, str]
    where: str | None = None

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, self.source)
        if self.where:
            rows = rows.where(self.where)
        return rows.selectExpr(*[f"{e} AS `{n}`" for n, e in self.columns.items()])

    @property
    def sql(self) -> str:
        cols = ", ".join(f'{e} AS "{n}"' for n, e in self.columns.items())
        return f"(SELECT {cols} FROM {self.source}" + (f" WHERE {self.where})" if self.where else ")")


def text(e: str) -> str:
    return f"CAST({e} AS STRING)"


ACTIVITY = StandIn(
    "orders",
    {
        "activity_id": text("o_orderkey"),
        "account_id": text("o_custkey"),
        "rep_id": f"CASE WHEN o_custkey % 50 = 0 THEN 'mktg-01' ELSE 'R-' || {text('o_custkey % 50')} END",
        "territory_id": f"CASE WHEN o_custkey % 50 = 1 THEN 'T-MKT' ELSE 'T-' || {text('o_custkey % 7')} END",
        "activity_datetime": "o_orderdate",
        "activity_month": f"substr({text('o_orderdate')}, 1, 7)",
        "channel": "CASE o_orderpriority WHEN '1-URGENT' THEN 'F2F' WHEN '2-HIGH' THEN 'Email' "
        "WHEN '3-MEDIUM' THEN 'Remote' WHEN '4-NOT SPECIFIED' THEN 'Phone' ELSE 'Virtual Event' END",
        "activity_type": "CASE WHEN o_orderkey % 2 = 0 THEN 'Call' ELSE 'Detail' END",
        "product_discussed": f"'P' || {text('o_orderkey % 9')}",
        "detail_priority": "o_orderkey % 3",
        "duration_min": "o_orderkey % 60",
        "engagement_score": "CASE WHEN o_orderkey % 17 = 0 THEN NULL "
        "ELSE CAST(floor(o_totalprice) AS BIGINT) % 101 END",
        "response": "CASE o_orderstatus WHEN 'F' THEN 'Positive' WHEN 'O' THEN 'Negative' ELSE 'No Response' END",
        "on_preferred_channel": "(o_custkey % 5) = CAST(substr(o_orderpriority, 1, 1) AS INT) - 1",
        "sample_dropped": "o_orderkey % 4 = 0",
        "sample_quantity": "o_orderkey % 5",
        "estimated_cost_usd": "CAST(floor(o_totalprice / 100) AS BIGINT)",
        "next_best_action": "'Visit'",
        "follow_up_required": "o_orderkey % 3 = 0",
    },
)

ACCOUNT = StandIn(
    "customer",
    {
        "account_id": text("c_custkey"),
        "account_type": "'HCP'",
        "first_name": "CASE WHEN c_custkey % 10 = 0 THEN lower(c_mktsegment) "
        "ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END",
        "last_name": "c_name",
        "hco_name": "'Clinic'",
        "npi": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 19 ELSE 1000000000 + c_custkey END",
        "specialty": "c_mktsegment",
        "city": f"'City ' || {text('c_nationkey')}",
        "state": f"'S' || {text('c_nationkey % 5')}",
        "prescribing_decile": "CAST(c_custkey % 10 AS BIGINT)",
        "segment": "c_mktsegment",
        "account_value_tier": "CASE WHEN c_acctbal > 6000 THEN 'High' WHEN c_acctbal > 2000 THEN 'Medium' "
        "WHEN c_custkey % 19 = 0 THEN NULL ELSE 'Low' END",
        "potential_value_usd": "CAST(floor(c_acctbal * 10) AS BIGINT)",
        "actual_value_usd": "CAST(floor(c_acctbal * (c_custkey % 10)) AS BIGINT)",
        "preferred_channel": "'Email'",
        "email_opt_in": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 2 = 0 END",
        "target_flag": "'Y'",
        "territory_id": f"'T-' || {text('c_nationkey')}",
        "primary_rep_id": f"'R-' || {text('c_custkey % 50')}",
        "status": "CASE WHEN c_custkey % 20 = 0 THEN 'Inactive' ELSE 'Active' END",
    },
)

TRANSACTIONS = StandIn(
    "events",
    {
        "transaction_id": text("event_id"),
        "customer_id": f"CASE WHEN event_id % 53 = 0 THEN NULL ELSE {text('user_id')} END",
        "date": "ts",
        "type": "event_type",
        "amount": "CAST(floor(value * 100) AS BIGINT)",
        "merchant": f"'M' || {text('event_id % 30')}",
        "country_code": "CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_type END",
    },
)

HISTORY = StandIn(
    "lineitem",
    {
        "symbol": f"'S' || {text('l_suppkey')}",
        "date": "l_shipdate",
        "open": "l_quantity",
        "high": "l_quantity + 2",
        "low": "l_quantity - 1",
        "close": "CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 50 = 1 THEN 0.0 ELSE l_extendedprice END",
        "volume": "l_partkey",
        "dividends": "l_tax",
        "stock_splits": "l_discount",
    },
)

STATEMENTS = StandIn(
    "lineitem",
    {
        "metric": "CASE l_returnflag WHEN 'A' THEN 'net_income' WHEN 'R' THEN 'total_revenue' ELSE 'other' END",
        "date": "l_shipdate",
        "value": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice - 30000 END",
        "symbol": f"'S' || {text('l_suppkey')}",
    },
)


def _bank(key: str) -> str:
    return f"CASE {key} WHEN 0 THEN 'ANZ' WHEN 1 THEN 'Macquarie' WHEN 2 THEN 'Westpac' ELSE 'B' || {text(key)} END"


def _ticker(key: str) -> str:
    return f"CASE {key} WHEN 0 THEN 'ANZ.AX' WHEN 1 THEN 'MQG.AX' WHEN 2 THEN 'WBC.AX' ELSE 'B' || {text(key)} END"


DIVIDENDS = StandIn(
    "orders",
    {
        "bank": _bank("o_custkey % 40"),
        "payment_date": "CAST(o_orderdate AS DATE)",
        "dividend_per_share": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END",
    },
)

CASH_FLOWS = StandIn(
    "lineitem",
    {
        "metric": "CASE WHEN l_returnflag = 'N' THEN 'capital_expenditure' ELSE 'operating_cash_flow' END",
        "date": "l_shipdate",
        "value": "l_extendedprice",
        "symbol": _ticker("l_suppkey % 40"),
    },
)

MARKETS = "food health hotelservices transportation tech home fashion travel hyper".split()
_market = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MARKETS))
PAYMENTS = StandIn(
    "orders",
    {
        "step": f"CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE {text('o_orderkey % 180')} END",
        "customer": f"'''C' || {text('o_custkey')} || ''''",
        "age": f"'''' || {text('o_custkey % 7')} || ''''",
        "gender": "CASE WHEN o_custkey % 2 = 0 THEN '''M''' ELSE ' ''F'' ' END",
        "zipcodeOri": "'''28007'''",
        "merchant": f"'''M' || {text('o_custkey % 50')} || ''''",
        "category": f"'''es_' || upper(substr(CASE o_orderkey % 9 {_market} END, 1, 1)) || "
        f"substr(CASE o_orderkey % 9 {_market} END, 2) || ''''",
        "amount": f"CASE WHEN o_orderkey % 31 = 0 THEN 'bad' ELSE {text('o_totalprice')} END",
        "fraud": "CASE WHEN o_orderkey % 37 = 0 THEN 'x' WHEN o_orderstatus = 'F' AND o_custkey % 3 = 0 THEN '1' "
        "ELSE '0' END",
    },
)

# --- nested feeds from part ---------------------------------------------------

RATE_TEXT = f"{text('p_size % 7')} || '.' || {text('10 + p_partkey % 90')}"
TIER_TEXT = f"{text('p_size')} || ' to ' || {text('p_size + 3')} || ' months'"
SECTION_NAME = "CASE WHEN p_partkey % 4 = 3 THEN 'Other' ELSE 'Deposit accounts' END"
SECTION_ACTIVE = "CASE WHEN p_partkey % 10 = 0 THEN '0' ELSE '1' END"
PRODUCT_NAME = (
    "CASE p_partkey % 3 WHEN 0 THEN 'ANZ Term Deposit' WHEN 1 THEN 'ANZ Advance Notice Term Deposit' ELSE 'Saver' END"
)
PRODUCT_SHOWN = "CASE WHEN p_partkey % 7 = 0 THEN '0' ELSE '1' END"
LOAN_CODE = "CASE p_partkey % 3 WHEN 0 THEN 'HOOHLSIR' WHEN 1 THEN 'HOOFR' ELSE 'HOOVAR' END"
LOAN_TIER = (
    f"'Fixed ' || {text('1 + p_size % 5')} || CASE WHEN p_partkey % 2 = 0 THEN ' years LVR <80%' "
    "ELSE ' years LVR >80%' END"
)


def _rate(kind: str, value: str, tier: str) -> str:
    blank = ", ".join(f"'{c}', CAST(NULL AS STRING)" for c in ("code", "name", "isactive", "isfordisplay", "ratename"))
    return (
        f"named_struct({blank}, 'ratetype', '{kind}', 'ratevalue', {value}, 'ratesuffix', CAST(NULL AS STRING), "
        f"'ratenote', CAST(NULL AS STRING), 'tiername1', {tier}, 'tiername2', CAST(NULL AS STRING))"
    )


def _product(code: str, name: str, shown: str, rates: str) -> str:
    unused = ", ".join(
        f"'{c}', CAST(NULL AS STRING)"
        for c in ("tiergrouptitle1", "tiergrouptitle2", "subsectiondescription", "subsectiondisclaimer")
    )
    return (
        f"named_struct('code', {code}, 'name', {name}, 'isactive', '1', 'isfordisplay', {shown}, {unused}, "
        f"'baserate', {rates})"
    )


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank A feed: one section per part, three products, one of them without rates."""
    deposit_rates = ", ".join(
        [
            _rate("Monthly Interest", RATE_TEXT, TIER_TEXT),
            _rate("Annual Interest", f"'1.' || {text('10 + p_partkey % 90')}", TIER_TEXT),
            _rate("Interest at Maturity", f"'2.' || {text('10 + p_partkey % 90')}", TIER_TEXT),
            _rate("Annual Interest", "'9.99'", f"{TIER_TEXT} || ' (NOT IN USE)'"),
            _rate("Annual Interest", "'9.98'", "'90 to 120 days notice'"),
            _rate("Annual Interest", "'blank'", TIER_TEXT),
            _rate("Bonus Interest", "'9.97'", TIER_TEXT),
        ]
    )
    loan_rates = ", ".join(
        [_rate("Principal and Interest", RATE_TEXT, LOAN_TIER), _rate("Interest Only", "'9.96'", LOAN_TIER)]
    )
    products = ", ".join(
        [
            _product("'TD'", PRODUCT_NAME, PRODUCT_SHOWN, f"array({deposit_rates})"),
            _product(LOAN_CODE, "'Home loans'", "'1'", f"array({loan_rates})"),
            _product("'HOOFR'", "'ANZ Term Deposit'", "'1'", f"slice(array({loan_rates}), 1, 0)"),
        ]
    )
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS code",
        f"{SECTION_NAME} AS name",
        f"{SECTION_ACTIVE} AS isactive",
        "'1' AS isfordisplay",
        f"array({products}) AS subsection",
    )


SLUG_DEPOSITS = StandIn(
    "part",
    {
        "title": "'term_deposit_macquarie_bank_' || CASE p_partkey % 4 WHEN 0 THEN 'monthly' WHEN 1 THEN 'annually' "
        "WHEN 2 THEN 'maturity' ELSE 'bonus' END || '_' || "
        f"CASE WHEN p_size % 3 = 0 THEN {text('1 + p_size % 5')} || '_years' "
        f"WHEN p_size % 11 = 0 THEN 'at_call' ELSE {text('1 + p_size % 12')} || '_months' END || "
        "CASE WHEN p_partkey % 5 = 0 THEN '_1m' ELSE '' END",
        "value": RATE_TEXT,
    },
)

SLUG_LOANS = StandIn(
    "part",
    {
        "title": f"CASE WHEN p_partkey % 6 = 0 THEN 'mort_offset_fix_' ELSE 'mort_basic_fix_' END || "
        f"{text('1 + p_size % 5')} || 'year_tier1_lte' || "
        "CASE p_partkey % 4 WHEN 0 THEN '70' WHEN 1 THEN '80' WHEN 2 THEN '90' ELSE '95' END || '_rate'",
        "value": f"{RATE_TEXT} || CASE WHEN p_partkey % 2 = 0 THEN '% pa' ELSE '%' END",
    },
)

FLAT_DEPOSITS = StandIn(
    "part",
    {
        "product_id": "CASE p_partkey % 3 WHEN 0 THEN 'TermDeposit' WHEN 1 THEN 'DigitalPromo' "
        f"ELSE 'FixedInterestRate' END || '-5000~' || {text('p_size')}",
        "status": "'PUBLISHED'",
        "rate_code": f"CASE WHEN p_partkey % 6 = 0 THEN 'HR' ELSE '5000~' END || {text('p_size')}",
        "product": "p_name",
        "min_amount": "'5000'",
        "min_term": "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 9 = 1 THEN '0.25' "
        f"WHEN p_partkey % 9 = 2 THEN '0.5' ELSE {text('p_size % 24 + 1')} END",
        "max_term": f"CASE WHEN p_partkey % 8 = 0 THEN '' ELSE {text('p_size % 24 + 2 + p_partkey % 3')} END",
        "max_amount": "'2000000'",
        "maturity_rate": f"{text('1 + p_size % 7')} || '.' || {text('10 + p_partkey % 7')}",
        "monthly_rate": f"{text('p_size % 7')} || '.' || {text('10 + p_partkey % 7')}",
        "hot_rate": "''",
        "effective_date": "'12/05/2023'",
    },
)

PORTFOLIO_ID = "CASE p_partkey % 4 WHEN 0 THEN 'HLLVR3' WHEN 1 THEN 'HL' WHEN 2 THEN 'HLLVR5' ELSE 'HLX' END"
BAND_LABELS = ("<$150k", "$150k-$250k", "$250k-$500k", "$500k-$750k", "$750k-$1mil", "$1mil+")
BAND_LABEL = "CASE p_partkey % 6 " + " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(BAND_LABELS)) + " END"
LOAN_PRODUCT_ID = (
    f"{text('1 + p_size % 5')} || 'YearFixedOptions' || {text('p_partkey % 6')} || "
    "CASE WHEN p_partkey % 5 = 0 THEN '-InterestOnly' ELSE '' END"
)


def portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank C feed: one portfolio per part, two products, each with two rate codes."""

    def detail(code: str, rate: str) -> str:
        return f"{code}, map('PRODUCT', 'Fixed ' || {BAND_LABEL}, 'RATECODE', {code}, 'Std_Rate', {rate})"

    code = f"'PAHLFX' || {text('p_partkey % 10')}"
    fixed = f"map({detail(code, RATE_TEXT)}, {detail("'PAHLRR150'", "'9.95'")})"
    other = f"map({detail("'PAHLFX0'", "'9.94'")})"
    return table(spark, sf_dir, "part").selectExpr(
        f"{PORTFOLIO_ID} AS portfolioid",
        f"map('A', named_struct('ProductId', {LOAN_PRODUCT_ID}, 'Rates', {fixed}), "
        f"'B', named_struct('ProductId', '2YearRocket', 'Rates', {other})) AS products",
    )
