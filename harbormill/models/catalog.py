"""Every persisted model. Names and types are fixed values of the data contracts."""

from __future__ import annotations

from harbormill.models.registry import Field, Link, Model, Registry, dimension, join_to, primary_key


def same_as(target: str) -> tuple[Link, ...]:
    return (Link("SameAs", target),)


def derived(*targets: str) -> tuple[Link, ...]:
    return tuple(Link("Derived", t) for t in targets)


def term(name: str) -> tuple[Link, ...]:
    return (Link("GlossaryTerm", name),)


F = Field

# --- CRM --------------------------------------------------------------------

ACCOUNT = Model(
    "account",
    "Health care accounts with their segment, value and territory; one row per account.",
    (
        F("account_id", "string", "Account key", primary_key()),
        F("account_type", "string", "Person or organisation", dimension()),
        F("first_name", "string", "Given name"),
        F("last_name", "string", "Family name"),
        F("hco_name", "string", "Organisation name"),
        F("npi", "bigint", "Ten-digit provider number", dimension(pii=True)),
        F("specialty", "string", "Medical specialty", dimension()),
        F("city", "string", "City", dimension()),
        F("state", "string", "State code", dimension()),
        F("prescribing_decile", "bigint", "Prescribing decile, 1 to 10", dimension()),
        F("segment", "string", "Marketing segment", dimension()),
        F("account_value_tier", "string", "High, medium or low", dimension()),
        F("potential_value_usd", "bigint", "Addressable value in dollars"),
        F("actual_value_usd", "bigint", "Realised value in dollars"),
        F("preferred_channel", "string", "Preferred contact channel", dimension()),
        F("email_opt_in", "boolean", "Consent to e-mail"),
        F("target_flag", "string", "Target list membership", dimension()),
        F("territory_id", "string", "Territory of the account", dimension()),
        F("primary_rep_id", "string", "Owning representative", dimension()),
        F("status", "string", "Active or inactive", dimension()),
    ),
)

ACTIVITY = Model(
    "activity",
    "Field sales contacts; one row per activity, many per account.",
    (
        F("activity_id", "string", "Activity key", primary_key()),
        F("account_id", "string", "Account contacted", join_to("account", "account_id")),
        F("rep_id", "string", "Representative", dimension()),
        F("territory_id", "string", "Territory of the contact", dimension("activity_territory_id")),
        F("activity_datetime", "timestamp_ntz", "When it took place"),
        F("activity_month", "string", "Month of the contact, YYYY-MM", dimension()),
        F("channel", "string", "Contact channel", dimension()),
        F("activity_type", "string", "Call, detail, sample drop and so on", dimension()),
        F("product_discussed", "string", "Product", dimension()),
        F("detail_priority", "bigint", "Detail position"),
        F("duration_min", "bigint", "Duration in minutes"),
        F("engagement_score", "bigint", "Engagement, 0 to 100"),
        F("response", "string", "Outcome", dimension()),
        F("on_preferred_channel", "boolean", "Channel was the preferred one"),
        F("sample_dropped", "boolean", "A sample was left"),
        F("sample_quantity", "bigint", "Samples left"),
        F("estimated_cost_usd", "bigint", "Cost in dollars"),
        F("next_best_action", "string", "Suggested follow-up", dimension()),
        F("follow_up_required", "boolean", "Follow-up needed"),
    ),
)

ACCOUNT_COVERAGE = Model(
    "account_coverage",
    "Value gap and contact coverage per account.",
    (
        F("account_id", "string", "Account key", primary_key(), same_as("account.account_id")),
        F("account_value_tier", "string", links=same_as("account.account_value_tier")),
        F("segment", "string", links=same_as("account.segment")),
        F("specialty", "string", links=same_as("account.specialty")),
        F("territory_id", "string", links=same_as("account.territory_id")),
        F("potential_value_usd", "bigint", links=same_as("account.potential_value_usd")),
        F("actual_value_usd", "bigint", links=same_as("account.actual_value_usd")),
        F(
            "value_gap_usd",
            "bigint",
            "Potential minus actual",
            links=derived("account.potential_value_usd", "account.actual_value_usd"),
        ),
        F("realization_ratio", "decimal(6,4)", "Actual over potential"),
        F("touch_count", "bigint", "Activities", links=derived("activity.activity_id")),
        F("total_cost_usd", "bigint", "Cost of all activities", links=derived("activity.estimated_cost_usd")),
        F("avg_engagement_score", "decimal(6,2)", "Mean engagement", links=derived("activity.engagement_score")),
        F("positive_rate", "decimal(6,4)", "Share of positive outcomes", links=derived("activity.response")),
        F("coverage_flag", "string", "Coverage label"),
    ),
)

CHANNEL_EFFECTIVENESS = Model(
    "channel_effectiveness",
    "Engagement and cost per contact channel.",
    (
        F("channel", "string", links=same_as("activity.channel")),
        F("activity_count", "bigint"),
        F("avg_engagement_score", "decimal(6,2)", links=derived("activity.engagement_score")),
        F("positive_rate", "decimal(6,4)", links=derived("activity.response")),
        F("on_preferred_channel_rate", "decimal(6,4)", links=derived("activity.on_preferred_channel")),
        F("total_cost_usd", "bigint", links=derived("activity.estimated_cost_usd")),
        F("cost_per_positive_usd", "decimal(12,2)"),
    ),
)

MONTHLY_TRENDS = Model(
    "monthly_trends",
    "Engagement and channel mix per month.",
    (
        F("activity_month", "string", links=same_as("activity.activity_month")),
        F("activity_count", "bigint"),
        F("avg_engagement_score", "decimal(6,2)", links=derived("activity.engagement_score")),
        F("positive_rate", "decimal(6,4)", links=derived("activity.response")),
        F("f2f_share", "decimal(6,4)", "Share of face-to-face contacts", links=derived("activity.channel")),
        F("digital_share", "decimal(6,4)", "Share of digital contacts", links=derived("activity.channel")),
        F("total_cost_usd", "bigint", links=derived("activity.estimated_cost_usd")),
    ),
)

REP_TERRITORY_SCORECARD = Model(
    "rep_territory_scorecard",
    "Performance per representative and territory.",
    (
        F("rep_id", "string", links=same_as("activity.rep_id")),
        F("territory_id", "string", links=same_as("activity.territory_id")),
        F("is_hq_campaign", "boolean", "Head-office campaign rather than field work"),
        F("activity_count", "bigint"),
        F("distinct_accounts", "bigint", links=derived("activity.account_id")),
        F("avg_engagement_score", "decimal(6,2)", links=derived("activity.engagement_score")),
        F("positive_rate", "decimal(6,4)", links=derived("activity.response")),
        F("total_cost_usd", "bigint", links=derived("activity.estimated_cost_usd")),
        F("avg_cost_per_activity_usd", "decimal(12,2)", links=derived("activity.estimated_cost_usd")),
    ),
)

# --- bank finance -----------------------------------------------------------

DIVIDENDS = Model(
    "dividends",
    "Dividend payments per bank.",
    (
        F("bank", "string", "Bank name"),
        F("payment_date", "date", "Payment date"),
        F("dividend_per_share", "decimal(4,2)", "Amount per share"),
    ),
)


def _series(name: str, description: str) -> Model:
    return Model(
        name,
        description,
        (
            F("metric", "string", "Metric name in snake case"),
            F("date", "timestamp_ntz", "Reporting date"),
            F("value", "double", "Value"),
            F("symbol", "string", "Ticker"),
        ),
    )


INCOME_STATEMENTS = _series("income_statements", "Income statement lines in long form.")
CASH_FLOWS = _series("cash_flows", "Cash flow lines in long form.")
BALANCE_SHEETS = _series("balance_sheets", "Balance sheet lines in long form.")

SOURCE_DOCUMENTS = Model(
    "source_documents",
    "Index of source files.",
    (
        F("id", "int", "Record id"),
        F("filename", "string", "File name"),
        F("document_type", "string", "Kind of document"),
        F("url", "string", "Location"),
    ),
)

HISTORY = Model(
    "history",
    "Daily prices per ticker.",
    (
        F("symbol", "string", "Ticker"),
        F("date", "timestamp_ntz", "Trading day"),
        F("open", "double"),
        F("high", "double"),
        F("low", "double"),
        F("close", "double"),
        F("volume", "bigint"),
        F("dividends", "double"),
        F("stock_splits", "double"),
    ),
)

GROWTH = Model(
    "growth",
    "Yearly return with the latest statement known at that date.",
    (
        F("symbol", "string", links=same_as("history.symbol")),
        F("date", "timestamp_ntz", "Year end"),
        F("close", "double", links=derived("history.close")),
        F("annual_return", "double", links=derived("history.close")),
        F("net_income", "double", links=derived("income_statements.value")),
        F("total_revenue", "double", links=derived("income_statements.value")),
        F("revenue_growth", "double", links=derived("income_statements.value")),
        F("net_income_growth", "double", links=derived("income_statements.value")),
    ),
)

DIVIDEND_SUSTAINABILITY = Model(
    "dividend_sustainability",
    "Yearly dividend growth against operating cash flow growth.",
    (
        F("bank", "string", links=same_as("dividends.bank")),
        F("year", "int"),
        F("dividend_per_share", "decimal(4,2)", links=derived("dividends.dividend_per_share")),
        F("operating_cash_flow_thousands", "double", links=derived("cash_flows.value")),
        F("dividend_yield_trend", "double", links=derived("dividends.dividend_per_share")),
        F("ocf_trend", "double", links=derived("cash_flows.value")),
        F("dividend_growth_vs_ocf_growth", "double"),
        F("sustainability_flag", "string"),
    ),
)

DOCUMENTS = Model(
    "documents",
    "Chunked announcement text with metadata.",
    (F("type", "string"), F("page_content", "string"), F("metadata", "string")),
)

# --- bank rates -------------------------------------------------------------

RATE_FIELDS = (
    "code string, name string, isactive string, isfordisplay string, ratename string, ratetype string, "
    "ratevalue string, ratesuffix string, ratenote string, tiername1 string, tiername2 string"
)
SUBSECTION_FIELDS = (
    "code string, name string, isactive string, isfordisplay string, tiergrouptitle1 string, "
    "tiergrouptitle2 string, subsectiondescription string, subsectiondisclaimer string, "
    f"baserate array<struct<{RATE_FIELDS.replace(' string', ':string')}>>"
)
SUBSECTION_TYPE = "array<struct<" + SUBSECTION_FIELDS.replace(" string", ":string").replace(
    "baserate array", "baserate:array"
) + ">>"

SECTION_PRODUCTS = Model(
    "section_products",
    "Bank A feed: product sections with nested rate tables.",
    (
        F("code", "string"),
        F("name", "string"),
        F("isactive", "string"),
        F("isfordisplay", "string"),
        F("sectiondescription", "string"),
        F("sectioneffectivedate", "string"),
        F("sectioneffectivedateraw", "string"),
        F("informationurl", "string"),
        F("sectiondisclaimer", "string"),
        F("subsection", SUBSECTION_TYPE),
    ),
)

SLUG_TERM_DEPOSITS = Model(
    "slug_term_deposits",
    "Bank B feed: term deposit rates named by slug.",
    (F("title", "string"), F("value", "string")),
)
SLUG_HOME_LOANS = Model(
    "slug_home_loans",
    "Bank B feed: home loan rates named by slug.",
    (F("title", "string"), F("value", "string")),
)

FLAT_TERM_DEPOSITS = Model(
    "flat_term_deposits",
    "Bank C feed: term deposit rates, all text.",
    tuple(
        F(name, "string")
        for name in (
            "product_id",
            "status",
            "rate_code",
            "product",
            "min_amount",
            "min_term",
            "max_term",
            "max_amount",
            "maturity_rate",
            "monthly_rate",
            "hot_rate",
            "effective_date",
        )
    ),
)

PORTFOLIO_HOME_LOANS = Model(
    "portfolio_home_loans",
    "Bank C feed: home loan portfolios keyed by product and rate code.",
    (
        F("portfolioid", "string"),
        F("products", "map<string,struct<ProductId:string,Rates:map<string,map<string,string>>>>"),
    ),
)

TERM_DEPOSITS = Model(
    "term_deposits",
    "Comparable term deposit rates of all banks.",
    (
        F("name", "string"),
        F("bank", "string", links=same_as("banks.name")),
        F("min_amount", "bigint"),
        F("max_amount", "bigint"),
        F("min_term", "bigint", "Months"),
        F("max_term", "bigint", "Months"),
        F("monthly_rate", "decimal(4,2)", links=derived("flat_term_deposits.monthly_rate")),
        F("annual_rate", "decimal(4,2)", links=derived("flat_term_deposits.maturity_rate")),
        F("maturity_rate", "decimal(4,2)", links=derived("flat_term_deposits.maturity_rate")),
    ),
)

HOME_LOAN_RATES = Model(
    "home_loan_rates",
    "Comparable fixed home loan rates of all banks.",
    (
        F("bank", "string", links=same_as("banks.name")),
        F("product", "string"),
        F("loan_term", "bigint", "Years"),
        F("min_lvr", "bigint", "Lower loan-to-value bound, exclusive"),
        F("max_lvr", "bigint", "Upper loan-to-value bound, inclusive"),
        F("min_loan", "bigint"),
        F("max_loan", "bigint"),
        F("rate", "decimal(6,2)"),
    ),
)

BANKS = Model("banks", "Bank names.", (F("name", "string"),))

# --- risk -------------------------------------------------------------------

CARD_CUSTOMERS = Model(
    "card_customers",
    "Card holders; only the domain of the e-mail address is kept.",
    (F("customer_id", "string", "Customer key", primary_key()), F("email", "string", "E-mail domain")),
)

TRANSACTIONS = Model(
    "transactions",
    "Card transactions.",
    (
        F("transaction_id", "string", "Transaction key", primary_key()),
        F("customer_id", "string", "Customer", join_to("card_customers", "customer_id")),
        F("date", "timestamp_ntz", "When it took place"),
        F("type", "string"),
        F("amount", "bigint", "Cents"),
        F("merchant", "string"),
        F("country_code", "string"),
    ),
)

ANOMALIES = Model(
    "anomalies",
    "Transactions close in time but in different countries.",
    (
        F("transaction_id", "string", links=same_as("transactions.transaction_id")),
        F("customer_id", "string", links=same_as("transactions.customer_id")),
        F("date", "timestamp_ntz", links=same_as("transactions.date")),
        F("country_code", "string", links=same_as("transactions.country_code")),
    ),
)

BANKSIM_TRANSACTIONS = Model(
    "banksim_transactions",
    "Cleaned simulated payments.",
    (
        F("step", "bigint"),
        F("customer", "string"),
        F("age", "string"),
        F("gender", "string"),
        F("zipcode_ori", "string"),
        F("merchant", "string"),
        F("zip_merchant", "string"),
        F("category", "string"),
        F("amount", "double"),
        F("fraud", "boolean"),
    ),
)

FRAUD_DENSITY = Model(
    "fraud_density",
    "Share of fraudulent payments per market.",
    (
        F("market_type", "string", "Market", links=term("market_type")),
        F("transaction_count", "bigint"),
        F("fraud_event_count", "bigint", links=derived("banksim_transactions.fraud")),
        F("fraud_rate_pct", "double", "Percent", links=term("fraud_rate_pct")),
    ),
)

# --- documents --------------------------------------------------------------

COMPANIES = Model(
    "companies",
    "Listed companies.",
    (
        F("asx_code", "string"),
        F("company_name", "string"),
        F("gics_industry_group", "string"),
        F("listing_date", "date"),
        F("market_cap", "string"),
    ),
)

ANNOUNCEMENTS = Model(
    "announcements",
    "Company announcements and the path of each file.",
    (
        F("path", "string"),
        F("full_path", "string"),
        F("date", "timestamp"),
        F("document_key", "string"),
        F("file_size", "string"),
        F("headline", "string"),
        F("is_price_sensitive", "boolean"),
        F("symbol", "string"),
        F("url", "string"),
    ),
)

DISCLOSURES = Model(
    "disclosures",
    "Converted public documents.",
    (
        F("document_id", "string"),
        F("company", "string"),
        F("filename", "string"),
        F("url", "string"),
        F("pages", "bigint"),
        F("tables", "bigint"),
        F("doc_elements", "bigint"),
        F("document_hash", "string"),
        F("size", "bigint"),
        F("contents", "string"),
        F("processed_at", "timestamp_ntz"),
    ),
)

JIRA_ISSUE = Model(
    "jira_issue",
    "Issues with their free text.",
    tuple(
        F(name, "string")
        for name in ("id", "key", "project", "status", "summary", "description", "comments", "created", "updated")
    ),
)

ISSUE_EMBEDDINGS = Model(
    "jira_issue_embeddings",
    "Vector table of issue chunks.",
    (
        F("langchain_id", "string"),
        F("content", "string"),
        F("embedding", "array<float>"),
        F("langchain_metadata", "string"),
    ),
)

# --- catalog, weather, stream, trips ----------------------------------------

CATALOG_PRODUCTS = Model(
    "catalog_products",
    "Products scraped from a shop.",
    (
        F("product_id", "string"),
        F("name", "string"),
        F("category", "string", links=term("category")),
        F("price", "decimal(8,2)", links=term("price")),
        F("original_price", "decimal(8,2)", links=term("original_price")),
        F("description", "string"),
        F("brand", "string", links=term("brand")),
        F("product_url", "string"),
        F("scraped_at", "timestamp", links=term("scraped_at")),
    ),
)


def _weather(name: str, description: str) -> Model:
    return Model(
        name,
        description,
        (
            F("city", "string"),
            F("timestamp", "timestamp"),
            F("temperature_c", "double"),
            F("humidity_pct", "bigint"),
            F("wind_speed_kmh", "double"),
        ),
        "head",
    )


OPEN_METEO = _weather("open_meteo", "Current weather, first provider.")
WTTR = _weather("wttr", "Current weather, second provider.")
UNIFIED_WEATHER = Model(
    "unified_weather",
    "Current weather of all providers.",
    (
        *OPEN_METEO.fields,
        F("provider", "string"),
        F("process_timestamp", "timestamp"),
    ),
)

RATE_MODEL = Model("rate_model", "Increasing numbers.", (F("timestamp", "timestamp_ntz"), F("value", "bigint")))
OUTPUT_MODEL = Model(
    "output_model",
    "Increasing numbers with a message.",
    (F("timestamp", "timestamp_ntz"), F("value", "int"), F("message", "string")),
)

TRIP_METRICS = Model(
    "trip_metrics",
    "Trips per pickup zone.",
    (
        F("pickup_zip", "string", nullable=False),
        F("trip_count", "int", nullable=False),
        F("avg_fare", "double", nullable=False),
    ),
    "head",
)
PIPELINE_SUMMARY = Model(
    "pipeline_summary",
    "Outcome of each pipeline run.",
    (
        F("pipeline", "string", nullable=False),
        F("status", "string", nullable=False),
        F("rows_processed", "int", nullable=False),
    ),
    "head",
)

REGISTRY = Registry().add(*(m for m in list(globals().values()) if isinstance(m, Model)))
