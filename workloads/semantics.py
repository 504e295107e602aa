"""Metric queries over the CRM models, and the registry as data."""

from __future__ import annotations

from pyspark.sql import functions as F

from harbormill.models.catalog import REGISTRY
from harbormill.models.measure import measured_fields
from harbormill.models.registry import upstream
from harbormill.semantic import Filter, SemanticLayer
from harbormill.semantic.crm import VIEWS
from workloads.inputs import ACCOUNT, ACTIVITY
from workloads.registry import table, workload


def layer(spark, d) -> SemanticLayer:
    return SemanticLayer(REGISTRY, VIEWS, {"account": ACCOUNT.df(spark, d), "activity": ACTIVITY.df(spark, d)})


ACT = 'count(*) AS "ACTIVITY_COUNT", CAST(sum(estimated_cost_usd) AS BIGINT) AS "TOTAL_COST"'
SCORE = 'CAST(sum(engagement_score) AS DOUBLE) / count(engagement_score) AS "AVG_ENGAGEMENT_SCORE"'
JOINED = f"{ACTIVITY.sql} a LEFT JOIN (SELECT account_id, state, npi, status, segment FROM {ACCOUNT.sql}) c USING (account_id)"


@workload(
    "semantic_by_channel",
    "M03 M04 M06",
    f"SELECT channel, {ACT}, {SCORE} FROM {ACTIVITY.sql} GROUP BY channel",
)
def semantic_by_channel(spark, d):
    return layer(spark, d).query(["ACTIVITY_COUNT", "TOTAL_COST", "AVG_ENGAGEMENT_SCORE"], ["channel"])


@workload(
    "semantic_by_state",
    "M04 M07 J09",
    f"SELECT state, channel, {ACT} FROM {JOINED} WHERE segment IN ('MACHINERY', 'FURNITURE') AND response <> 'Negative' GROUP BY state, channel",
)
def semantic_by_state(spark, d):
    return layer(spark, d).query(
        ["ACTIVITY_COUNT", "TOTAL_COST"],
        ["state", "channel"],
        [Filter("segment", "in", ["MACHINERY", "FURNITURE"]), Filter("response", "!=", "Negative")],
    )


@workload(
    "semantic_two_territories",
    "M04 M05 J09",
    f"""SELECT c.territory_id, a.territory_id AS activity_territory_id, {SCORE} FROM {ACTIVITY.sql} a LEFT JOIN
        (SELECT account_id, territory_id FROM {ACCOUNT.sql}) c USING (account_id) WHERE a.activity_month >= '1999-01' GROUP BY 1, 2""",
)
def semantic_two_territories(spark, d):
    return layer(spark, d).query(
        ["AVG_ENGAGEMENT_SCORE"],
        ["territory_id", "activity_territory_id"],
        [Filter("activity_month", ">=", "1999-01")],
    )


@workload(
    "semantic_masked_pii",
    "M08 K15",
    f"""SELECT CASE WHEN npi IS NOT NULL THEN '*****' END AS npi, count(*) AS "ACCOUNT_COUNT",
        CAST(sum(actual_value_usd) AS BIGINT) AS "TOTAL_REVENUE" FROM {ACCOUNT.sql} GROUP BY 1""",
)
def semantic_masked_pii(spark, d):
    return layer(spark, d).query(["ACCOUNT_COUNT", "TOTAL_REVENUE"], ["npi"])


@workload(
    "semantic_totals",
    "M03 M04",
    f"""SELECT count(*) AS "ACCOUNT_COUNT", CAST(sum(potential_value_usd) AS BIGINT) AS "TOTAL_POTENTIAL_VALUE" FROM {ACCOUNT.sql}""",
)
def semantic_totals(spark, d):
    return layer(spark, d).query(["ACCOUNT_COUNT", "TOTAL_POTENTIAL_VALUE"])


@workload(
    "fanout_safety",
    "M07",
    f"SELECT status, {ACT} FROM {JOINED} GROUP BY status",
)
def fanout_safety(spark, d):
    """The dimension holds every account twice; the counts must not double."""
    accounts = ACCOUNT.df(spark, d)
    doubled = SemanticLayer(REGISTRY, VIEWS, {"account": accounts.unionAll(accounts), "activity": ACTIVITY.df(spark, d)})
    return doubled.query(["ACTIVITY_COUNT", "TOTAL_COST"], ["status"])


@workload(
    "model_inventory",
    "M01 M02",
    "SELECT 'account' AS model, 20 AS fields, 13 AS dimensions, 1 AS pii, count(*) AS row_count FROM customer",
)
def model_inventory(spark, d):
    """Registry entries beside the size of the table they describe."""
    fields = REGISTRY.describe_model(spark, "account").agg(
        F.count(F.lit(1)).alias("fields"), F.count("dimension").alias("dimensions"), F.count_if("pii").alias("pii")
    )
    listed = REGISTRY.list_models(spark).where("model = 'account'").select("model").scalar()
    rows = ACCOUNT.df(spark, d).agg(F.count(F.lit(1))).scalar()
    return fields.withColumns({"model": listed, "row_count": rows})


# The declared types and roles of an account that are not text dimensions.
ACCOUNT_TYPES = dict.fromkeys(("npi", "prescribing_decile", "potential_value_usd", "actual_value_usd"), "bigint") | {"email_opt_in": "boolean"}
ACCOUNT_ROLES = {"account_id": "primary_key"} | dict.fromkeys(
    ("first_name", "last_name", "hco_name", "potential_value_usd", "actual_value_usd", "email_opt_in"), "base"
)
# Values that were spoilt when the accounts were landed, and the column that was left out.
SPOILT = {"npi": "npi = 19", "email_opt_in": "status = 'Inactive'", "prescribing_decile": "prescribing_decile = 7"}
LEFT_OUT = "city"


def _field_sql(name: str) -> str:
    there = "false" if name == LEFT_OUT else "true"
    spoilt = SPOILT.get(name, "false")
    empty = "true" if name == LEFT_OUT else f'"{name}" IS NULL AND NOT coalesce({spoilt}, false)'
    return f"""SELECT '{name}' AS field, '{ACCOUNT_TYPES.get(name, "string")}' AS type, '{ACCOUNT_ROLES.get(name, "dimension")}' AS role,
        {there} AS present, count(*) AS total, count(*) FILTER ({empty}) AS nulls, count(*) FILTER ({spoilt}) AS unfit FROM {ACCOUNT.sql}"""


@workload("model_fit", "M01 M02", " UNION ALL ".join(_field_sql(n) for n in ACCOUNT.columns))
def model_fit(spark, d):
    """Every field of the declared model beside what the rows of a landed table hold for it."""
    accounts = ACCOUNT.df(spark, d)
    landed = {n: F.when(F.expr(SPOILT[n]), "n/a").otherwise(F.col(n).cast("string")) if n in SPOILT else F.col(n).cast("string") for n in ACCOUNT.columns}
    rows = accounts.select(*[c.alias(n.upper() if n == "npi" else n) for n, c in landed.items() if n != LEFT_OUT])
    return measured_fields(rows, REGISTRY["account"])


@workload(
    "column_links",
    "M09",
    """SELECT source, predicate, target, hops FROM (SELECT 'orders.o_7' AS source, 'SameAs' AS predicate, 'customer.c_' || o_custkey AS target,
        1 AS hops FROM orders WHERE o_orderkey = 7 UNION ALL SELECT 'customer.c_' || c_custkey, 'Derived', 'nation.n_' || c_nationkey, 2
        FROM customer WHERE c_custkey = (SELECT o_custkey FROM orders WHERE o_orderkey = 7))""",
)
def column_links(spark, d):
    orders = table(spark, d, "orders").selectExpr(
        "'orders' AS model",
        "'o_' || CAST(o_orderkey AS STRING) AS column",
        "'SameAs' AS predicate",
        "'customer.c_' || CAST(o_custkey AS STRING) AS target",
    )
    customers = table(spark, d, "customer").selectExpr(
        "'customer' AS model",
        "'c_' || CAST(c_custkey AS STRING) AS column",
        "'Derived' AS predicate",
        "'nation.n_' || CAST(c_nationkey AS STRING) AS target",
    )
    return upstream(orders.unionByName(customers), "orders", "o_7")
