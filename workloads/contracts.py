"""Data-contract checks on the stand-in models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harbormill.models import catalog
from harbormill.operators.columns import conform
from harbormill.plans import risk
from harbormill.quality import checks
from harbormill.sinks.publish import gate
from workloads.inputs import ACCOUNT, ACTIVITY, MARKETS, PAYMENTS, TRANSACTIONS
from workloads.registry import check_sql, stamp, table, workload
from workloads.risk import DENSITY_SQL, FLAG, MARKET

AS_OF = dt.datetime(2001, 1, 1)
TOTAL = "count(*)"


def _bad(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


ACCOUNT_RULES_SQL = " UNION ALL ".join(
    [
        check_sql("null:email_opt_in", "account", TOTAL, _bad("email_opt_in IS NULL"), "WARNING", ACCOUNT.sql),
        check_sql("length:npi", "account", TOTAL, _bad("npi IS NULL OR length(CAST(npi AS VARCHAR)) <> 10"), "WARNING", ACCOUNT.sql),
        check_sql(
            "casing:first_name,last_name,status", "account", TOTAL, _bad("first_name <> upper(first_name[1]) || lower(first_name[2:])"),
            "WARNING", ACCOUNT.sql,
        ),
        check_sql("pattern:territory_id", "account", TOTAL, _bad("NOT regexp_full_match(territory_id, 'T-[0-9]')"), "WARNING", ACCOUNT.sql),
        check_sql("non_empty", "account", TOTAL, f"CASE WHEN {TOTAL} = 0 THEN 1 ELSE 0 END", "FAILED", ACCOUNT.sql),
    ]
)


def account_checks(rows):
    rules = [
        checks.is_null("email_opt_in"),
        checks.wrong_length("npi"),
        checks.wrong_casing(["first_name", "last_name", "status"]),
        checks.breaks_pattern("territory_id", "T-[0-9]"),
    ]
    return checks.check_rows(rows, "account", rules, nonempty=True)


@workload("quality_account", "Q01 Q06 Q08 Q09 Q28 A13 F08 F09", ACCOUNT_RULES_SQL)
def quality_account(spark, d):
    return account_checks(ACCOUNT.df(spark, d))


@workload(
    "quality_orphans",
    "Q07 J04",
    check_sql(
        "orphan:account_id", "activity", TOTAL, _bad("c.account_id IS NULL"), "WARNING",
        f"{ACTIVITY.sql} a LEFT JOIN (SELECT account_id FROM {ACCOUNT.sql} WHERE status = 'Active') c USING (account_id)",
    ),
)
def quality_orphans(spark, d):
    return checks.check_orphans(ACTIVITY.df(spark, d), ACCOUNT.df(spark, d).where("status = 'Active'"), "account_id", "activity")


@workload(
    "quality_inactive",
    "Q10 J05 F07",
    f"""SELECT 'inactive_with_children:account_id' AS check, 'account' AS model, CASE WHEN count(*) > 0 THEN 'WARNING' ELSE 'PASS' END
        AS status, count(activity_id) AS total, count(DISTINCT c.account_id) AS bad, 0.0::DOUBLE AS bad_pct
        FROM {ACCOUNT.sql} c JOIN {ACTIVITY.sql} a ON a.account_id = c.account_id WHERE upper(c.status) = 'INACTIVE'""",
)
def quality_inactive(spark, d):
    return checks.check_inactive_with_children(ACCOUNT.df(spark, d), ACTIVITY.df(spark, d), "account_id", "status", "account")


PII = " OR ".join(f"regexp_matches(text, '{p}')" for p in (checks.EMAIL, checks.PHONE, checks.NATIONAL_ID))


@workload(
    "quality_documents",
    "Q11 Q13 Q14",
    " UNION ALL ".join(
        [
            check_sql("pii:text", "documents", TOTAL, _bad(PII), "WARNING", "documents"),
            check_sql("unredacted:text", "documents", TOTAL, _bad("contains(text, '@')"), "FAILED", "documents"),
            check_sql(
                "extension:file", "documents", TOTAL, _bad("NOT ends_with(lower(file), '.pdf')"), "WARNING",
                "(SELECT source || CASE WHEN doc_id % 4 = 0 THEN '.doc' ELSE '.PDF' END AS file FROM documents)",
            ),
        ]
    ),
)
def quality_documents(spark, d):
    rows = table(spark, d, "documents").withColumn(
        "file", F.expr("source || CASE WHEN doc_id % 4 = 0 THEN '.doc' ELSE '.PDF' END")
    )
    rules = [checks.holds_pii("text"), checks.unredacted_email("text"), checks.wrong_extension("file")]
    return checks.check_rows(rows, "documents", rules)


@workload(
    "quality_freshness",
    "Q12 Q22 Q23 A16",
    " UNION ALL ".join(
        [
            check_sql("stale:o_orderdate", "orders", TOTAL, _bad("o_orderdate < TIMESTAMP '2000-01-02'"), "WARNING", "orders"),
            check_sql("latest:o_orderdate", "orders", TOTAL,
                      "CASE WHEN coalesce(max(o_orderdate) < TIMESTAMP '2000-12-31 14:00:00', true) THEN 1 ELSE 0 END", "FAILED", "orders"),
            check_sql("recent:o_orderdate", "orders", TOTAL, f"CASE WHEN {TOTAL} = 0 THEN 1 ELSE 0 END", "FAILED",
                      "(SELECT 1 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' - INTERVAL 180 DAY)"),
        ]
    ),
)
def quality_freshness(spark, d):
    rules = [
        checks.stale_row("o_orderdate", AS_OF),
        checks.newest_within("o_orderdate", AS_OF),
        checks.recent_rows("o_orderdate", AS_OF),
    ]
    return checks.check_rows(table(spark, d, "orders"), "orders", rules)


@workload(
    "quality_expected_values",
    "Q15 Q16 U04 A15",
    " UNION ALL ".join(
        [
            check_sql("domain:p_type", "part", TOTAL, _bad("p_type NOT IN ('SMALL', 'LARGE', 'ECONOMY', 'GIANT')"), "FAILED",
                      "(SELECT DISTINCT p_type FROM part)"),
            check_sql("domain:portfolio", "loans", TOTAL, "0", "FAILED", "(SELECT DISTINCT p_partkey % 3 FROM part)"),
        ]
    ),
)
def quality_expected_values(spark, d):
    rows = table(spark, d, "part")
    codes = rows.selectExpr("CASE p_partkey % 3 WHEN 0 THEN 'HLLVR3' WHEN 1 THEN 'HL' ELSE 'HLLVR5' END AS portfolio")
    return checks.all_checks(
        [
            checks.check_expected_values(rows, "p_type", ["SMALL", "LARGE", "ECONOMY", "GIANT"], "part"),
            checks.check_expected_values(codes, "portfolio", ["HLLVR3", "HL", "HLLVR5"], "loans"),
        ]
    )


@workload(
    "quality_raw_payments",
    "Q17 U06",
    check_sql("raw_payments:domain:category", "banksim_raw", TOTAL,
              _bad(f"{MARKET} NOT IN ({', '.join(repr(m) for m in MARKETS[:-1])})"), "FAILED", PAYMENTS.sql)
    + " UNION ALL SELECT 'raw_payments:required_columns', 'banksim_raw', 'FAILED', 10, 1, 10.0 FROM (SELECT 1 FROM orders LIMIT 1)",
)
def quality_raw_payments(spark, d):
    rows = PAYMENTS.df(spark, d)
    required = [c for c in checks.PAYMENT_COLUMNS if c != "zipMerchant"]
    first = checks.raw_payment_expectations(rows, MARKETS[:-1], required)
    return first.unionByName(checks.raw_payment_expectations(rows, MARKETS))


CLEAN_SQL = f"(SELECT trim(trim(category, '''')) AS category, {FLAG} <> 0 AS fraud, TRY_CAST(amount AS DOUBLE) AS amount FROM {PAYMENTS.sql})"


@workload(
    "quality_payments",
    "Q18",
    " UNION ALL ".join(
        [
            check_sql("blank:category", "banksim_transactions", TOTAL, _bad("coalesce(category, '') = ''"), "FAILED", CLEAN_SQL),
            check_sql("flag:fraud", "banksim_transactions", TOTAL, _bad("fraud IS NULL"), "FAILED", CLEAN_SQL),
            check_sql("negative:amount", "banksim_transactions", TOTAL, _bad("amount < 0"), "FAILED", CLEAN_SQL),
            check_sql("non_numeric:amount", "banksim_transactions", TOTAL, "0", "FAILED", CLEAN_SQL),
            check_sql("non_empty", "banksim_transactions", TOTAL, "0", "FAILED", CLEAN_SQL),
        ]
    ),
)
def quality_payments(spark, d):
    return checks.payment_quality(risk.clean_payments(PAYMENTS.df(spark, d)))


@workload(
    "quality_density",
    "Q19 Q25",
    f"SELECT 'required_columns' AS check, 'fraud_density' AS model, 'PASS' AS status, 4 AS total, 0 AS bad, 0.0::DOUBLE AS bad_pct UNION ALL "
    + " UNION ALL ".join(
        [
            check_sql("blank:market_type", "fraud_density", TOTAL, "0", "FAILED", f"({DENSITY_SQL})"),
            check_sql("not_positive:transaction_count", "fraud_density", TOTAL, _bad("transaction_count <= 0"), "FAILED", f"({DENSITY_SQL})"),
            check_sql("range:fraud_rate_pct", "fraud_density", TOTAL, _bad("fraud_rate_pct NOT BETWEEN 0 AND 100"), "FAILED", f"({DENSITY_SQL})"),
            check_sql("non_empty", "fraud_density", TOTAL, "0", "FAILED", f"({DENSITY_SQL})"),
            check_sql("unique:market_type", "fraud_density", TOTAL, "0", "FAILED", f"({DENSITY_SQL})"),
        ]
    ),
)
def quality_density(spark, d):
    return checks.density_quality(risk.fraud_density(PAYMENTS.df(spark, d)))


# what breaks each rule on payments, as expressions of the order behind a payment that both engines read
BROKEN = {
    "category": "CASE WHEN o_orderkey % 5 = 0 THEN ' ' WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'es_food' END",
    "fraud": "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'maybe' ELSE '1' END",
    "amount": "CASE WHEN o_orderkey % 4 = 0 THEN '-1.5' WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE '2.5' END",
}
SOUND = {"category": "'es_food'", "fraud": "'1'", "amount": "'2.5'"}


def _expectation(name: str, bad: str) -> str:
    return check_sql(f"raw_payments:{name}", "banksim_raw", TOTAL, _bad(bad), "FAILED", "orders")


@workload(
    "quality_raw_payments_each",
    "Q17",
    " UNION ALL ".join(
        [
            _expectation("blank:category", "o_orderkey % 5 = 0 OR o_orderkey % 7 = 0"),
            _expectation("null:fraud", "o_orderkey % 3 = 0"),
            _expectation("negative:amount", "o_orderkey % 4 = 0"),
            _expectation("domain:category", "true"),
        ]
    ),
)
def quality_raw_payments_each(spark, d):
    """One rule after the other is broken, so each is the first that is reported; the last by an unknown category."""
    orders, found = table(spark, d, "orders"), []
    others = [F.lit("x").alias(c) for c in checks.PAYMENT_COLUMNS if c not in SOUND]
    for broken in ("category", "fraud", "amount", None):
        columns = [F.expr(BROKEN[c] if c == broken else SOUND[c]).alias(c) for c in SOUND]
        amount = F.col("amount").try_cast("double").alias("amount")
        rows = orders.select(*columns, *others).select(*[amount if c == "amount" else c for c in checks.PAYMENT_COLUMNS])
        found.append(checks.raw_payment_expectations(rows, ["food"] if broken else ["tech"]))
    return checks.all_checks(found)


@workload(
    "quality_payments_broken",
    "Q18",
    " UNION ALL ".join(
        [
            check_sql("blank:category", "banksim_transactions", TOTAL, _bad("o_orderkey % 5 = 0 OR o_orderkey % 7 = 0"), "FAILED", "orders"),
            check_sql("flag:fraud", "banksim_transactions", TOTAL, _bad("o_orderkey % 3 = 0 OR o_orderkey % 11 = 0"), "FAILED", "orders"),
            check_sql("negative:amount", "banksim_transactions", TOTAL, _bad("o_orderkey % 4 = 0"), "FAILED", "orders"),
            check_sql("non_numeric:amount", "banksim_transactions", TOTAL, _bad("o_orderkey % 4 <> 0 AND o_orderkey % 9 = 0"), "FAILED", "orders"),
            check_sql("non_empty", "banksim_transactions", TOTAL, "0", "FAILED", "orders"),
            check_sql("non_empty", "nothing", "0", "1", "FAILED", "(SELECT 1 FROM orders LIMIT 1)"),
        ]
    ),
)
def quality_payments_broken(spark, d):
    rows = table(spark, d, "orders").select(*[F.expr(e).alias(c) for c, e in BROKEN.items()])
    empty = checks.payment_quality(rows.where("o_orderkey < 0")).where("check = 'non_empty'").withColumn("model", F.lit("nothing"))
    return checks.payment_quality(rows).unionByName(empty)


@workload(
    "quality_density_broken",
    "Q19",
    "SELECT 'required_columns' AS check, 'fraud_density' AS model, 'PASS' AS status, 4 AS total, 0 AS bad, 0.0::DOUBLE AS bad_pct UNION ALL "
    + " UNION ALL ".join(
        [
            check_sql("blank:market_type", "fraud_density", TOTAL, _bad("n_nationkey % 6 = 0"), "FAILED", "nation"),
            check_sql("not_positive:transaction_count", "fraud_density", TOTAL, _bad("n_nationkey <= 4"), "FAILED", "nation"),
            check_sql("range:fraud_rate_pct", "fraud_density", TOTAL, _bad("n_nationkey NOT BETWEEN 5 AND 15"), "FAILED", "nation"),
            check_sql("non_empty", "fraud_density", TOTAL, "0", "FAILED", "nation"),
            check_sql(
                "unique:market_type", "fraud_density", TOTAL, _bad("n > 1"), "FAILED",
                "(SELECT count(*) AS n FROM nation GROUP BY CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE substr(n_name, 1, 1) END)",
            ),
            "SELECT 'required_columns', 'no_rate', 'FAILED', 4, 1, 25.0 FROM (SELECT 1 FROM nation LIMIT 1)",
        ]
    ),
)
def quality_density_broken(spark, d):
    rows = table(spark, d, "nation").selectExpr(
        "CASE WHEN n_nationkey % 6 = 0 THEN ' ' ELSE lower(substr(n_name, 1, 1)) END AS market_type",
        "n_nationkey - 4 AS transaction_count",
        "1 AS fraud_event_count",
        "(n_nationkey - 5) * 10.0D AS fraud_rate_pct",
    )
    lacking = checks.density_quality(rows.drop("fraud_rate_pct")).withColumn("model", F.lit("no_rate"))
    return checks.density_quality(rows).unionByName(lacking)


@workload(
    "quality_unique",
    "Q19",
    check_sql("unique:p_name", "part", TOTAL, _bad("n > 1"), "FAILED", "(SELECT count(*) AS n FROM part GROUP BY lower(trim(p_name)))"),
)
def quality_unique(spark, d):
    return checks.check_unique(table(spark, d, "part"), "p_name", "part")


@workload(
    "quality_terms",
    "Q27 U04",
    " UNION ALL ".join(
        [
            check_sql("term:market_type", "fraud_density", TOTAL, "0", "WARNING", f"({DENSITY_SQL})"),
            check_sql("term:p_type", "part", TOTAL, TOTAL, "WARNING", "part"),
        ]
    ),
)
def quality_terms(spark, d):
    density = risk.fraud_density(PAYMENTS.df(spark, d))
    return checks.all_checks(
        [
            checks.check_rows(density, "fraud_density", [checks.outside_term("market_type", "market_type")]),
            checks.check_rows(table(spark, d, "part"), "part", [checks.outside_term("p_type", "category")]),
        ]
    )


@workload(
    "quality_schema",
    "Q25 Q02 Q01",
    """SELECT 'schema' AS check, 'transactions' AS model, 'PASS' AS status, 7 AS total, 0 AS bad, 0.0::DOUBLE AS bad_pct
        UNION ALL SELECT 'schema', 'anomalies', 'FAILED', 4, 1, 25.0
        UNION ALL SELECT 'non_empty', 'transactions', 'PASS', 1, 0, 0.0 FROM (SELECT 1 FROM events LIMIT 1)""",
)
def quality_schema(spark, d):
    rows = TRANSACTIONS.df(spark, d)
    return checks.all_checks(
        [
            checks.check_schema(conform(rows, catalog.TRANSACTIONS), catalog.TRANSACTIONS),
            checks.check_schema(rows.withColumn("date", F.col("date").cast("string")), catalog.ANOMALIES),
            checks.check_nonempty(rows, "transactions"),
        ]
    )


@workload(
    "quality_files",
    "Q20 Q21 Q03 Q05",
    """SELECT 'file_fresh' AS check, 'orders' AS model, 'FAILED' AS status, 1 AS total, 1 AS bad, 100.0::DOUBLE AS bad_pct FROM (SELECT 1 FROM orders LIMIT 1)
        UNION ALL SELECT 'file_fresh', 'part', 'WARNING', 1, 1, 100.0 UNION ALL SELECT 'file_fresh', 'nothing', 'FAILED', 0, 0, 0.0
        UNION ALL SELECT 'readable', 'orders', 'PASS', count(*), 0, 0.0 FROM orders UNION ALL SELECT 'readable', 'nothing', 'FAILED', 0, 0, 0.0""",
)
def quality_files(spark, d):
    far = dt.datetime(2100, 1, 1)
    return checks.all_checks(
        [
            checks.check_path_fresh(spark, f"{d}/orders.parquet", "orders", far),
            checks.check_path_fresh(spark, f"{d}/part.parquet", "part", far, severity=checks.WARNING),
            checks.check_path_fresh(spark, f"{d}/nothing.parquet", "nothing", far, severity=checks.WARNING),
            checks.check_readable(spark, f"{d}/orders.parquet", "orders"),
            checks.check_readable(spark, f"{d}/nothing.parquet", "nothing"),
        ]
    )


@workload(
    "publication_gate",
    "Q26 K14",
    f"""SELECT count(*) AS checks, count(*) FILTER (status = 'FAILED') AS failed, 1 AS missing, false AS published FROM ({ACCOUNT_RULES_SQL})""",
)
def publication_gate(spark, d):
    return gate(account_checks(ACCOUNT.df(spark, d)), ("non_empty", "schema"))


@workload(
    "quality_details",
    "Q06",
    f"""SELECT status, '{{"check":"' || "check" || '","model":"account","total":"' || total || '","bad":"' || bad || '","bad_pct":"' || bad_pct || '"}}' AS details
        FROM ({ACCOUNT_RULES_SQL})""",
)
def quality_details(spark, d):
    return checks.as_details(account_checks(ACCOUNT.df(spark, d)))
