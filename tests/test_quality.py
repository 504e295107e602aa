from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.models import catalog
from harbormill.operators.columns import conform
from harbormill.plans import crm, rates, risk, weather
from harbormill.quality import checks
from harbormill.session import shared_dir
from harbormill.sinks import files as file_sinks
from harbormill.sinks import tables as sinks
from harbormill.sinks.publish import PublicationBlocked, gate, publish_if_pass
from harbormill.sources import files

AS_OF = dt.datetime(2025, 1, 1)


def verdicts(results):
    return {r["check"]: (r["status"], r["total"], r["bad"], r["bad_pct"]) for r in results.collect()}


def test_row_rules_in_one_pass(spark):
    data = [
        ("carlos", None, 19, "a@x.example", "f.PDF", dt.datetime(2023, 1, 1)),
        ("Ann", True, 1234567890, "x.example", "f.doc", None),
        ("Bob", False, None, None, None, dt.datetime(2024, 12, 31)),
    ]
    df = spark.createDataFrame(
        data, "name string, opt boolean, npi bigint, email string, file string, at timestamp_ntz"
    )
    rules = [
        checks.is_null("opt"),
        checks.wrong_length("npi"),
        checks.wrong_casing(["name"]),
        checks.unredacted_email("email"),
        checks.wrong_extension("file"),
        checks.stale_row("at", AS_OF),
        checks.holds_pii("email"),
        checks.breaks_pattern("name", "[A-Z].*"),
    ]
    results = checks.check_rows(df, "m", rules, nonempty=True)
    assert verdicts(results) == {
        "null:opt": ("WARNING", 3, 1, 33.33),
        "length:npi": ("WARNING", 3, 2, 66.67),
        "casing:name": ("WARNING", 3, 1, 33.33),
        "unredacted:email": ("FAILED", 3, 1, 33.33),
        "extension:file": ("WARNING", 3, 1, 33.33),
        "stale:at": ("WARNING", 3, 1, 33.33),
        "pii:email": ("WARNING", 3, 1, 33.33),
        "pattern:name": ("WARNING", 3, 1, 33.33),
        "non_empty": ("PASS", 3, 0, 0.0),
    }
    # all rules of a table share one scan
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "a string")
    assert verdicts(checks.check_rows(df, "m", [checks.is_null("a")], nonempty=True)) == {
        "null:a": ("PASS", 0, 0, 0.0),
        "non_empty": ("FAILED", 0, 1, 0.0),
    }
    assert verdicts(checks.check_nonempty(df, "m"))["non_empty"][0] == "FAILED"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("write to ann.lee@mail.example.org now", True),
        ("call +61 2 9999 1234", True),
        ("id 123-45-6789", True),
        ("the ratio 12-34 and v1.2.3", False),
        ("user@localhost", False),
    ],
)
def test_personal_data_patterns(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert (verdicts(checks.check_rows(df, "m", [checks.holds_pii("t")]))["pii:t"][2] == 1) is expected


def test_payment_contracts(spark):
    raw = [("'es_food'", "1", "5.0"), (" ", "0", "-1"), ("'es_moon'", None, "x")]
    df = spark.createDataFrame(raw, "category string, fraud string, amount string")
    only = ["category", "fraud", "amount"]
    first = checks.raw_payment_expectations(df, ["food"], only)
    assert [(r["check"], r["bad"]) for r in first.collect()] == [("raw_payments:blank:category", 1)]
    good = df.where("fraud IS NOT NULL AND trim(category) <> ''")
    assert checks.raw_payment_expectations(good, ["food"], only).collect()[0]["status"] == "PASS"
    assert checks.raw_payment_expectations(good, ["food"]).collect()[0]["check"].endswith("required_columns")
    everything = verdicts(checks.payment_quality(df))
    assert {k: v[2] for k, v in everything.items()} == {
        "blank:category": 1,
        "flag:fraud": 1,
        "negative:amount": 1,
        "non_numeric:amount": 1,
        "non_empty": 0,
    }


def test_density_contract_and_ranking(spark):
    raw = [("'es_food'", "1"), ("'es_Food'", "0"), ("'es_tech'", "0"), ("'es_home'", "?"), (None, "1")]
    density = risk.fraud_density(spark.createDataFrame(raw, "category string, fraud string"))
    assert [tuple(r) for r in density.collect()] == [("food", 2, 1, 50.0), ("home", 1, 0, 0.0), ("tech", 1, 0, 0.0)]
    assert {v[0] for v in verdicts(checks.density_quality(density)).values()} == {"PASS"}
    broken = density.unionByName(density.limit(1)).withColumn("fraud_rate_pct", F.lit(101.0))
    got = verdicts(checks.density_quality(broken.withColumn("market_type", F.concat(F.lit(" "), "market_type"))))
    assert got["unique:market_type"][0] == "FAILED" and got["range:fraud_rate_pct"][2] == 4
    assert verdicts(checks.density_quality(density.drop("market_type")))["required_columns"][0] == "FAILED"


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 31, 20),)], "at timestamp_ntz")
    assert checks.check_latest(df, "at", "m", AS_OF).collect()[0]["status"] == "PASS"
    assert checks.check_latest(df, "at", "m", AS_OF + dt.timedelta(hours=7)).collect()[0]["status"] == "FAILED"
    assert checks.check_latest(df.limit(0), "at", "m", AS_OF).collect()[0]["status"] == "FAILED"
    assert checks.check_recent_rows(df, "at", "m", AS_OF).collect()[0]["total"] == 1
    assert checks.check_recent_rows(df, "at", "m", AS_OF + dt.timedelta(days=200)).collect()[0]["status"] == "FAILED"


def test_file_freshness(spark):
    path = shared_dir(spark, "fresh")
    file_sinks.write_parquet(spark.range(3), path)
    listing = files.file_listing(spark, path)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert checks.check_files_fresh(listing, "m", now).collect()[0]["status"] == "PASS"
    late = checks.check_files_fresh(listing, "m", now + dt.timedelta(days=2), severity=checks.WARNING)
    assert late.collect()[0]["status"] == "WARNING"


def test_json_presence(spark):
    path = shared_dir(spark, "json")
    spark.createDataFrame([('{"a":1}',)], "value string").write.text(f"{path}/lines")
    spark.createDataFrame([("[",), ('{"a":1},',), ('{"a":2}',), ("]",)], "value string").coalesce(1).write.text(f"{path}/pretty")
    spark.createDataFrame([("[]",)], "value string").write.text(f"{path}/empty")
    spark.createDataFrame([("nonsense",)], "value string").write.text(f"{path}/bad")
    status = lambda name: checks.check_json_nonempty(spark, f"{path}/{name}", "m").collect()[0]["status"]
    assert [status(n) for n in ("lines", "pretty", "empty", "bad")] == ["PASS", "PASS", "WARNING", "FAILED"]


def test_expected_values_and_terms(spark):
    df = spark.createDataFrame([("Westpac",), ("ANZ",), ("Other",), (None,)], "bank string")
    assert verdicts(checks.check_expected_values(df, "bank", ["Westpac", "ANZ"], "m"))["domain:bank"][:3] == ("FAILED", 4, 2)
    fewer = df.where("bank = 'ANZ'")
    assert verdicts(checks.check_expected_values(fewer, "bank", ["Westpac", "ANZ"], "m"))["domain:bank"][0] == "PASS"
    shop = spark.createDataFrame([("Apparel",), ("Toys",), (None,)], "category string")
    assert verdicts(checks.check_rows(shop, "m", [checks.outside_term("category", "category")]))["term:category"][2] == 1
    with pytest.raises(ValueError, match="any value"):
        checks.outside_term("price", "price")


def test_schema_check(spark):
    good = spark.createDataFrame([], catalog.DIVIDENDS.schema)
    assert checks.check_schema(good, catalog.DIVIDENDS).collect()[0]["status"] == "PASS"
    wrong = good.withColumn("payment_date", F.col("payment_date").cast("string"))
    assert checks.check_schema(wrong, catalog.DIVIDENDS).collect()[0]["bad"] == 1


# --- publication and sinks ----------------------------------------------------


def place(spark, name):
    return f"{name}_{dt.datetime.now().strftime('%H%M%S%f')}", shared_dir(spark, name)


def test_publication_stops_on_failed_or_missing_checks(spark):
    name, path = place(spark, "pub")
    contract = lambda d: checks.check_rows(d, "m", [checks.is_null("k", checks.FAILED), checks.is_null("v")])
    first = publish_if_pass(spark.createDataFrame([(1, None)], "k int, v int"), contract, name, location=path)
    assert first.rows == 1 and ("null:v", "WARNING") in first.results
    with pytest.raises(PublicationBlocked, match="null:k"):
        publish_if_pass(spark.createDataFrame([(None, 2)], "k int, v int"), contract, name)
    with pytest.raises(PublicationBlocked, match="schema"):
        publish_if_pass(spark.createDataFrame([(5, 2)], "k int, v int"), contract, name, ("schema",))
    assert rows(spark.table(name)) == [(1, None)]


def test_gate_row(spark):
    results = checks.check_rows(spark.createDataFrame([(1,)], "a int"), "m", [checks.is_null("a")])
    assert gate(results, ("null:a",)).collect()[0]["published"] is True
    assert gate(results, ("null:a", "other")).collect()[0]["published"] is False


def test_strict_csv_aborts_on_bad_rows(spark):
    path = shared_dir(spark, "csv")
    spark.createDataFrame([("id,n",), ("1,2",), ("NULL,",), ('"a, b",7',)], "value string").coalesce(1).write.text(f"{path}/good")
    schema = T.StructType.fromDDL("id string, n bigint")
    assert rows(files.read_csv_strict(spark, f"{path}/good", schema)) == [("1", 2), ("a, b", 7), (None, None)]
    spark.createDataFrame([("id,n",), ("1,x",)], "value string").coalesce(1).write.text(f"{path}/bad")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_csv_strict(spark, f"{path}/bad", schema).collect()
    spark.createDataFrame([("id,n",), ("1,2,3",)], "value string").coalesce(1).write.text(f"{path}/wide")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv_strict(spark, f"{path}/wide", schema).collect()


def test_upsert_is_idempotent(spark):
    name, path = place(spark, "ups")
    ddl = "id string, v int, version int"
    sinks.upsert_by_id(spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], ddl), name, ["id"], ["version"], path)
    change = spark.createDataFrame([("b", 9, 3), ("b", 8, 2), ("c", 1, 1)], ddl)
    for _ in range(2):
        sinks.upsert_by_id(change, name, ["id"], ["version"], path)
        assert rows(spark.table(name)) == [("a", 1, 1), ("b", 9, 3), ("c", 1, 1)]


def test_refresh_keeps_schema_and_append_counts(spark):
    name, path = place(spark, "ref")
    sinks.provision_table(spark, catalog.BANKS, name, path)
    df = spark.createDataFrame([("x",), ("y",)], "name string")
    assert sinks.refresh_table(df, name) == 2
    assert sinks.refresh_table(df.limit(1), name) == 1
    assert sinks.append_table(df, name) == 2
    assert spark.table(name).count() == 3
    assert sinks.copy_if_any(df.limit(0), name) is False and spark.table(name).count() == 3


def test_by_extension_rejects_others(spark):
    with pytest.raises(ValueError, match="neither"):
        files.read_by_extension(spark, "/x/y.orc")


# --- a few product rules on hand-made rows ------------------------------------


def test_channel_effectiveness_on_hand_made_rows(spark):
    ddl = "channel string, engagement_score bigint, response string, on_preferred_channel boolean, estimated_cost_usd bigint"
    data = [
        ("F2F", 61, "Positive", True, 100),
        ("F2F", 62, "Negative", False, 101),
        ("F2F", None, "Positive", None, 100),
        ("Email", 10, "No Response", True, 7),
    ]
    got = {r["channel"]: r for r in crm.channel_effectiveness(spark.createDataFrame(data, ddl)).collect()}
    f2f = got["F2F"]
    assert (f2f["activity_count"], float(f2f["avg_engagement_score"]), float(f2f["positive_rate"])) == (3, 61.5, 0.6667)
    assert (float(f2f["on_preferred_channel_rate"]), f2f["total_cost_usd"], float(f2f["cost_per_positive_usd"])) == (0.3333, 301, 150.5)
    assert float(got["Email"]["cost_per_positive_usd"]) == 0.0


def test_accounts_without_activity_are_kept(spark):
    account = conform(
        spark.createDataFrame([("a", "High", 1000, 100), ("b", "Low", 0, 5)], "account_id string, account_value_tier string, potential_value_usd bigint, actual_value_usd bigint")
        .withColumns({c: F.lit(None).cast("string") for c in ("segment", "specialty", "territory_id")})
        .select("*", *[F.lit(None).alias(c) for c in catalog.ACCOUNT.columns if c not in ("account_id", "account_value_tier", "potential_value_usd", "actual_value_usd", "segment", "specialty", "territory_id")]),
        catalog.ACCOUNT,
    )
    activity = spark.createDataFrame([], catalog.ACTIVITY.schema)
    got = {r["account_id"]: r for r in crm.account_coverage(account, activity).collect()}
    assert got["a"]["coverage_flag"] == "Under-served high-value" and got["a"]["touch_count"] == 0
    assert got["a"]["value_gap_usd"] == 900 and float(got["b"]["realization_ratio"]) == 0.0


def test_slug_terms_strict_and_as_the_feed_reads_them(spark):
    slugs = spark.createDataFrame(
        [
            ("term_deposit_macquarie_bank_monthly_12_months", "4.10"),
            ("term_deposit_macquarie_bank_monthly_3_months", "4.00"),
            ("term_deposit_macquarie_bank_maturity_1_year_1m", "4.50"),
            ("term_deposit_macquarie_bank_other_1_year", "9.99"),
        ],
        "title string, value string",
    )
    loose = {(r["min_term"], r["min_amount"]): r for r in rates.bank_b_term_deposits(slugs, strict=False).collect()}
    assert set(loose) == {(2, 5000), (3, 5000), (12, 1000001)} and loose[2, 5000]["max_term"] == 3
    strict = {(r["min_term"], r["min_amount"]): r for r in rates.bank_b_term_deposits(slugs).collect()}
    assert set(strict) == {(3, 5000), (12, 5000), (12, 1000001)} and strict[3, 5000]["max_term"] == 12
    assert strict[12, 5000]["name"] == "term-deposit-12months-5000"


def test_weather_times_are_utc(spark):
    body = '{"current": {"time": "2024-05-01T10:00", "temperature_2m": 1, "relative_humidity_2m": 50, "wind_speed_10m": 2.5}}'
    landed = spark.createDataFrame([("Oslo", body), ("Rome", body.replace("10:00", "10:00:00+02:00"))], "city string, value string")
    got = {r["city"]: r["t"] for r in weather.first_provider(landed).selectExpr("city", "date_format(timestamp, 'HH:mm') AS t").collect()}
    assert got == {"Oslo": "10:00", "Rome": "08:00"}
