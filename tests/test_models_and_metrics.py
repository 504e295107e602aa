from __future__ import annotations

import pytest
from conftest import rows

from harbormill.models import Field, Model, Registry, catalog, dimension
from harbormill.models.measure import measured_fields
from harbormill.models.registry import join_to, primary_key, upstream
from harbormill.semantic import Filter, Metric, MetricView, SemanticLayer
from harbormill.semantic.crm import VIEWS


def test_registry_lists_and_describes(spark):
    assert catalog.REGISTRY.list_models(spark).count() == len(catalog.REGISTRY.models) >= 35
    fields = {r["field"]: r for r in catalog.REGISTRY.describe_model(spark, "activity").collect()}
    assert fields["territory_id"]["dimension"] == "activity_territory_id"
    assert fields["account_id"]["role"] == "join" and fields["activity_id"]["role"] == "primary_key"
    with pytest.raises(KeyError, match="unknown model"):
        catalog.REGISTRY["nothing"]


def test_schema_carries_roles_and_comments(spark):
    npi = catalog.ACCOUNT.schema["npi"]
    assert npi.metadata["pii"] is True and npi.metadata["role"] == "dimension"
    assert catalog.ACTIVITY.schema["account_id"].metadata["references"] == "account.account_id"


def test_dimension_names_are_unique_across_models():
    first = Model("first", "", (Field("zone", "string", role=dimension()),))
    second = Model("second", "", (Field("zone", "string", role=dimension()),))
    with pytest.raises(ValueError, match="already used"):
        Registry().add(first, second)
    renamed = Model("second", "", (Field("zone", "string", role=dimension("other_zone")),))
    assert set(Registry().add(first, renamed).models) == {"first", "second"}


def test_metric_rules():
    with pytest.raises(ValueError, match="base field cannot be a metric"):
        MetricView("v", catalog.ACCOUNT, (Metric("npi", "sum", "npi"),))
    with pytest.raises(ValueError, match="only COUNT"):
        MetricView("v", catalog.ACCOUNT, (Metric("M", "sum", "*"),))
    with pytest.raises(ValueError, match="no field"):
        MetricView("v", catalog.ACCOUNT, (Metric("M", "sum", "nothing"),))


@pytest.fixture(scope="module")
def layer(spark):
    account = spark.createDataFrame(
        [("a", "T1", 5, "NY"), ("a", "T1", 5, "NY"), ("b", "T2", None, "LA")],
        "account_id string, territory_id string, npi bigint, state string",
    )
    activity = spark.createDataFrame(
        [("1", "a", "T9", 10, 4), ("2", "a", "T9", None, 5), ("3", "b", "T9", 30, 6), ("4", "zzz", "T8", 50, 7), ("5", None, "T8", 50, 7)],
        "activity_id string, account_id string, territory_id string, engagement_score bigint, estimated_cost_usd bigint",
    )
    return SemanticLayer(catalog.REGISTRY, VIEWS, {"account": account, "activity": activity})


def test_reaching_through_a_join_does_not_multiply(layer):
    got = layer.query(["ACTIVITY_COUNT", "TOTAL_COST", "AVG_ENGAGEMENT_SCORE"], ["territory_id"])
    assert rows(got) == [("T1", 2, 9, 10.0), ("T2", 1, 6, 30.0), (None, 2, 14, 50.0)]


def test_filters_on_own_and_reached_dimensions(layer):
    own = layer.query(["ACTIVITY_COUNT"], [], [Filter("activity_territory_id", "=", "T9")])
    assert rows(own) == [(3,)]
    reached = layer.query(["ACTIVITY_COUNT"], ["activity_territory_id"], [Filter("state", "=", "NY")])
    assert rows(reached) == [("T9", 2)]
    assert rows(layer.query(["ACTIVITY_COUNT"], [], [Filter("state", "=", "nowhere")])) == [(0,)]


def test_personal_dimensions_are_masked_unless_allowed(layer):
    masked = layer.query(["ACTIVITY_COUNT"], ["npi"])
    assert rows(masked) == [("*****", 2), (None, 3)]
    assert rows(layer.query(["ACTIVITY_COUNT"], ["npi"], allow_pii=True)) == [(5, 2), (None, 3)]


def test_unknown_names_are_rejected(layer):
    with pytest.raises(KeyError, match="cannot be sliced"):
        layer.query(["ACCOUNT_COUNT"], ["channel"])
    with pytest.raises(KeyError, match="no view"):
        layer.query(["ACCOUNT_COUNT", "ACTIVITY_COUNT"])
    with pytest.raises(ValueError, match="unknown operator"):
        layer.query(["ACTIVITY_COUNT"], [], [Filter("channel", "~", "x")])


def test_upstream_follows_links(spark):
    edges = catalog.REGISTRY.links(spark)
    chain = spark.createDataFrame(
        [(f"m{i}", "c", "Derived", f"m{i + 1}.c") for i in range(6)] + [("m6", "c", "SameAs", "m0.c")],
        "model string, column string, predicate string, target string",
    )
    reached = {(r["target"], r["hops"]) for r in upstream(chain, "m0", "c").collect()}
    assert reached == {(f"m{i}.c", i) for i in range(1, 7)} | {("m0.c", 7)}
    found = {(r["target"], r["hops"]) for r in upstream(edges, "dividend_sustainability", "bank").collect()}
    assert found == {("dividends.bank", 1)}
    assert ("activity.response", 1) in {
        (r["target"], r["hops"]) for r in upstream(edges, "account_coverage", "positive_rate").collect()
    }


def test_sums_of_doubles_are_exact_through_a_join(spark):
    sale = Model(
        "sale",
        "",
        (
            Field("shop", "string", role=join_to("shop", "shop")),
            Field("amount", "double"),
            Field("price", "decimal(20,2)"),
        ),
    )
    shop = Model("shop", "", (Field("shop", "string", role=primary_key()), Field("town", "string", role=dimension())))
    view = MetricView("sales", sale, (Metric("SUM", "sum", "amount"), Metric("MEAN", "avg", "amount"), Metric("PRICES", "sum", "price"), Metric("N", "count", "*")))
    rows_of_sales = [("a", 1e31, "0.10"), ("b", 1e-12, "0.20"), ("a", -1e31, None), ("b", None, "999999999999999999.99"), ("c", 2.5, "1.00")]
    sales = spark.createDataFrame(rows_of_sales, "shop string, amount double, p string").selectExpr("shop", "amount", "CAST(p AS DECIMAL(20,2)) AS price")
    shops = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "shop string, town string")
    layer = SemanticLayer(Registry().add(sale, shop), (view,), {"sale": sales.repartition(4), "shop": shops})
    got = rows(layer.query(["SUM", "MEAN", "PRICES", "N"], ["town"]))
    assert got == [("x", 1e-12, 1e-12 / 3, 1e18, 4), ("y", 2.5, 2.5, 1.0, 1)]


def test_models_are_measured_against_rows(spark):
    model = Model("m", "", (Field("id", "bigint", role=primary_key()), Field("day", "date"), Field("gone", "string"), Field("ok", "double")))
    landed = spark.createDataFrame([("1", "2024-02-30", 1.0), ("x", "2024-02-29", None), (None, None, 2.0)], "ID string, day string, ok double")
    got = [tuple(r) for r in measured_fields(landed, model).collect()]
    assert got == [
        ("id", "bigint", "primary_key", True, 3, 1, 1),
        ("day", "date", "base", True, 3, 1, 1),
        ("gone", "string", "base", False, 3, 3, 0),
        ("ok", "double", "base", True, 3, 1, 0),
    ]
    assert {r.total + r.nulls + r.unfit for r in measured_fields(landed.limit(0), model).collect()} == {0}
