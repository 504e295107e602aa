"""Skew-proof operators against brute force on small random data."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows

from harbormill.models import catalog
from pyspark.sql import functions as F

from harbormill.functions.temporal import epoch_seconds
from harbormill.operators.asof import asof_join, asof_scan, measured_slice
from harbormill.operators.interval import conflicts_within
from harbormill.plans.risk import suspicious_transactions

START = dt.datetime(2025, 7, 4, 9, 0, 0)


def seconds(n: float) -> dt.datetime:
    return START + dt.timedelta(seconds=n)


def transactions(spark, data):
    ddl = "transaction_id string, customer_id string, date timestamp_ntz, country_code string"
    return spark.createDataFrame(data, ddl)


def flagged(spark, data):
    return {r["transaction_id"] for r in suspicious_transactions(transactions(spark, data)).collect()}


def brute_force(data, reach=3600):
    out = set()
    for a in data:
        for b in data:
            if a[1] == b[1] and abs((a[2] - b[2]).total_seconds()) <= reach and a[3] != b[3]:
                out.add(a[0])
    return out


@pytest.mark.parametrize(
    ("data", "expected"),
    [
        ([("1", "c", seconds(600), "AU"), ("2", "c", seconds(2100), "FR"), ("3", "c", seconds(3000), "AU")], {"1", "2", "3"}),
        ([("1", "c", seconds(0), "AU"), ("2", "c", seconds(3600), "FR")], {"1", "2"}),
        ([("1", "c", seconds(0), "AU"), ("2", "c", seconds(3601), "FR")], set()),
        ([("1", "c", seconds(0), None), ("2", "c", seconds(5), "AU")], {"1", "2"}),
        ([("1", "c", seconds(0), None), ("2", "c", seconds(5), None)], set()),
        ([("1", "c", seconds(0), ""), ("2", "c", seconds(5), None)], {"1", "2"}),
        ([("1", "c", seconds(0), "AU"), ("2", "d", seconds(5), "FR")], set()),
        ([("1", None, seconds(0), "AU"), ("2", None, seconds(5), "FR")], {"1", "2"}),
    ],
)
def test_known_cases(spark, data, expected):
    assert flagged(spark, data) == expected


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(spark, seed):
    rng = random.Random(seed)
    countries = ["AU", "FR", "NZ", None]
    data = [
        (
            str(i),
            # one customer holds about half of the rows
            rng.choice(["hot", "hot", "hot", "a", "b", None]),
            seconds(rng.uniform(0, 400_000) if seed != 3 else rng.randrange(0, 40) * 1800),
            rng.choices(countries, weights=[12, 1, 1, 1])[0],
        )
        for i in range(500)
    ]
    assert flagged(spark, data) == brute_force(data)


def test_rows_are_returned_once_and_in_order(spark):
    data = [("1", "c", seconds(9), "AU"), ("1", "c", seconds(9), "AU"), ("2", "c", seconds(5), "FR")]
    found = [tuple(r) for r in suspicious_transactions(transactions(spark, data)).collect()]
    assert found == [("2", "c", seconds(5), "FR"), ("1", "c", seconds(9), "AU")]
    assert suspicious_transactions(transactions(spark, data)).columns == catalog.ANOMALIES.columns


def test_operator_keeps_duplicates_and_other_columns(spark):
    data = [("1", "c", seconds(9), "AU"), ("1", "c", seconds(9), "AU"), ("2", "c", seconds(5), "FR")]
    found = conflicts_within(transactions(spark, data), "customer_id", "date", "country_code")
    assert found.count() == 3


def naive_asof(left, right):
    out = []
    for key, at, name in left:
        best = None
        for rkey, rat, value in right:
            if rkey == key and rat <= at and (best is None or (rat, value) > best):
                best = (rat, value)
        out.append((key, at, name, None if best is None else best[1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_seconds", [60, 3600, 86_400])
@pytest.mark.parametrize("unique", [False, True])
def test_asof_against_brute_force(spark, slice_seconds, unique):
    rng = random.Random(slice_seconds)
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c"])
    moment = lambda: seconds(rng.randrange(0, 5000) * 97)
    left = [(key(), moment(), i) for i in range(300)]
    right = [(key(), moment(), rng.randrange(1000)) for _ in range(200)]
    if unique:
        left = list({(k, t): (k, t, i) for k, t, i in left}.values())
        right = list({(k, t): (k, t, v) for k, t, v in right}.values())
    ldf = spark.createDataFrame(left, "k string, t timestamp_ntz, name long")
    rdf = spark.createDataFrame(right, "k string, t timestamp_ntz, value long")
    got = asof_join(ldf, rdf, ["k"], "t", slice_seconds)
    assert rows(got.select("k", "t", "name", "value")) == naive_asof(left, right)


def test_asof_null_keys_match_nothing_and_unmatched_rows_stay(spark):
    left = spark.createDataFrame([(None, seconds(10), 1), ("a", seconds(1), 2)], "k string, t timestamp_ntz, name long")
    right = spark.createDataFrame([(None, seconds(10), 5), ("a", seconds(2), 6)], "k string, t timestamp_ntz, value long")
    got = asof_join(left, right, ["k"], "t").select("name", "value")
    assert rows(got) == [(1, None), (2, None)]


def test_a_null_payload_is_still_the_latest_row(spark):
    left = spark.createDataFrame([("a", seconds(9), 1)], "k string, t timestamp_ntz, name long")
    right = spark.createDataFrame([("a", seconds(1), 5), ("a", seconds(2), None)], "k string, t timestamp_ntz, value long")
    assert asof_join(left, right, ["k"], "t").collect()[0]["value"] is None


def test_plans_have_no_quadratic_join(spark):
    from tools.plans import QUADRATIC, shape

    left = spark.range(10).selectExpr("string(id % 2) AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, int(id)) AS t", "id")
    right = left.selectExpr("k", "t", "id AS value")
    counts = shape(asof_join(left, right, ["k"], "t"))
    assert not set(QUADRATIC) & set(counts) and counts["Exchange"] <= 4
    counts = shape(conflicts_within(left.withColumn("v", left["id"]), "k", "t", "v"))
    assert not set(QUADRATIC) & set(counts) and counts["Exchange"] <= 5


def test_a_dense_day_is_split_by_a_measured_slice(spark):
    """One key with 20,000 rows in an hour: at 1,000 rows a slice no window partition holds more than a few thousand."""
    left = spark.range(20_000).selectExpr("'hot' AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id % 3600) AS t", "id AS name")
    right = spark.range(0, 3600, 7).selectExpr("'hot' AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) AS t", "id AS value")
    width = measured_slice(left, ["k"], "t", rows=1_000)
    assert width == 180
    got = asof_join(left, right, ["k"], "t", width)
    assert got.where("value <> (name % 3600) - (name % 3600) % 7").count() == 0 and got.count() == 20_000
    per_slice = left.groupBy(F.floor(epoch_seconds(F.col("t")) / width)).count().agg(F.max("count")).head()[0]
    assert per_slice <= 1_080


def test_a_hot_slice_is_split_over_tasks(spark):
    """A third of all rows in one key and one hour still leaves the join balanced."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        data = spark.range(0, 600_000, 1, 16).selectExpr(
            "id",
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('u', id % 5000) END AS k",
            "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, "
            "CAST(CASE WHEN id % 3 = 0 THEN id % 3600 ELSE (id * 7919) % 2592000 END AS INT)) AS t",
            "CASE WHEN hash(id) % 50 = 0 THEN 'FR' ELSE 'AU' END AS v",
        )
        found = conflicts_within(data, "k", "t", "v").groupBy("k").agg({"id": "max", "*": "count"})
        hot = {r["k"]: r["count(1)"] for r in found.collect()}["hot"]
        assert hot == 200_000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_prefix_scan_against_brute_force(spark, partitions):
    rng = random.Random(partitions)
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c", None])
    moment = lambda: seconds(rng.randrange(0, 200) * 97) if rng.random() < 0.95 else None
    left = [(key(), moment(), i) for i in range(300)] + [("lonely", seconds(5), 999)]
    right = [(key(), moment(), rng.choice([None, rng.randrange(1000)])) for _ in range(200)]
    ldf = spark.createDataFrame(left, "k string, t timestamp_ntz, name long").repartition(3)
    rdf = spark.createDataFrame(right, "k string, t timestamp_ntz, value long").repartition(4)
    got = rows(asof_scan(ldf, rdf, ["k"], "t", partitions).select("k", "t", "name", "value"))
    assert got == rows(asof_join(ldf, rdf, ["k"], "t").select("k", "t", "name", "value"))


def test_prefix_scan_of_empty_sides(spark):
    left = spark.createDataFrame([("a", seconds(9), 1)], "k string, t timestamp_ntz, name long")
    right = spark.createDataFrame([("a", seconds(1), 5)], "k string, t timestamp_ntz, value long")
    assert rows(asof_scan(left, right.limit(0), ["k"], "t").select("name", "value")) == [(1, None)]
    assert asof_scan(left.limit(0), right, ["k"], "t").count() == 0


def test_a_key_at_one_instant_is_spread_over_ranges(spark):
    """40,000 rows of one key at the same time: no range holds more than a fraction, and each finds the one match before it."""
    left = spark.range(40_000).selectExpr("'hot' AS k", "timestamp_ntz '2024-01-01 00:00:05' AS t", "id AS name")
    right = spark.range(5).selectExpr("'hot' AS k", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) AS t", "id AS value")
    got = asof_scan(left, right, ["k"], "t", 16)
    assert got.where("value = 4").count() == 40_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") <= 6
    order = [F.col("k"), F.col("t"), F.xxhash64(F.struct(F.lit(True), F.col("name")))]
    sizes = [r["n"] for r in left.repartitionByRange(16, *order).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 14 and max(sizes) < 6_000
