"""Sinks that are stopped between any two steps, and how much an upsert rewrites."""

from __future__ import annotations

import uuid

import pytest
from conftest import rows

from harbormill.quality import checks
from harbormill.session import shared_dir
from harbormill.sinks import tables as sinks
from harbormill.sinks import versions
from harbormill.sinks.publish import PublicationBlocked, publish_if_pass
from harbormill.sources.files import file_listing


class Killed(Exception):
    pass


def place(spark, name):
    return f"{name}_{uuid.uuid4().hex[:8]}", shared_dir(spark, name)


def stop_at(wanted):
    def step(name):
        if name == wanted:
            raise Killed(name)

    return step


def steps_of(run):
    seen = []
    run(seen.append)
    return seen


def files(spark, path):
    return {r["path"]: r["length"] for r in file_listing(spark, path).select("path", "length").collect()}


OLD, NEW = [(1, "a"), (2, "b")], [(7, "x")]


@pytest.mark.parametrize("ddl", ["k int, v string", "k bigint, other string"])
@pytest.mark.parametrize("managed", [False, True])
def test_a_replacement_stopped_anywhere_leaves_old_or_new_rows(spark, ddl, managed):
    new = spark.createDataFrame(NEW, ddl)

    def fresh():
        name, path = place(spark, "kill")
        versions.publish_version(spark.createDataFrame(OLD, "k int, v string"), name, None if managed else path)
        return name

    name = fresh()
    steps = steps_of(lambda step: versions.publish_version(new, name, step=step))
    assert rows(spark.table(name)) == NEW and steps[0] == "write" and steps[-1] == "remove"
    for at in steps:
        name = fresh()
        with pytest.raises(Killed):
            versions.publish_version(new, name, step=stop_at(at))
        if not spark.catalog.tableExists(name):  # between the two renames
            assert at == "rename new" and rows(spark.table(f"{name}__old")) == OLD
            versions.recover(spark, name)
        assert rows(spark.table(name)) == (NEW if at in ("remove", "drop old") else OLD)
        versions.publish_version(new, name)
        assert rows(spark.table(name)) == NEW
        assert spark.table(name).columns == new.columns


def test_old_folders_go_and_orphans_can_be_removed(spark):
    name, path = place(spark, "orphans")
    df = spark.createDataFrame(OLD, "k int, v string")
    for _ in range(3):
        sinks.refresh_table(df, name, path)
    used = {versions.table_location(spark, name)}
    assert len(versions._listed(spark, path)) == 1
    versions.write_version(df, path)
    assert len(versions.remove_orphans(spark, path, used)) == 1 and rows(spark.table(name)) == OLD
    assert len(versions._listed(spark, path)) == 1


def test_a_failing_write_leaves_the_table(spark):
    name, path = place(spark, "fails")
    sinks.replace_table(spark.createDataFrame(OLD, "k int, v string"), name, path)
    broken = spark.range(5).selectExpr("CAST(id AS int) AS k", "CAST(raise_error('no') AS string) AS v")
    for write in (sinks.refresh_table, sinks.replace_table, sinks.overwrite_table, sinks.copy_if_any):
        with pytest.raises(Exception, match="no"):
            write(broken, name)
        assert rows(spark.table(name)) == OLD


def test_refresh_casts_to_the_table_and_fails_on_values_that_do_not_fit(spark):
    name, path = place(spark, "cast")
    sinks.replace_table(spark.createDataFrame([(1,)], "k int"), name, path)
    assert sinks.refresh_table(spark.createDataFrame([(5,)], "k bigint"), name) == 1
    with pytest.raises(Exception, match="OVERFLOW"):
        sinks.refresh_table(spark.createDataFrame([(1 << 40,)], "k bigint"), name)
    assert rows(spark.table(name)) == [(5,)] and spark.table(name).schema["k"].dataType.simpleString() == "int"


def test_an_upsert_stopped_anywhere_leaves_old_or_new_rows(spark):
    old = spark.createDataFrame([(i, "old") for i in range(40)], "id int, v string")
    change = spark.createDataFrame([(i, "new") for i in range(30, 50)], "id int, v string")
    before, after = sorted((i, "old") for i in range(40)), sorted([(i, "old") for i in range(30)] + [(i, "new") for i in range(30, 50)])
    name, path = place(spark, "ups")
    sinks.upsert_by_id(old, name, ["id"], (), path, buckets=8)
    steps = steps_of(lambda step: sinks.upsert_by_id(change, name, ["id"], step=step))
    assert sorted(map(tuple, spark.table(name).collect())) == after and steps == ["stage", "write", "switch", "remove"]
    for at in steps:
        name, path = place(spark, "ups")
        sinks.upsert_by_id(old, name, ["id"], (), path, buckets=8)
        with pytest.raises(Killed):
            sinks.upsert_by_id(change, name, ["id"], step=stop_at(at))
        assert sorted(map(tuple, spark.table(name).collect())) == (after if at == "remove" else before)
        sinks.upsert_by_id(change, name, ["id"])
        assert sorted(map(tuple, spark.table(name).collect())) == after


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark):
    name, path = place(spark, "ups")
    big = spark.range(20_000).selectExpr("id", "repeat(cast(id AS string), 20) AS v")
    assert sinks.upsert_by_id(big, name, ["id"], (), path, buckets=100) == 20_000
    bucket = "pmod(xxhash64(id), 100)"
    before = files(spark, path)
    change = big.where(f"{bucket} = 42").selectExpr("id", "'new' AS v")  # one bucket of a hundred
    written = sinks.upsert_by_id(change, name, ["id"])
    after = files(spark, path)
    fresh = set(after) - set(before)
    assert written == change.count() and all("_bucket=42/" in f for f in fresh) and fresh
    assert sum(before[f] for f in before if f not in after) < 0.02 * sum(before.values())
    assert spark.table(name).where("v = 'new'").count() == written and spark.table(name).count() == 20_000
    # a new id in the same bucket and one without a change elsewhere
    assert sinks.upsert_by_id(spark.createDataFrame([(20_000, "x")], "id long, v string"), name, ["id"]) < 600
    assert sinks.upsert_by_id(change.limit(0), name, ["id"]) == 0
    assert spark.table(name).count() == 20_001


def test_upserts_of_null_and_repeated_ids_and_other_types(spark):
    name, path = place(spark, "ups")
    first = spark.createDataFrame([(None, "a", 1), (1, "b", 1)], "id bigint, v string, n int")
    sinks.upsert_by_id(first, name, ["id"], ["n"], path)
    change = spark.createDataFrame([(1, "c", 2), (1, "d", 3), (None, "e", 1), (2, "f", 1)], "id int, v string, n bigint")
    for _ in range(2):
        sinks.upsert_by_id(change, name, ["id"], ["n"])
        assert rows(spark.table(name)) == rows(spark.createDataFrame([(None, "e", 1), (1, "d", 3), (2, "f", 1)], "id int, v string, n int"))
    assert spark.table(name).columns == ["id", "v", "n"]
    empty, where = place(spark, "ups")
    sinks.upsert_by_id(first.limit(0), empty, ["id"], (), where)
    assert spark.table(empty).count() == 0
    plain, where = place(spark, "plain")
    sinks.replace_table(first, plain, where)
    with pytest.raises(ValueError, match="without buckets"):
        sinks.upsert_by_id(first, plain, ["id"])


def test_observed_checks_gate_the_one_write(spark):
    name, path = place(spark, "pub")
    contract = checks.Contract("m", [checks.is_null("k", checks.FAILED), checks.is_null("v"), checks.has_rows()])
    good = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    done = publish_if_pass(good, contract, name, ("non_empty",), path)
    assert done.rows == 2 and dict(done.results) == {"null:k": "PASS", "null:v": "WARNING", "non_empty": "PASS"}
    before = files(spark, path)
    for bad, match in ((good.selectExpr("CAST(NULL AS int) AS k", "v"), "null:k"), (good.limit(0), "non_empty")):
        with pytest.raises(PublicationBlocked, match=match):
            publish_if_pass(bad, contract, name)
        assert files(spark, path) == before
    for at in ("write", "check", "point"):
        with pytest.raises(Killed):
            publish_if_pass(good.limit(1), contract, name, step=stop_at(at))
        assert spark.table(name).count() == 2
    publish_if_pass(good.limit(1), contract, name)
    assert spark.table(name).count() == 1
