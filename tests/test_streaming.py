from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import rows

from harbormill.models import catalog
from harbormill.session import shared_dir
from harbormill.streaming import jobs
from harbormill.streaming.sources import file_stream, rate_stream

HDFS_STATE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"  # Spark's own choice


def test_rate_source_fits_the_output_model(spark):
    stream = rate_stream(spark, 5)
    assert stream.isStreaming and stream.columns == ["timestamp", "value"]
    jobs.check_stream_model(jobs.seen_messages(stream), catalog.OUTPUT_MODEL)
    with pytest.raises(jobs.ModelMismatch, match="message"):
        jobs.check_stream_model(stream, catalog.OUTPUT_MODEL)


def test_rate_source_runs(spark):
    base = shared_dir(spark, "rate")
    query = jobs.start_checked_stream(
        jobs.seen_messages(rate_stream(spark, 50)),
        catalog.OUTPUT_MODEL,
        f"{base}/out",
        f"{base}/checks",
        f"{base}/checkpoint",
        interval="1 second",
    )
    try:
        for _ in range(60):
            query.awaitTermination(1)
            progress = query.lastProgress
            if progress and progress["batchId"] >= 2:
                break
    finally:
        query.stop()
    out = spark.read.parquet(f"{base}/out")
    assert out.count() > 0
    assert out.where("message <> concat('Seen: ', value)").count() == 0


def batch(spark, data):
    return spark.createDataFrame(data, "timestamp timestamp_ntz, value int, message string")


def test_batch_quality(spark):
    at = dt.datetime(2024, 1, 1)
    assert jobs.batch_quality(batch(spark, [])).collect()[0]["status"] == "PASS"
    assert jobs.batch_quality(batch(spark, [(at, 1, "m")])).collect()[0]["status"] == "PASS"
    warned = jobs.batch_quality(batch(spark, [(at, 1, "m"), (None, 2, None)])).collect()[0]
    assert (warned["status"], warned["row_count"], warned["null_timestamp"], warned["null_message"]) == ("WARNING", 2, 1, 1)


def test_a_replayed_batch_overwrites_itself(spark):
    base = shared_dir(spark, "replay")
    seen = []
    writer = jobs.checked_writer(f"{base}/out", f"{base}/checks", on_result=lambda i, r: seen.append((i, r["status"])))
    data = batch(spark, [(dt.datetime(2024, 1, 1), 1, "m"), (None, 2, "n")])
    writer(data, 0)
    writer(data, 0)
    writer(batch(spark, []), 1)
    assert spark.read.parquet(f"{base}/out").count() == 2
    assert rows(spark.read.parquet(f"{base}/checks").select("batch_id", "row_count", "status")) == [(0, 2, "WARNING"), (1, 0, "PASS")]
    assert seen == [(0, "WARNING"), (0, "WARNING"), (1, "PASS")]


def test_restart_continues_where_it_stopped(spark):
    base = shared_dir(spark, "restart")
    ddl = "timestamp timestamp_ntz, value long"

    def land(start):
        spark.range(start, start + 5).selectExpr("TIMESTAMP_NTZ '2024-01-01 00:00:00' AS timestamp", "id AS value").write.mode(
            "append"
        ).parquet(f"{base}/in")

    def run():
        stream = jobs.seen_messages(file_stream(spark, f"{base}/in", ddl))
        jobs.start_checked_stream(
            stream, catalog.OUTPUT_MODEL, f"{base}/out", f"{base}/checks", f"{base}/checkpoint", interval=None
        ).awaitTermination()
        return spark.read.parquet(f"{base}/out").count()

    land(0)
    assert run() == 5
    land(5)
    assert run() == 10
    assert run() == 10


# --- tables that take up new columns ------------------------------------------


def stream_lines(spark, base, name, files, checkpoint="checkpoint"):
    for lines in files:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/in")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/in")
    jobs.stream_to_table(stream, name, f"{base}/{checkpoint}", interval=None, path=f"{base}/table", json_lines=True).awaitTermination()


def test_columns_that_appear_and_go(spark):
    base, name = shared_dir(spark, "evolve"), f"t_{uuid.uuid4().hex}"
    stream_lines(spark, base, name, [['{"id": 1, "a": "x", "gone": 1.5, "later": null}', " ", '{"id": 2}']])
    assert spark.table(name).columns == ["a", "gone", "id"]
    stream_lines(spark, base, name, [['{"id": 3, "later": {"k": [1, "x"]}, "odd \'key": true}']])
    got = spark.table(name)
    assert got.columns == ["a", "gone", "id", "later", "odd 'key"]
    assert rows(got) == [("x", 1.5, 1, None, None), (None, None, 2, None, None), (None, None, 3, '{"k":[1,"x"]}', True)]


def test_an_incompatible_column_stops_the_batch(spark):
    base, name = shared_dir(spark, "evolve"), f"t_{uuid.uuid4().hex}"
    stream_lines(spark, base, name, [['{"id": 1, "n": 1.5}']])
    stream_lines(spark, base, name, [['{"id": 2, "n": 7}']])  # a whole number fits a double
    before = rows(spark.table(name))
    assert before == [(1, 1.5), (2, 7.0)]
    for bad, match in (('{"id": "three"}', "IncompatibleColumn"), ('{"id": 3}\n{"id": "x"}', "several types"), ("no json", "MALFORMED")):
        with pytest.raises(Exception, match=match):
            stream_lines(spark, f"{base}/{uuid.uuid4().hex}", name, [bad.split("\n")])
        assert rows(spark.table(name)) == before


def test_schemas_merge_without_loss_or_not_at_all():
    from pyspark.sql import types as T

    from harbormill.streaming.evolving import IncompatibleColumn, merged_schema

    table, ddl = T.StructType.fromDDL("id bigint, d double, s string"), T.StructType.fromDDL
    assert merged_schema(table, ddl("ID int, d float, new array<int>")).simpleString() == "struct<id:bigint,d:double,s:string,new:array<int>>"
    for bad in ("id string", "id double", "d bigint", "s int", "d decimal(10,2)"):
        with pytest.raises(IncompatibleColumn):
            merged_schema(table, ddl(bad))


def test_a_replayed_batch_takes_its_own_place(spark):
    from harbormill.streaming.evolving import BatchTable

    base, name = shared_dir(spark, "evolve"), f"t_{uuid.uuid4().hex}"
    first = spark.createDataFrame([(1,), (2,)], "id int")
    store = BatchTable(spark, name, base)
    for _ in range(2):
        store.write(first, 0, "job-a")
    BatchTable(spark, name).write(first.limit(1), 0, "job-b")  # another job's first batch
    assert rows(spark.table(name)) == [(1,), (1,), (2,)]


def test_density_counts_late_and_replayed_payments_once(spark):
    base, name = shared_dir(spark, "density"), f"t_{uuid.uuid4().hex}"
    ddl = "id long, at timestamp, category string, fraud string"
    day = lambda n: dt.datetime(2024, 1, n)
    batches = [
        [(1, day(1), "'es_food'", "1"), (2, day(1), "'es_food'", "0"), (2, day(1), "'es_food'", "0")],
        [(1, day(1), "'es_food'", "1"), (3, day(20), "'es_tech'", "0")],
        [(4, day(2), "'es_food'", "1"), (3, day(20), "'es_tech'", "0")],  # late, and replayed
        [],
    ]
    versions = []
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = file_stream(spark, f"{base}/in", ddl)
        query = jobs.start_density_stream(stream, name, f"{base}/checkpoint", interval=None, path=f"{base}/table", event_id="id")
        query.awaitTermination()
        versions.append(rows(spark.table(name).select("market_type", "transaction_count", "fraud_event_count")))
        files = [f for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base}/table").select("path").collect()]
        assert len(files) <= 8, n  # the state is upserted, no copy per batch stays
    assert versions == [[("food", 2, 1)], [("food", 2, 1), ("tech", 1, 0)], [("food", 3, 2), ("tech", 1, 0)], [("food", 3, 2), ("tech", 1, 0)]]
    # with a watermark the ids are forgotten in time, and what comes later than that is left out
    query = jobs.start_density_stream(
        file_stream(spark, f"{base}/in", ddl, 1), f"{name}_w", f"{base}/checkpoint-w", None, f"{base}/table-w", "id", "at", "5 days"
    )
    query.awaitTermination()
    got = {r["market_type"]: r["transaction_count"] for r in spark.table(f"{name}_w").collect()}
    assert got["tech"] == 1 and got["food"] in (2, 3)


def test_density_state_is_on_disk_and_in_two_partitions_a_core_at_most(spark):
    base, name = shared_dir(spark, "density"), f"t_{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    most = 2 * spark.sparkContext.defaultParallelism
    ddl = "id long, category string, fraud string"
    spark.conf.set("spark.sql.shuffle.partitions", str(most + 3))
    try:
        for n in (1, 2):  # the second run goes on with the state of the first
            spark.createDataFrame([(n, "'es_food'", "1"), (1, "'es_food'", "1")], ddl).write.mode("append").parquet(f"{base}/in")
            stream = file_stream(spark, f"{base}/in", ddl)
            jobs.start_density_stream(stream, name, f"{base}/checkpoint", None, f"{base}/table", "id").awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(most + 3)
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == HDFS_STATE
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows(spark.table(name).select("market_type", "transaction_count")) == [("food", 2)]
    kept = spark.read.text(f"{base}/checkpoint/offsets/1").collect()[1]["value"]
    assert "RocksDBStateStoreProvider" in kept and f'"spark.sql.shuffle.partitions":"{most}"' in kept
