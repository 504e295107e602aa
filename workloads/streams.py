"""Streaming jobs over files derived from events and orders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from harbormill.models import catalog
from harbormill.session import shared_dir
from harbormill.streaming import jobs
from harbormill.streaming.sources import file_stream
from workloads.inputs import PAYMENTS
from workloads.registry import stamp, table, workload
from workloads.risk import DENSITY_SQL

EVENT_SQL = "(SELECT ts AS timestamp, CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS value FROM events)"


def _landed(spark, d) -> tuple[str, str]:
    """Events as arriving files in the shape of the rate model, and a folder for the job."""
    base = shared_dir(spark, "stream")
    rows = table(spark, d, "events").selectExpr(
        "ts AS timestamp", "CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS value"
    )
    rows.write.parquet(f"{base}/in")
    return f"{base}/in", base


def _checked(spark, d) -> str:
    source, base = _landed(spark, d)
    stream = jobs.check_stream_model(file_stream(spark, source, catalog.RATE_MODEL.schema, 2), catalog.RATE_MODEL)
    query = jobs.start_checked_stream(
        jobs.seen_messages(stream), catalog.OUTPUT_MODEL, f"{base}/out", f"{base}/checks", f"{base}/checkpoint", interval=None
    )
    query.awaitTermination()
    return base


@workload(
    "stream_messages",
    "E20 ST1 ST3 ST4 S12 K10 D06",
    f"SELECT {stamp('timestamp')} AS timestamp, value, 'Seen: ' || value AS message FROM {EVENT_SQL}",
)
def stream_messages(spark, d):
    base = _checked(spark, d)
    return spark.read.parquet(f"{base}/out").select("timestamp", "value", "message")


@workload(
    "stream_batch_quality",
    "ST2 Q24 D06",
    f"""SELECT count(*) AS row_count, count(*) FILTER (timestamp IS NULL) AS null_timestamp, count(*) FILTER (value IS NULL) AS null_value,
        count(*) FILTER (value IS NULL) AS null_message, true AS statuses_fit FROM {EVENT_SQL}""",
)
def stream_batch_quality(spark, d):
    base = _checked(spark, d)
    per_batch = spark.read.parquet(f"{base}/checks")
    warned = F.col("status") == F.when(F.col("null_value") + F.col("null_message") > 0, "WARNING").otherwise("PASS")
    counts = ["row_count", "null_timestamp", "null_value", "null_message"]
    return per_batch.agg(*[F.sum(c).alias(c) for c in counts], F.every(warned).alias("statuses_fit"))


@workload(
    "batch_quality",
    "Q24 ST2",
    f"""SELECT count(*) AS row_count, 0 AS null_timestamp, count(*) FILTER (value IS NULL) AS null_value,
        count(*) FILTER (value IS NULL) AS null_message, 'WARNING' AS status FROM {EVENT_SQL}""",
)
def batch_quality(spark, d):
    rows = table(spark, d, "events").selectExpr(
        "ts AS timestamp", "CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS value"
    )
    return jobs.batch_quality(jobs.seen_messages(rows))


@workload(
    "stream_table",
    "K10 ST4 S12",
    f"""SELECT {stamp('timestamp')} AS timestamp, value, 'Seen: ' || value AS message, value + 1 AS later FROM {EVENT_SQL} WHERE value % 2 = 1
        UNION ALL SELECT {stamp('timestamp')}, value, 'Seen: ' || value, NULL FROM {EVENT_SQL} WHERE value IS NULL OR value % 2 = 0""",
)
def stream_table(spark, d):
    """The job stops and goes on with another column, which the files have that arrive then; all rows and columns are read back."""
    source, base = _landed(spark, d)
    landed = spark.read.parquet(source)
    name = f"t_{uuid.uuid4().hex}"
    odd = F.col("value") % 2 == 1
    wider = landed.where(odd).withColumn("later", F.col("value") + 1)
    for files, more in ((landed.where(~odd | F.col("value").isNull()), []), (wider, ["later"])):
        files.write.mode("append").parquet(f"{base}/arriving")
        raw = file_stream(spark, f"{base}/arriving", files.schema)
        message = F.concat(F.lit("Seen: "), F.col("value").cast("string")).alias("message")
        jobs.stream_to_table(raw.select("timestamp", "value", message, *more), name, f"{base}/checkpoint", interval=None, path=f"{base}/table").awaitTermination()
    return spark.table(name)


@workload(
    "stream_json_table",
    "K10 S05 S12",
    """SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN value END AS value,
        CASE WHEN event_type = 'click' THEN '{"a":[' || user_id || ',1]}' END AS extra FROM events""",
)
def stream_json_table(spark, d):
    """Landed JSON lines in one run of the job: files of clicks have keys that the others lack."""
    base = shared_dir(spark, "stream")
    name = f"t_{uuid.uuid4().hex}"
    rows = table(spark, d, "events")
    few = rows.where("event_type <> 'click'").selectExpr("to_json(struct(event_id, event_type, null AS value), map('ignoreNullFields', 'false')) AS line")
    more = "to_json(struct(event_id, event_type, value, struct(array(user_id, 1) AS a) AS extra)) AS line"
    many = rows.where("event_type = 'click'").selectExpr(more)
    for lines in (few, many):
        lines.coalesce(1).write.mode("append").text(f"{base}/in")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/in")
    jobs.stream_to_table(stream, name, f"{base}/checkpoint", interval=None, path=f"{base}/table", json_lines=True).awaitTermination()
    return spark.table(name).select("event_id", "event_type", "value", "extra")


@workload("stream_density", "ST5 E12 S12", DENSITY_SQL)
def stream_density(spark, d):
    base = shared_dir(spark, "stream")
    name = f"t_{uuid.uuid4().hex}"
    rows = PAYMENTS.df(spark, d)
    rows.write.parquet(f"{base}/in")
    stream = file_stream(spark, f"{base}/in", rows.schema, 1)
    jobs.start_density_stream(stream, name, f"{base}/checkpoint", interval=None, path=f"{base}/table").awaitTermination()
    return spark.table(name)


@workload("stream_density_replayed", "ST5 S12", DENSITY_SQL)
def stream_density_replayed(spark, d):
    """Payments arrive over two runs of the job, a third of them twice; each counts once."""
    base = shared_dir(spark, "stream")
    name = f"t_{uuid.uuid4().hex}"
    numbered = PAYMENTS.df(spark, d).withColumn("payment", F.monotonically_increasing_id())
    numbered.write.parquet(f"{base}/all")
    rows = spark.read.parquet(f"{base}/all")
    rows.where("payment % 3 < 2").write.parquet(f"{base}/in")
    for later in (None, "payment % 3 > 0"):
        if later:
            rows.where(later).write.mode("append").parquet(f"{base}/in")
        stream = file_stream(spark, f"{base}/in", rows.schema, 1)
        jobs.start_density_stream(stream, name, f"{base}/checkpoint", interval=None, path=f"{base}/table", event_id="payment").awaitTermination()
    return spark.table(name)
