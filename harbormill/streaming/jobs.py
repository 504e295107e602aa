"""Checked micro-batch jobs.

Each batch is written to its own partition, so a batch that is replayed after a
failure overwrites itself. Its quality is counted while it is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harbormill.models import Model, catalog
from harbormill.operators.columns import conform
from harbormill.plans.risk import market_counts, with_rate
from harbormill.quality.checks import PASS, WARNING
from harbormill.sinks.tables import upsert_by_id
from harbormill.streaming.evolving import BatchTable, json_columns

INTERVAL = "15 seconds"  # fixed value: micro-batch interval
CHECKED = ("timestamp", "value", "message")
# Ids that are kept for good: on disk, within a fixed part of an executor's memory, and a batch writes only what it changed.
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
ID_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{ROCKSDB}.boundedMemoryUsage": "true",
}


class ModelMismatch(ValueError):
    """The stream's schema lacks a model column or has it with another type."""


def check_stream_model(df: DataFrame, model: Model) -> DataFrame:
    """The stream itself, if its columns fit the model; checked before it starts."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = {
        f.name: (f.dataType.simpleString(), actual.get(f.name))
        for f in model.schema.fields
        if actual.get(f.name) != f.dataType.simpleString()
    }
    if wrong:
        raise ModelMismatch(f"{model.name}: expected and actual types {wrong}")
    return df


def seen_messages(df: DataFrame) -> DataFrame:
    """Add the message and bring timestamp and value to the table's types; a value beyond its type becomes null and is counted."""
    message = F.concat(F.lit("Seen: "), F.col("value").cast("string"))
    return conform(df.withColumn("message", message), catalog.OUTPUT_MODEL, safe=True)


def quality_counts(columns: Sequence[str] = CHECKED):
    counts = [F.count(F.lit(1)).alias("row_count")]
    return counts + [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def batch_quality(df: DataFrame, columns: Sequence[str] = CHECKED) -> DataFrame:
    """One row: counts and status. Nulls warn, an empty batch passes."""
    nulls = sum((F.col(f"null_{c}") for c in columns), F.lit(0))
    return df.agg(*quality_counts(columns)).withColumn("status", F.when(nulls > 0, WARNING).otherwise(PASS))


def _status_row(batch_id: int, counts: dict[str, int], columns: Sequence[str]) -> tuple:
    nulls = [counts[f"null_{c}"] for c in columns]
    return (batch_id, counts["row_count"], *nulls, WARNING if sum(nulls) else PASS)


def checked_writer(
    path: str,
    results_path: str,
    columns: Sequence[str] = CHECKED,
    on_result: Callable[[int, dict], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: one pass writes the batch and counts its nulls."""
    ddl = "batch_id bigint, row_count bigint, " + ", ".join(f"null_{c} bigint" for c in columns) + ", status string"

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch_{batch_id}")
        batch.observe(seen, *quality_counts(columns)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        row = _status_row(batch_id, seen.get, columns)
        result = batch.sparkSession.createDataFrame([row], ddl)
        result.drop("batch_id").write.mode("overwrite").parquet(f"{results_path}/batch_id={batch_id}")
        if on_result is not None:
            on_result(batch_id, dict(zip(result.columns, row)))

    return write


def start_checked_stream(
    df: DataFrame,
    model: Model,
    path: str,
    results_path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    columns: Sequence[str] = CHECKED,
) -> StreamingQuery:
    """Start the job; ``interval=None`` processes what is there and stops."""
    writer = (
        check_stream_model(df, model)
        .writeStream.foreachBatch(checked_writer(path, results_path, columns))
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(**_trigger(interval)).start()


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def stream_to_table(
    df: DataFrame, table: str, checkpoint: str, interval: str | None = INTERVAL, path: str | None = None, json_lines: bool = False
) -> StreamingQuery:
    """Append to a table at a fixed interval. The table takes up columns that it lacks, see ``evolving``.

    A stream's columns are those it was started with; with ``json_lines`` the stream is text (column ``value``), and each batch has
    the columns of its own objects. A batch that is replayed replaces itself.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        target = BatchTable(df.sparkSession, table, path)
        rows = json_columns(batch, target.schema()) if json_lines else batch
        if rows.columns:
            target.write(rows, batch_id, checkpoint)

    return df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


@contextmanager
def state_settings(spark: SparkSession, with_ids: bool) -> Iterator[None]:
    """Settings that a query takes over as it starts; a checkpoint keeps its store and number of partitions from its first start.

    Every partition commits its state in every batch, however few rows that brings, so there are two a core at most.
    """
    partitions = "spark.sql.shuffle.partitions"
    settings = {partitions: str(min(int(spark.conf.get(partitions)), 2 * spark.sparkContext.defaultParallelism))} | (ID_STATE if with_ids else {})
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start_density_stream(
    raw: DataFrame,
    table: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    path: str | None = None,
    event_id: str | None = None,
    event_time: str | None = None,
    delay: str | None = None,
) -> StreamingQuery:
    """Fraud density kept up to date in a table with one row per market.

    The state store holds two numbers per market. A batch changes the markets that it brings payments of, and only these are
    upserted, with their whole counts, so a batch that is replayed changes nothing.

    With ``event_id`` a payment counts once however often it arrives. Its ids are kept for good, or, with ``delay``, until the
    watermark over ``event_time`` has passed them by that much; payments that arrive later than that are then left out. Ids lie in
    RocksDB, so the heap doesn't grow with them.
    """
    once = raw
    if event_id and delay:
        once = raw.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([event_id])
    elif event_id:
        once = raw.dropDuplicates([event_id])

    def publish(changed: DataFrame, batch_id: int) -> None:
        upsert_by_id(with_rate(changed), table, ["market_type"], (), path, buckets=1)

    stream = (
        market_counts(once)
        .writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
    )
    with state_settings(raw.sparkSession, event_id is not None):
        return stream.start()
