"""Table sinks.

Rows are written to a folder of their own before a table is pointed there (``versions``), so a job that dies leaves the
old rows readable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from harbormill.models import Model
from harbormill.operators.joins import renamed_keys, same_keys
from harbormill.operators.windows import latest_by
from harbormill.session import remove_path
from harbormill.sinks.buckets import BUCKETS, BucketStore, buckets_to_see, seen_buckets
from harbormill.sinks.versions import FORMAT, home_of, observed, publish_place, publish_version, write_version


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The row count is taken while writing, not by a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_seen(seen: Observation) -> int:
    return observed(seen).get("rows", 0)


def fitted(df: DataFrame, table: str) -> DataFrame:
    """The columns of a table, in its order and types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in df.sparkSession.table(table).schema.fields])


def provision_table(spark: SparkSession, model: Model, table: str, location: str | None = None) -> None:
    """CREATE IF NOT EXISTS from the model, with its NOT NULL marks and comments."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + ("" if f.nullable else " NOT NULL")
        + (" COMMENT '{}'".format(f.metadata["comment"].replace("'", "''")) if f.metadata.get("comment") else "")
        for f in model.schema.fields
    )
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {FORMAT}{place}")


def refresh_table(df: DataFrame, table: str, location: str | None = None) -> int:
    """All rows replaced: the table keeps its schema and no old row stays. Returns the row count."""
    rows = fitted(df, table) if df.sparkSession.catalog.tableExists(table) else df
    rows, seen = counted(rows, "refresh")
    publish_version(rows, table, location)
    return rows_seen(seen)


def replace_table(df: DataFrame, table: str, location: str | None = None) -> None:
    """Create from a query, or replace what is there: the new schema wins."""
    publish_version(df, table, location)


def overwrite_table(df: DataFrame, table: str, location: str | None = None) -> None:
    publish_version(df, table, location)


def append_table(df: DataFrame, table: str, location: str | None = None) -> int:
    """Append and return the rows written."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return refresh_table(df, table, location)
    rows, seen = counted(df.select(*spark.table(table).columns), "append")
    rows.write.insertInto(table)
    return rows_seen(seen)


def merged_by_id(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows that were not updated, and the updates; a null id is an id like any other."""
    known = renamed_keys(updates.select(*keys), keys)
    return current.join(known, same_keys(keys), "left_anti").unionByName(updates.select(*current.columns))


def upsert_by_id(
    updates: DataFrame,
    table: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    location: str | None = None,
    buckets: int = BUCKETS,
    step: Callable[[str], None] = lambda _: None,
) -> int:
    """Insert new ids and replace known ones; running it twice changes nothing. Returns the rows written.

    Ids are dealt into ``buckets`` by their hash, a number that the first call fixes. Only the buckets that the updates touch are
    read and written again, once; ``table`` is a view that moves to all of them in one step. Of several updates of an id the last
    in ``order`` counts, ties by all columns. ``step`` is told what comes next, for tests that stop there.
    """
    store = BucketStore(updates.sparkSession, table, keys, location, buckets)
    changed = latest_by(store.fitted(updates), keys, [F.col(c) for c in order])
    seen = Observation("upsert")
    rows_and_buckets = (F.count(F.lit(1)).alias("rows"), buckets_to_see())
    if not store.exists():
        step("write")
        rows = store.with_bucket(changed)
        store.create(rows.schema)
        version = store.write(rows.observe(seen, *rows_and_buckets))
        step("switch")
        store.switch(seen_buckets(seen), version)
        return rows_seen(seen)
    step("stage")
    staged = store.stage(changed)
    try:
        if not staged.buckets:
            return 0
        step("write")
        merged = merged_by_id(store.current(staged.buckets), staged.rows(), keys)
        version = store.write(merged.observe(seen, *rows_and_buckets))
        step("switch")
        before = store.switch(staged.buckets, version)
        step("remove")
        store.remove(before)
        return rows_seen(seen)
    finally:
        staged.remove()


def copy_if_any(df: DataFrame, table: str, location: str | None = None) -> bool:
    """Overwrite the table unless there is nothing to write; the rows are computed once, and counted as they are written."""
    spark = df.sparkSession
    rows, seen = counted(df, "copy")
    home = home_of(spark, table, location)
    place = write_version(rows, home)
    if not rows_seen(seen):
        remove_path(spark, place)
        return False
    publish_place(df, table, place, home)
    return True
