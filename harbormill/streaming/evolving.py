"""Tables that streams append to and whose columns may grow.

Every batch of a job is a partition with files of its own, registered once they are complete, so a batch that is replayed takes
its own place again. Jobs are told apart by their checkpoint, as each counts its batches from zero. A view under the public name shows the columns without the batch number. Columns that a batch brings are
added to the table, older rows read null there; columns that it lacks are null; a type that would lose values stops the batch
before anything is written.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.sinks.versions import FORMAT, home_of, table_location

JOB, BATCH = "_job", "_batch"

# Which types a column of the named type takes without loss.
TAKES = {
    "smallint": ("tinyint",),
    "int": ("tinyint", "smallint"),
    "bigint": ("tinyint", "smallint", "int"),
    "double": ("tinyint", "smallint", "int", "float"),
    "timestamp_ntz": ("date",),
}


class IncompatibleColumn(ValueError):
    """A batch has a column with a type that the table's column can't hold."""


def merged_schema(table: T.StructType, batch: T.StructType) -> T.StructType:
    """The table's columns and then the batch's new ones. Names are told apart without regard to case."""
    known = {f.name.lower(): f for f in table.fields}
    wrong = {}
    for f in batch.fields:
        own = known.get(f.name.lower())
        kind = f.dataType.simpleString()
        if own is not None and kind != own.dataType.simpleString() and kind not in TAKES.get(own.dataType.simpleString(), ()):
            wrong[f.name] = (own.dataType.simpleString(), kind)
    if wrong:
        raise IncompatibleColumn(f"types of the table and of the batch: {wrong}")
    new = [T.StructField(f.name, f.dataType) for f in batch.fields if f.name.lower() not in known]
    return T.StructType([*table.fields, *new])


class BatchTable:
    """``spark`` is the session that readers use: another one would not see new columns before it refreshes the table."""

    def __init__(self, spark: SparkSession, table: str, location: str | None = None):
        self.spark, self.table, self.store = spark, table, f"{table}__batches"
        if spark.catalog.tableExists(self.store):
            self.home = table_location(spark, self.store).rstrip("/")
        elif spark.catalog.tableExists(table):
            raise ValueError(f"{table} is a table without batches; stream into a new one")
        else:
            self.home = home_of(spark, self.store, location)

    def schema(self) -> T.StructType:
        if not self.spark.catalog.tableExists(self.store):
            return T.StructType([])
        return T.StructType([f for f in self.spark.table(self.store).schema.fields if f.name not in (JOB, BATCH)])

    def evolve(self, batch: T.StructType) -> T.StructType:
        """Bring the table to the columns it needs for a batch."""
        before = self.schema()
        after = merged_schema(before, batch)
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in after.fields[len(before.fields) :])
        if not before.fields:
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.store} ({added}, {JOB} STRING, {BATCH} BIGINT) USING {FORMAT} "
                f"PARTITIONED BY ({JOB}, {BATCH}) LOCATION '{self.home}'"
            )
        elif added:
            self.spark.sql(f"ALTER TABLE {self.store} ADD COLUMNS ({added})")
        if added or not self.spark.catalog.tableExists(self.table):
            names = ", ".join(f"`{f.name}`" for f in after.fields)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.table} AS SELECT {names} FROM {self.store}")
        return after

    def write(self, batch: DataFrame, batch_id: int, checkpoint: str) -> None:
        """Append a batch, or put it in the place of its earlier attempt."""
        spark = self.spark
        schema = self.evolve(batch.schema)
        has = {c.lower(): c for c in batch.columns}
        columns = [
            (F.col(f"`{has[f.name.lower()]}`") if f.name.lower() in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ]
        place = f"{self.home}/{uuid.uuid4().hex}"
        batch.select(*columns).write.format(FORMAT).save(place)
        job = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()
        spec = f"PARTITION ({JOB} = '{job}', {BATCH} = {batch_id})"
        if spark.sql(f"SHOW PARTITIONS {self.store} {spec}").isEmpty():
            spark.sql(f"ALTER TABLE {self.store} ADD {spec} LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {self.store} {spec} SET LOCATION '{place}'")
            spark.catalog.refreshTable(self.store)


def _column_type(kind: str) -> str | None:
    """The column for a variant's type; null for a key that holds nothing but null."""
    if kind == "VOID":
        return None
    if kind.startswith("DECIMAL"):
        return "bigint" if kind.endswith(",0)") else "double"
    if kind in ("BIGINT", "BOOLEAN", "STRING", "DOUBLE"):
        return kind.lower()
    if kind.startswith(("OBJECT", "ARRAY")):
        return "string"  # as JSON text
    raise IncompatibleColumn(f"values of several types in one batch: {kind}")


def json_columns(lines: DataFrame, known: T.StructType, value: str = "value") -> DataFrame:
    """Lines of one JSON object each as columns, one per key of any of them, with the types that the values have.

    JSON tells whole numbers from others by how they are written only, so where the table has a double they are doubles. Keys and types come from one aggregate over the lines. Blank lines are left out; a line that is no object fails the job.
    """
    parsed = lines.where(F.trim(value) != "").select(F.expr(f"cast(parse_json(`{value}`) AS map<string, variant>)").alias("m"))
    # key by key, so that a nested value does not have to agree in its own keys
    kinds = parsed.select(F.explode("m").alias("key", "item")).groupBy("key").agg(F.schema_of_variant_agg("item").alias("kind"))
    doubles = {f.name.lower(): isinstance(f.dataType, T.DoubleType) for f in known.fields}
    columns = []
    for r in kinds.orderBy("key").collect():
        kind, item = _column_type(r["kind"]), F.try_element_at("m", F.lit(r["key"]))
        if kind == "bigint" and doubles.get(r["key"].lower()):
            kind = "double"
        if kind is not None:
            nested = kind == "string" and r["kind"] != "STRING"
            columns.append((F.to_json(item) if nested else F.variant_get(item, "$", kind)).alias(r["key"]))
    return parsed.select(*columns)
