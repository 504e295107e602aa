"""Rows in hash buckets of their id, of which an upsert rewrites only those that it touches.

The files lie in ``<home>/_bucket=<n>/_version=<id>``, partitions of a store table. A view under the public name reads one version
of each bucket. An upsert writes new versions beside the old ones and then replaces the view, which moves all
buckets at once; versions that no view names are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbormill.session import remove_path, shared_dir
from harbormill.sinks.versions import FORMAT, home_of, observed, table_location

BUCKETS = 16  # fits a table of some gigabytes; choose a number that gives buckets of about one
BUCKET, VERSION = "_bucket", "_version"
VERSIONS = "harbormill.versions"  # property of the view: which version of which buckets it reads


def buckets_to_see() -> Column:
    """An aggregate to observe: at most one number a bucket."""
    return F.collect_set(BUCKET).alias("buckets")


def seen_buckets(seen: Observation) -> list[int]:
    return sorted(observed(seen).get("buckets") or [])


@dataclass(frozen=True)
class Staged:
    """Updates written once, so that what is looked up and what is merged are the same rows; the buckets are seen as they are written."""

    spark: SparkSession
    place: str
    schema: T.StructType
    buckets: list[int]

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.place)

    def remove(self) -> None:
        remove_path(self.spark, self.place)


class BucketStore:
    def __init__(self, spark: SparkSession, table: str, keys: Sequence[str], location: str | None, buckets: int):
        self.spark, self.table, self.keys = spark, table, list(keys)
        self.store = f"{table}__buckets"
        self.read = self._versions()  # bucket -> version that the view reads
        if self.exists():
            self.home = table_location(spark, self.store).rstrip("/")
            buckets = int(self._property(self.store, "harbormill.buckets"))
        else:
            if spark.catalog.tableExists(table):
                raise ValueError(f"{table} is a table without buckets; load it into a new one")
            self.home = home_of(spark, self.store, location)
        self.buckets = buckets

    def _property(self, name: str, key: str) -> str | None:
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        return found.get(key)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.store)

    def _versions(self) -> dict[int, str]:
        if not (self.exists() and self.spark.catalog.tableExists(self.table)):
            return {}
        text = self._property(self.table, VERSIONS) or ""
        groups = [group.split("=") for group in text.split(";") if group]
        return {int(b): version for version, members in groups for b in members.split(",")}

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def fitted(self, rows: DataFrame) -> DataFrame:
        """Columns and types of the table, so that equal ids hash alike."""
        if not self.exists():
            return rows
        own = [f for f in self.spark.table(self.store).schema.fields if f.name not in (BUCKET, VERSION)]
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in own])

    def stage(self, rows: DataFrame) -> Staged:
        place, seen = shared_dir(self.spark, "upsert"), Observation("staged")
        with_bucket = self.with_bucket(rows)
        with_bucket.observe(seen, buckets_to_see()).write.parquet(place)
        return Staged(self.spark, place, with_bucket.schema, seen_buckets(seen))

    def _picked(self, buckets: Iterable[int]) -> str:
        """Condition on the partition columns for the versions that the view reads of some buckets."""
        by_version: dict[str, list[int]] = {}
        for b in sorted(buckets):
            if b in self.read:
                by_version.setdefault(self.read[b], []).append(b)
        parts = [f"({VERSION} = '{v}' AND {BUCKET} IN ({', '.join(map(str, bs))}))" for v, bs in by_version.items()]
        return " OR ".join(parts) or "false"

    def current(self, buckets: Sequence[int]) -> DataFrame:
        """What the view reads of some buckets, with the bucket."""
        return self.spark.table(self.store).where(self._picked(buckets)).drop(VERSION)

    def create(self, schema: T.StructType) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != BUCKET)
        self.spark.sql(
            f"CREATE TABLE {self.store} ({columns}, {BUCKET} INT, {VERSION} STRING) USING {FORMAT} PARTITIONED BY ({BUCKET}, {VERSION}) "
            f"LOCATION '{self.home}' TBLPROPERTIES ('harbormill.buckets' = '{self.buckets}')"
        )

    def write(self, rows: DataFrame) -> str:
        """New versions of the buckets that the rows lie in, one file each: ids are hashed, so buckets are of equal size."""
        version = uuid.uuid4().hex[:12]
        tasks = min(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = rows.withColumn(VERSION, F.lit(version)).repartition(tasks, BUCKET)
        dealt.write.mode("append").partitionBy(BUCKET, VERSION).format(FORMAT).save(self.home)
        return version

    def switch(self, touched: Sequence[int], version: str) -> dict[int, str]:
        """Let the view read the new version of the touched buckets; returns the versions it read of them before."""
        before = {b: self.read[b] for b in touched if b in self.read}
        self.read |= dict.fromkeys(touched, version)
        if touched:
            added = " ".join(f"PARTITION ({BUCKET} = {b}, {VERSION} = '{version}')" for b in touched)
            self.spark.sql(f"ALTER TABLE {self.store} ADD IF NOT EXISTS {added}")
        groups: dict[str, list[str]] = {}
        for b, v in sorted(self.read.items()):
            groups.setdefault(v, []).append(str(b))
        listed = ";".join(f"{v}={','.join(bs)}" for v, bs in groups.items())
        names = [f"`{f.name}`" for f in self.spark.table(self.store).schema.fields if f.name not in (BUCKET, VERSION)]
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.table} TBLPROPERTIES ('{VERSIONS}' = '{listed}') "
            f"AS SELECT {', '.join(names)} FROM {self.store} WHERE {self._picked(self.read)}"
        )
        return before

    def remove(self, versions: dict[int, str]) -> None:
        """Versions that the view no longer reads."""
        if not versions:
            return
        gone = ", ".join(f"PARTITION ({BUCKET} = {b}, {VERSION} = '{v}')" for b, v in versions.items())
        self.spark.sql(f"ALTER TABLE {self.store} DROP IF EXISTS {gone}")
        for b, v in versions.items():
            remove_path(self.spark, f"{self.home}/{BUCKET}={b}/{VERSION}={v}")
