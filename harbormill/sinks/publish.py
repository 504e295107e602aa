"""Publication behind checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from harbormill.quality.checks import FAILED, Contract
from harbormill.session import remove_path
from harbormill.sinks.tables import fitted
from harbormill.sinks.versions import home_of, observed, publish_place, write_version


class PublicationBlocked(RuntimeError):
    """A required check failed or is missing; the target was not touched."""


@dataclass(frozen=True)
class Published:
    rows: int
    results: list[tuple[str, str]]


def publish_if_pass(
    df: DataFrame,
    checks: Contract | Callable[[DataFrame], DataFrame],
    target: str,
    required: tuple[str, ...] = (),
    location: str | None = None,
    also: DataFrame | None = None,
    step: Callable[[str], None] = lambda _: None,
) -> Published:
    """Write, check what was written, and only then let the target read it.

    A contract's counts are observed during the one write; other checks, a function from rows to one row per check, scan what
    was written. ``also`` adds results known without the rows. A FAILED check, or a required check
    that is not among the results, stops the publication and removes what was written. The rows that were checked are the
    files that are published, whatever happens to executors in between, and the target moves to them in one step.
    """
    spark = df.sparkSession
    rows = fitted(df, target) if spark.catalog.tableExists(target) else df
    contract = checks if isinstance(checks, Contract) else Contract("", ())
    seen = Observation("publish")
    home = home_of(spark, target, location)
    step("write")
    place = write_version(rows.observe(seen, *contract.counts()), home)
    counts = observed(seen)
    step("check")
    written = spark.read.schema(rows.schema).parquet(place)
    if not isinstance(checks, Contract):
        judged = checks(written)
    elif counts:
        judged = contract.results_of(spark, counts)
    else:
        judged = contract.results(written.agg(*contract.counts()))
    judged = judged.select("check", "status")
    judged = judged.unionByName(also.select("check", "status")) if also is not None else judged
    results = [(r["check"], r["status"]) for r in judged.collect()]
    failed = sorted(name for name, status in results if status == FAILED)
    missing = sorted(set(required) - {name for name, _ in results})
    if failed or missing:
        remove_path(spark, place)
        raise PublicationBlocked(f"{target}: failed checks {failed}, missing checks {missing}")
    publish_place(rows, target, place, home, step)
    return Published(counts.get("total", 0), results)


def gate(results: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """One row: whether the results allow publication."""
    names = F.array(*[F.lit(r) for r in required]) if required else F.array().cast("array<string>")
    seen = F.collect_set(F.when(F.col("check").isin(*required), F.col("check"))) if required else F.array().cast("array<string>")
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.coalesce(F.sum(F.when(F.col("status") == FAILED, 1).otherwise(0)), F.lit(0)).alias("failed"),
        F.size(F.array_except(names, seen)).cast("bigint").alias("missing"),
    ).withColumn("published", (F.col("failed") == 0) & (F.col("missing") == 0))
