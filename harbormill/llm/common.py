"""Helpers that several of these operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harbormill.session import remove_path, shared_dir


def checkpoint(df: DataFrame, keep_partitioning: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage.

    With ``keep_partitioning`` later joins on the columns it is dealt by need no new exchange; the
    job then runs without adaptive planning, under which the partitioning is not known. The folder is the session's ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise ValueError("spark.checkpoint.dir must name storage that all executors share")
        sc.setCheckpointDir(base)
    if not keep_partitioning:
        return df.checkpoint(eager=True)
    adaptive = "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(adaptive, before)


def staged(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as compressed columns below the session's checkpoint folder and read again, and the place for ``discard``."""
    place = shared_dir(df.sparkSession, "llm")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place), place


def discard(spark: SparkSession, place: str) -> None:
    """Remove what ``staged`` wrote, once nothing reads it any more."""
    remove_path(spark, place)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for bounded memos and loaded models.

    Functions travel to the workers by value, so a module global would start
    empty in every task.
    """
    module = sys.modules.setdefault("_harbormill_worker", types.ModuleType("_harbormill_worker"))
    return module.__dict__.setdefault(name, {})


def cleared_text(name: str = "text") -> Column:
    """The text column; null reads as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def connected_components(edges: DataFrame) -> DataFrame:
    """(src long, dst long) -> (node, root): equal roots mean one component.

    Every round each node hooks to its neighbour of least priority if that is
    less than its own, and the links are rewritten to the hooked ends, which at
    least thins every chain by a constant share. Priorities are a bijective
    64-bit hash of the id, so they never tie and order along a chain of ids
    costs nothing. Work per round is a grouped minimum (combined on the map side,
    so a node with very many links is no hot spot) and two equi-joins; links
    never reach the driver. Nodes without a link to another node are absent.
    """
    links = checkpoint(
        edges.where("src <> dst")
        .select(F.xxhash64("src").alias("a"), F.xxhash64("dst").alias("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    names = checkpoint(
        edges.where("src <> dst").select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    )
    hooks = []
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = checkpoint(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("to")))
        hooks.append(hook)
        links = checkpoint(
            links.join(hook.select(F.col("u").alias("a"), F.col("to").alias("ta")), "a")
            .join(hook.select(F.col("u").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct()
        )
    out = names.select("node", F.xxhash64("node").alias("root"))
    for hook in hooks:
        step = hook.select(F.col("u").alias("root"), "to")
        out = out.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return checkpoint(out)
