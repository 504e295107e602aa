"""Session settings and the shared folder used for staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on; the cluster decides the rest
# (memory, executors, number of shuffle partitions).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # whole documents travel to the text functions: keep an Arrow batch to some tens of megabytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Only a session's builder can set this one: without the call site of every column
# expression, planning takes less than half the time.
BUILD_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Bring a session that was made elsewhere to the settings above.

    On one machine any folder is shared, so a local session that names no checkpoint folder gets one; elsewhere it must name it.
    """
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="harbormill-"))
    return spark


def local_session(app: str, cores: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in (REQUIRED_CONF | BUILD_CONF).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the session's checkpoint folder, its lineage cut."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach, below the session's checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; a session without one must call ``setCheckpointDir``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("spark.checkpoint.dir must name storage that all executors share")
    return f"{base.rstrip('/')}/harbormill/{purpose}-{uuid.uuid4().hex}"
