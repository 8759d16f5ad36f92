"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution picks joins and partition sizes from what the stages really hold.
# Hot keys in joins are split at run time by adaptive execution. By default it leaves a
# skewed join alone when the split would cost another shuffle later in the plan; with a
# third of the rows on one key the extra shuffle is always the cheaper choice.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark broadcasts a table by the size of its files. Parquet unpacks to a multiple of
    # that, so without the factor a side well above the limit would be broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.ansi.enabled": "true",
    # Facts lie in a folder per month. Up to this many folders the driver lists by itself,
    # which is quicker than a job that lists them.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "500",
}


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tuned(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", app: str = "parcelhouse", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores if cores != "*" else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="parcelhouse-")
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, shuffle files go when the query that wrote them ends.

    Else they stay until the driver collects garbage, which a driver that only plans seldom does:
    a build of many queries would keep the shuffles of all of them.
    """
    before = spark.conf.get(REMOVE_SHUFFLES)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/parcelhouse/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Write a frame to the shared folder once, so that it is never computed again."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def kept(df):
    """The same rows, computed once: written to the shared folder and read from there."""
    path = scratch_dir(df.sparkSession, "kept")
    df.write.option("compression", "zstd").option(
        "parquet.writer.version", "PARQUET_2_0").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
