"""Session settings the flows rely on, and the shared folder for checkpoints and tables."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MARKER = "clickloom.configured"
BRIEF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SQL_SETTINGS = {
    # Hours, days and partitions are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, even when that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A table is broadcast by the size of its rows, several times that of its compressed files.
    "spark.sql.sources.fileCompressionFactor": "8.0",
    # Rows go to Python in small batches, so that long texts do not fill a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Sessions of a stream are merged per map partition before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings; everything else is left to the cluster."""
    if spark.conf.get(MARKER, None) is None:
        for name, value in SQL_SETTINGS.items():
            spark.conf.set(name, value)
        spark.conf.set(MARKER, "true")
    return spark


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is computed once, or a stream that is started, inside: its shuffle files go when a query or batch ends, not when
    the driver collects its garbage."""
    before = spark.conf.get(BRIEF, "false")
    spark.conf.set(BRIEF, "true")
    try:
        yield
    finally:
        spark.conf.set(BRIEF, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None and context.getCheckpointDir() is not None:
        folder = os.path.dirname(context.getCheckpointDir())
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="clickloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, never used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and kept when executors are lost."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that this run wrote to the shared folder and that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
