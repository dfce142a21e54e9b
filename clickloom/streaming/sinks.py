"""Stream sinks: message files or topics, partitioned tables."""

import json
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clickloom.operators import snapshots
from clickloom.operators.warehouse import latest_per_key, write_days
from clickloom.session import brief_shuffles, fresh_path, stored
from clickloom.sources.readers import to_message_json

# ---- Fixed values: how often each sink of the two jobs writes --------------------------------
TRIGGERS = {
    "enriched_events": "10 seconds",
    "data_lake": "30 seconds",
    "realtime_metrics": "1 minute",
    "quality_issues": "30 seconds",
    "session_metrics": "30 seconds",
    "conversion_funnel": "1 minute",
    "user_behavior": "2 minutes",
    "session_alerts": "10 seconds",
}
TOPICS = {
    "enriched_events": "ecommerce-events-enriched",
    "realtime_metrics": "realtime-metrics",
    "quality_issues": "data-quality-issues",
    "session_metrics": "user-sessions",
    "conversion_funnel": "realtime-metrics",
    "session_alerts": "system-alerts",
}
# ---------------------------------------------------------------------------------------------


def _start(writer, name: str, checkpoints: str, once: bool) -> StreamingQuery:
    writer = writer.queryName(name).option("checkpointLocation", f"{checkpoints}/{name}")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGERS[name])
    return writer.start()


def write_messages(df: DataFrame, name: str, target: str, checkpoints: str, once: bool = False,
                   servers: str | None = None) -> StreamingQuery:
    """Rows as JSON messages: to the topic of the sink when ``servers`` is given (needs the
    Kafka connector), else one JSON text per line under ``target/name``."""
    rows = to_message_json(df).writeStream.outputMode("append")
    if servers:
        rows = (rows.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", TOPICS[name]))
    else:
        rows = rows.format("text").option("path", f"{target}/{name}")
    return _start(rows, name, checkpoints, once)


def write_table(df: DataFrame, name: str, target: str, checkpoints: str, partitions: list[str],
                once: bool = False, table_format: str = "parquet") -> StreamingQuery:
    """Append to a partitioned table; the file sink commits every batch exactly once."""
    rows = (df.writeStream.outputMode("append").format(table_format)
            .option("path", f"{target}/{name}").partitionBy(*partitions))
    return _start(rows, name, checkpoints, once)


# What marks the rows of a batch: the stream's own id, which its checkpoint keeps, and the batch number.
Stamp = tuple[str, int]


def write_each(df: DataFrame, name: str, checkpoints: str, outputs: Callable[[DataFrame, Stamp], None],
               once: bool = False, mode: str = "append") -> StreamingQuery:
    """One stream for several outputs: a batch is computed once and handed to ``outputs`` with its stamp; they must
    leave the same result when a batch is repeated."""
    def handle(batch: DataFrame, number: int) -> None:
        kept = batch.sparkSession.read.text(f"{checkpoints}/{name}/metadata").first()["value"]
        batch.persist()
        try:
            outputs(batch, (json.loads(kept)["id"], number))
        finally:
            batch.unpersist()
    return _start(df.writeStream.outputMode(mode).foreachBatch(handle), name, checkpoints, once)


def replace_batch(df: DataFrame, path: str, stamp: Stamp, partitions: tuple[str, ...] = ()) -> None:
    """Write a batch under its stamp, below the table's own partitions: a repeated batch replaces its own files only,
    and a stream with a new checkpoint, whose numbers start again, replaces none."""
    run, number = stamp
    write_days(df.withColumns({"run": F.lit(run), "batch": F.lit(number)}), path, [*partitions, "run", "batch"])


def batches(spark: SparkSession, path: str) -> DataFrame:
    """What ``replace_batch`` has written, with ``run`` and ``batch``; the rows of compacted batches come from the
    compacted table."""
    kept = f"{path}/{COMPACTED}"
    if not snapshots.exists(spark, kept):
        return spark.read.parquet(path)
    table = snapshots.read(spark, kept)
    done = [(r["run"], r["batch"]) for r in table.select("run", "batch").distinct().collect()]
    rows = _loose(spark, path, table.schema)
    if rows is None:
        return table
    for run, batch in done:
        rows = rows.where(~((F.col("run") == run) & (F.col("batch") == batch)))
    return rows.select(*table.columns).unionByName(table)


# Folders whose names begin like this are not read with the table they lie in.
COMPACTED = "_compacted"


def _loose(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The batches that still lie in folders of their own, if there are any."""
    try:
        return spark.read.schema(schema).parquet(path) if spark.read.parquet(path).columns else None
    except AnalysisException:  # no file is left
        return None


def compact(spark: SparkSession, path: str, partitions: list[str]) -> None:
    """Rewrite the finished batches of a table of ``replace_batch`` into few files for each of its ``partitions``.

    A batch is finished when its stream has written a later one. The new files are published as one version of a snapshot
    table, rows and the numbers of the batches they came from at once; ``batches`` reads them from there from then on, so
    the stream goes on writing and a reader never sees a row twice. ``clean`` deletes the old folders later.
    """
    kept = f"{path}/{COMPACTED}"
    done = snapshots.read(spark, kept) if snapshots.exists(spark, kept) else None
    rows = _loose(spark, path, done.schema) if done is not None else spark.read.parquet(path)
    if rows is None:
        return
    last = rows.groupBy("run").agg(F.max("batch").alias("last"))
    finished = rows.join(F.broadcast(last), "run").where("batch < last").drop("last")
    if done is not None:
        finished = finished.join(F.broadcast(done.select("run", "batch").distinct()), ["run", "batch"], "left_anti")
        if finished.limit(1).count():
            snapshots.current(spark, kept).replace(None, finished)
    elif finished.limit(1).count():
        snapshots.create(spark, kept, finished, partitions, [])


def clean(spark: SparkSession, path: str, partitions: list[str]) -> None:
    """Delete the folders of compacted batches, once no reader that started before uses them. If there are none yet,
    because the batches so far had no rows, nothing is deleted."""
    if not snapshots.exists(spark, f"{path}/{COMPACTED}"):
        return
    done = snapshots.read(spark, f"{path}/{COMPACTED}").select(*partitions, "run", "batch").distinct()
    loose = spark.read.schema(done.schema).parquet(path).withColumn("file", F.col("_metadata.file_path"))
    old = loose.join(F.broadcast(done.select("run", "batch").distinct()), ["run", "batch"], "left_semi").select("file").distinct()
    java, context = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for row in stored(old, "old").toLocalIterator():
        file = java.org.apache.hadoop.fs.Path(java.java.net.URI(row["file"]))
        files = file.getFileSystem(context)
        if files.exists(file) and not files.delete(file, False):
            raise OSError(f"{file} is still there")


def latest_values(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The current row of each key (null is a key like any other) of a stream in update mode, whose batches hold the rows
    that changed: that of the last batch."""
    return latest_per_key(rows, keys, ["batch"]).drop("run", "batch")


def last_batch(rows: DataFrame) -> DataFrame:
    """The whole result of a stream in complete mode: its last batch."""
    last = rows.agg(F.max("batch").alias("last"))
    return rows.join(F.broadcast(last), F.col("batch") == F.col("last")).drop("run", "batch", "last")


class ProgressLog(StreamingQueryListener):
    """Keeps a row for each batch of the streams of a session: a small JSON file under ``path``, named by run and batch.

    ``input_rows`` counts what was read, ``late_groups`` the groups of late rows that the watermark closed out: a batch
    merges rows of one key before they reach the state, where they are dropped and counted.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query": p.name, "id": str(p.id), "run": str(p.runId), "batch": p.batchId, "input_rows": p.numInputRows,
               "watermark": p.eventTime.get("watermark"),
               "late_groups": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
               "state_rows": sum(o.numRowsTotal for o in p.stateOperators),
               "observed": {k: v.asDict() for k, v in p.observedMetrics.items()}}
        context = self.spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.runId}-{p.batchId}.json")
        out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place, True)
        out.write(bytearray(json.dumps(row, default=str).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


PROGRESS = ("query string, id string, run string, batch long, input_rows long, watermark timestamp, late_groups long, "
            "state_rows long, observed map<string, map<string, string>>")


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The batches that a ``ProgressLog`` has seen."""
    return spark.read.schema(PROGRESS).json(path)


def wait_logged(spark: SparkSession, path: str, running: StreamingQuery, seconds: int = 60) -> None:
    """Wait for a stream to end and for its last batch to be in the progress log, which is written beside it."""
    running.awaitTermination()
    last, end = running.lastProgress, time.monotonic() + seconds
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{running.runId}-{last['batchId'] if last else -1}.json")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    while last and not files.exists(place):
        if time.monotonic() > end:
            raise TimeoutError(f"{place} was not written")
        time.sleep(0.05)


def started(df: DataFrame, name: str, path: str, checkpoint: str) -> StreamingQuery:
    """A stream that appends to a table what its source holds now."""
    with brief_shuffles(df.sparkSession):
        return (df.writeStream.queryName(name).outputMode("append").format("parquet").option("path", path)
                .option("compression", "zstd").option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def drain(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what its source holds now and return the rows it appended.

    State has one store per shuffle partition of the session for as long as its checkpoint lives."""
    path = fresh_path(spark, name)
    started(df, name, path, fresh_path(spark, f"{name}-checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)
