"""Sinks that number their batches: compaction beside a writing stream, update and complete results, the progress log."""

import os

from pyspark.sql import functions as F

from clickloom.streaming import sinks


def files(path):
    return sum(n.endswith(".parquet") for _, _, names in os.walk(path) for n in names)


def write(spark, path, number, run="r1", n=40):
    rows = spark.range(number * n, number * n + n, numPartitions=4).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"))
    sinks.replace_batch(rows, path, (run, number), ("day",))


def ids(spark, path):
    return sorted(r["id"] for r in sinks.batches(spark, path).select("id").collect())


def test_compaction_beside_a_writing_stream(spark, tmp_path):
    path = f"{tmp_path}/t"
    for number in range(5):
        write(spark, path, number)
    assert ids(spark, path) == list(range(200))
    before = files(path)
    sinks.compact(spark, path, ["day"])
    # The batch under way is repeated and another one follows; published batches are read from the compacted table only.
    write(spark, path, 4)
    write(spark, path, 5)
    assert ids(spark, path) == list(range(240))
    sinks.clean(spark, path, ["day"])
    assert ids(spark, path) == list(range(240)) and files(path) < before
    # A repeated compaction takes the batches that have finished since, and nothing twice; another run is apart.
    write(spark, path, 0, "r2")
    sinks.compact(spark, path, ["day"])
    sinks.compact(spark, path, ["day"])
    sinks.clean(spark, path, ["day"])
    assert ids(spark, path) == sorted([*range(240), *range(40)])
    loose = spark.read.parquet(path).select("run", "batch").distinct().collect()
    assert {tuple(r) for r in loose} == {("r1", 5), ("r2", 0)}


def test_a_stopped_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    from clickloom.operators import snapshots
    path = f"{tmp_path}/t"
    for number in range(3):
        write(spark, path, number)
    for step in ("_write_data", "_write_version", "_publish"):
        def stopped(*args):
            raise RuntimeError("stopped")
        monkeypatch.setattr(snapshots, step, stopped)
        try:
            sinks.compact(spark, path, ["day"])
        except RuntimeError:
            pass
        monkeypatch.undo()
        assert ids(spark, path) == list(range(120))
    sinks.compact(spark, path, ["day"])
    assert ids(spark, path) == list(range(120))


def test_latest_values_and_last_batch(spark):
    rows = spark.createDataFrame([("a", None, 1, "r", 0), ("a", "x", 2, "r", 0), ("a", None, 5, "r", 2), ("b", "x", 3, "r", 1)],
                                 "k string, s string, v int, run string, batch int")
    assert sorted(map(tuple, sinks.latest_values(rows, ["k", "s"]).collect()), key=str) == [
        ("a", "x", 2), ("a", None, 5), ("b", "x", 3)]
    assert [tuple(r) for r in sinks.last_batch(rows).collect()] == [("a", None, 5)]


def test_clean_before_a_first_compaction(spark, tmp_path):
    """The first batches may hold no rows, so that nothing is finished yet."""
    path = f"{tmp_path}/t"
    write(spark, path, 2)
    sinks.compact(spark, path, ["day"])
    sinks.clean(spark, path, ["day"])
    assert ids(spark, path) == list(range(80, 120))
