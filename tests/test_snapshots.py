"""Snapshot tables: versions, what is opened, stops between steps, rival writers, erasure."""

import os

import pytest
from pyspark.sql import functions as F

from clickloom.operators import privacy, snapshots
from clickloom.operators.snapshots import FILE

SCHEMA = "event_id string, event_type string, user_id string, timestamp long, day int, place string"
ROWS = [(f"{d}-{i}", "x", f"u{i % 3}", i, d, p) for d in (1, 2, 3, None) for i, p in enumerate(("a b%20", "h/w:1+é", None, "="))]


def table(spark, path, rows=ROWS, keys=("event_id",)):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("updated_at", F.lit(None).cast("timestamp"))
    return snapshots.create(spark, path, frame, ["day", "place"], list(keys))


def content(spark, path, *columns):
    names = columns or ("event_id", "event_type", "day", "place")
    return sorted((tuple(r) for r in snapshots.read(spark, path).select(*names).collect()), key=str)


def plain(rows):
    return sorted(((r[0], r[1], r[4], r[5]) for r in rows), key=str)


def upsert(spark, path, rows):
    return snapshots.upsert(spark, path, spark.createDataFrame(rows, SCHEMA), F.lit("2024-01-31").cast("timestamp"),
                            updated=["event_type"])


def test_odd_partitions_and_versions(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not snapshots.exists(spark, path)
    table(spark, path)
    assert content(spark, path) == plain(ROWS)
    later = upsert(spark, path, [("2-1", "y", "u1", 9, 5, "elsewhere"), ("new", "n", "u9", 9, 2, "h/w:1+é"), (None, "z", "u", 1, 1, None)])
    wanted = [r if r[0] != "2-1" else ("2-1", "y", *r[2:]) for r in ROWS] + [
        ("new", "n", "u9", 9, 2, "h/w:1+é"), (None, "z", "u", 1, 1, None)]
    assert content(spark, path) == plain(wanted) and later.number == 2
    first = snapshots.current(spark, path, 1).data()
    assert sorted((tuple(r) for r in first.select("event_id", "event_type", "day", "place").collect()), key=str) == plain(ROWS)


def test_only_files_with_staged_keys_are_opened(spark, tmp_path):
    path = f"{tmp_path}/t"
    before = table(spark, path)
    staged = spark.createDataFrame([("2-1", "y", "u1", 9, 2, None), ("unknown", "y", "u1", 9, 3, None)], SCHEMA)
    held = [r[FILE] for r in before.holding(staged, ["event_id"]).collect()]
    assert len(held) == 1 and "day=2" in held[0]
    opened = before.rows(before.holding(staged, ["event_id"]))
    assert len(opened.inputFiles()) == 1 < len(before.data().inputFiles())
    after = upsert(spark, path, [("2-1", "y", "u1", 9, 2, None), ("unknown", "y", "u1", 9, 3, None)])
    names = lambda t: {r[FILE] for r in t.files.collect()}
    assert names(before) - names(after) == set(held)
    # The same rows as by a scan of all keys.
    other = f"{tmp_path}/other"
    table(spark, other, keys=())
    upsert(spark, other, [("2-1", "y", "u1", 9, 2, None), ("unknown", "y", "u1", 9, 3, None)])
    assert content(spark, path) == content(spark, other)


def test_replace_and_erase(spark, tmp_path):
    path = f"{tmp_path}/t"
    table(spark, path)
    moved = spark.createDataFrame([("all", "m", "u1", 1, 9, "moved")], SCHEMA).withColumn("updated_at", F.lit(None).cast("timestamp"))
    snapshots.replace_rows(spark, path, moved, ["user_id"])
    left = [r for r in ROWS if r[2] != "u1"] + [("all", "m", "u1", 1, 9, "moved")]
    assert content(spark, path) == plain(left)
    privacy.erase_from_table(spark, path, spark.createDataFrame([("u0",), ("nobody",)], "user_id string"))
    assert content(spark, path) == plain([r for r in left if r[2] != "u0"])
    # Nothing of the erased user is left in the folder, and only the current version.
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/data")
    assert stored.where("user_id = 'u0'").count() == 0 and os.listdir(f"{path}/versions") == ["3"]
    privacy.erase_from_table(spark, path, snapshots.read(spark, path).select("user_id"))
    assert content(spark, path) == []
    upsert(spark, path, [("again", "x", "u", 1, 1, "a")])
    assert content(spark, path) == [("again", "x", 1, "a")]


@pytest.mark.parametrize("step", ["_write_data", "_write_keys", "_write_version", "_publish"])
@pytest.mark.parametrize("after", [False, True])
def test_a_stop_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, after):
    path, real = f"{tmp_path}/t", getattr(snapshots, step)
    table(spark, path, ROWS[:4])
    change = [("1-0", "y", "u0", 9, 1, "a b%20"), ("new", "n", "u9", 9, 2, "q")]
    wanted = plain([("1-0", "y", *ROWS[0][2:]), *ROWS[1:4], ("new", "n", "u9", 9, 2, "q")])

    def stopped(*args):
        if after:
            real(*args)
        raise RuntimeError("stopped")
    monkeypatch.setattr(snapshots, step, stopped)
    with pytest.raises(RuntimeError):
        upsert(spark, path, change)
    monkeypatch.undo()
    published = step == "_publish" and after
    assert content(spark, path) == (wanted if published else plain(ROWS[:4]))
    upsert(spark, path, change)
    assert content(spark, path) == wanted


def test_a_stopped_vacuum_can_be_repeated(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    table(spark, path)
    upsert(spark, path, [("1-0", "y", "u0", 9, 1, "a b%20")])
    wanted, real, left = content(spark, path), snapshots._hadoop, [8]

    def failing(*args):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("stopped")
        return real(*args)
    monkeypatch.setattr(snapshots, "_hadoop", failing)
    with pytest.raises(RuntimeError):
        for _ in range(20):
            snapshots.vacuum(spark, path)
    monkeypatch.undo()
    assert content(spark, path) == wanted
    snapshots.vacuum(spark, path)
    assert content(spark, path) == wanted and os.listdir(f"{path}/versions") == ["2"]


def test_the_second_of_two_writers_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    one, two = table(spark, path, ROWS[:2]), snapshots.current(spark, path)
    row = spark.createDataFrame([("n", "x", "u", 1, 1, "a")], SCHEMA).withColumn("updated_at", F.lit(None).cast("timestamp"))
    one.replace(None, row)
    with pytest.raises(Exception, match="(?i)exist"):
        two.replace(None, row)
    assert len(content(spark, path)) == 3
