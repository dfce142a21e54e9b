"""Upserts, table rewrites, retention, privacy and the hourly run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from clickloom.operators import kpi, privacy, quality, snapshots, warehouse
from clickloom.plans import flows
from clickloom.sources import tables

SCHEMA = "event_id string, event_type string, properties string, customer_segment string, event_revenue double, timestamp long, day int"
NOW = "2024-01-31 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def with_update(df):
    return df.withColumn("updated_at", F.lit(None).cast("timestamp"))


def test_upsert_with_null_keys_and_copies(spark):
    target = with_update(frame(spark, ("a", "x", "p", "S", 1.0, 1, 1), (None, "x", "p", "S", 2.0, 1, 1)))
    staging = frame(spark, ("a", "y", "q", "T", 5.0, 2, 2), ("b", "y", "q", "T", 6.0, 1, 2), ("b", "z", "q", "T", 7.0, 3, 2),
                    (None, "n", "q", "T", 8.0, 1, 2))
    rows = {(r.event_id, r.event_type): r for r in warehouse.upsert(target, staging, now()).collect()}
    assert set(rows) == {("a", "y"), (None, "x"), ("b", "z"), (None, "n")}
    changed = rows[("a", "y")]
    # the four update columns change, the others stay
    assert (changed.properties, changed.event_revenue, changed.timestamp, changed.day) == ("q", 5.0, 1, 1)
    assert str(changed.updated_at) == NOW and rows[("b", "z")].updated_at is None


def test_upsert_sets_null_like_the_staging_row(spark):
    target = with_update(frame(spark, ("a", "x", "p", "S", 1.0, 1, 1)))
    found = warehouse.upsert(target, frame(spark, ("a", "x", "p", None, None, 2, 1)), now()).first()
    assert found.customer_segment is None and found.event_revenue is None


def test_latest_and_changes(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, t int, v string")
    assert sorted(tuple(r) for r in warehouse.latest_per_key(df, ["k"], ["t"]).collect()) == [("a", 3, "z"), ("b", 1, None)]
    changes = spark.createDataFrame([("a", 9, "q", "u"), ("a", 10, "q", "d"), ("c", 1, "n", "c")], "k string, t int, v string, op string")
    found = warehouse.apply_changes(df.where("t < 2"), changes, "k", ["t"])
    assert sorted(tuple(r) for r in found.collect()) == [("b", 1, None), ("c", 1, "n")]


def test_tiers(spark):
    df = spark.createDataFrame([(d,) for d in (0, 30, 90, 365, 2554, 2555)], "d int")
    names = [r[0] for r in df.select(warehouse.tier("raw", F.col("d"))).collect()]
    assert names == ["STANDARD", "STANDARD_IA", "GLACIER", "DEEP_ARCHIVE", "DEEP_ARCHIVE", "EXPIRED"]
    assert [r[0] for r in df.select(warehouse.tier("logs", F.col("d"))).collect()] == ["STANDARD", "GLACIER"] + ["EXPIRED"] * 4


def test_region_access(spark):
    df = spark.createDataFrame([("US",), ("CA",), ("UK",), ("FR",)], "r string")
    see = lambda viewer: [r.r for r in privacy.visible_to(df, viewer, F.col("r")).collect()]
    assert see("US") == ["US", "CA"] and see("EU") == ["UK"] and see("ASIA") == []


def test_revenue_and_activity_of_own_rows(spark):
    rows = [("ann", "purchase", 40.25), ("ann", "search", None), ("bob", "purchase", 9.75), ("bob", "purchase", 10.0),
            ("cyd", "search", 1e20), ("cyd", "search", float("nan")), ("cyd", "add_to_cart", 5.0)]
    df = spark.createDataFrame([(*r, f"2031-03-0{i + 1} 10:00:00") for i, r in enumerate(rows)],
                               "user_id string, event_type string, value double, timestamp string")
    by_type = {r[0]: tuple(r[1:]) for r in kpi.revenue_by_type(df).collect()}
    assert by_type["purchase"] == (3, 60.0, 2) and by_type["add_to_cart"] == (1, 5.0, 1)
    assert by_type["search"][0] == 3 and by_type["search"][1] is None  # neither null, huge nor not-a-number sums
    activity = {r.user_id: (r.total_events, r.total_value, r.event_types) for r in kpi.user_activity(df).collect()}
    assert activity == {"ann": (2, 40.25, ["purchase", "search"]), "bob": (2, 19.75, ["purchase"]),
                        "cyd": (3, 5.0, ["add_to_cart", "search"])}
    checks = quality.expect(df, [quality.fits_money("value")]).first()
    assert (checks.rule, checks.value, checks.passed) == ("value_fits_money", 2, False)


def test_hourly_run(spark, sf_dir, tmp_path):
    root = f"{tmp_path}/house"
    messages, people, goods = tables.messages(spark, sf_dir), tables.profiles(spark, sf_dir), tables.products(spark, sf_dir)
    early = messages.where("timestamp < timestamp'2024-01-20 12:00:00'")
    # the second run repeats some messages of the first
    late = messages.where("timestamp >= timestamp'2024-01-18 00:00:00'")
    run = lambda m, at: flows.hourly_run(spark, m, people, goods, root, F.lit(at).cast("timestamp"), "40 days")
    assert run(early, "2024-01-20 13:00:00").where("NOT passed").count() == 0
    assert run(late, "2024-01-31 00:00:00").where("NOT passed").count() == 0
    whole = flows.enrichment(messages, people, goods)
    stored = snapshots.read(spark, f"{root}/events")
    assert stored.count() == stored.select("event_id").distinct().count() == whole.lake.count()
    from clickloom.operators.sessions import session_metrics
    wanted = session_metrics(whole.lake)
    found = snapshots.read(spark, f"{root}/user_sessions")
    columns = ["session_id", "user_id", "session_start", "session_end", "total_events", "session_revenue", "abandoned_cart"]
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert key(found) == key(wanted)
    days = spark.read.parquet(f"{root}/daily_summary")
    assert days.agg(F.sum("total_events")).first()[0] == stored.count()
    assert days.count() == days.select("report_date").distinct().count()
    before = key(found)
    run(late, "2024-01-31 00:00:00")
    assert key(snapshots.read(spark, f"{root}/user_sessions")) == before
    issues = spark.read.parquet(f"{root}/quality_issues")
    assert issues.select("event_id").distinct().count() == whole.issues.count() > 0
    assert spark.read.parquet(f"{root}/realtime_metrics").count() > 0
    with pytest.raises(ValueError, match="freshness"):
        flows.hourly_run(spark, early, people, goods, root, F.lit("2024-06-01").cast("timestamp"))


def test_failed_check_leaves_no_report(spark, sf_dir, tmp_path, monkeypatch):
    from clickloom.operators import quality as rules
    root = f"{tmp_path}/house"
    monkeypatch.setattr(rules, "unique", lambda *columns: rules.Rule("never", F.lit(False)))
    with pytest.raises(ValueError, match="stored events: never"):
        flows.hourly_run(spark, tables.messages(spark, sf_dir), tables.profiles(spark, sf_dir),
                         tables.products(spark, sf_dir), root, F.lit("2024-01-31").cast("timestamp"), "40 days")
    assert os.path.exists(f"{root}/events") and not os.path.exists(f"{root}/daily_summary")
