"""Metric samples: increases, quantiles, sustained alerts, drift and lag."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import insights, privacy, quality, timeseries as ts


def samples(spark, *rows):
    df = spark.createDataFrame([(t, "m", {"b": "2", "a": s}, v) for t, s, v in rows],
                               "t string, metric string, labels map<string,string>, value double")
    return ts.with_series(df.withColumn("ts", F.col("t").cast("timestamp")).drop("t"))


def test_increase_with_reset(spark):
    df = samples(spark, ("2024-01-01 00:00:00", "x", 5.0), ("2024-01-01 00:01:00", "x", 8.0), ("2024-01-01 00:02:00", "x", 2.0),
                 ("2024-01-01 01:00:00", "x", 6.0), ("2024-01-01 03:59:00", "x", 1.0), ("2024-01-01 00:05:00", "y", 7.0))
    found = {(r.series, str(r.window_start)): r.increase for r in ts.counter_increase(df, "1 hour").collect()}
    assert found == {('{"a":"x","b":"2"}', "2024-01-01 00:00:00"): 5.0, ('{"a":"x","b":"2"}', "2024-01-01 01:00:00"): 4.0,
                     ('{"a":"x","b":"2"}', "2024-01-01 03:00:00"): 1.0, ('{"a":"y","b":"2"}', "2024-01-01 00:00:00"): 0.0}
    rate = ts.counter_rate(df, "1 hour").where("increase = 4").first()
    assert rate.per_second == pytest.approx(4 / 3600)
    wide = {r.a: r.increase for r in ts.sum_by(ts.counter_increase(df, "1 hour"), ["a"], "increase").collect()}
    assert wide == {"x": 10.0, "y": 0.0}


def test_gauge_and_stats(spark):
    df = samples(spark, ("2024-01-01 00:00:00", "x", 5.0), ("2024-01-01 00:01:00", "x", None), ("2024-01-01 00:00:30", "y", 2.0))
    last = ts.gauge_last(df)
    assert sorted(r.value for r in last.collect()) == [2.0, 5.0]
    assert tuple(ts.series_stats(last, 100.0).first()) == ("m", 350.0, 2)


def test_histogram_quantile(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(1, 11)] + [("b", 99.0)], "k string, v double")
    buckets = ts.histogram(df, F.col("v"), ["k"], [2.0, 4.0, 8.0])
    assert [(r.le, r.cumulative) for r in buckets.where("k = 'a'").orderBy("le").collect()] == [
        (2.0, 2), (4.0, 4), (8.0, 8), (float("inf"), 10)]
    half = {r.k: r.quantile_value for r in ts.histogram_quantile(buckets, ["k"], 0.5).collect()}
    assert half == {"a": 5.0, "b": 8.0}
    top = {r.k: r.quantile_value for r in ts.histogram_quantile(buckets, ["k"], 0.95).collect()}
    assert top["a"] == 8.0


def test_sustained(spark):
    minutes = [(0, 0.2), (1, 0.2), (2, 0.2), (3, 0.0), (4, 0.2), (5, 0.2), (7, 0.2), (8, 0.2)]
    df = spark.createDataFrame(minutes, "m int, v double").withColumn("slot_start", F.timestamp_seconds(F.col("m") * 60))
    found = ts.sustained(df, [], ts.rule_breach("HighErrorRate", F.col("v")), "1 minute", "2 minutes").collect()
    assert [(str(r.started_at), str(r.fired_at), r.windows) for r in found] == [
        ("1970-01-01 00:00:00", "1970-01-01 00:02:00", 3)]
    low = spark.createDataFrame([(5.0,), (10.0,)], "v double").where(ts.rule_breach("DiskSpaceLow", F.col("v")))
    assert low.count() == 1


def test_lag_levels(spark):
    marks = spark.createDataFrame([("t", p, h) for p, h in enumerate([10, 1500, 20000])], "topic string, partition int, high_mark long")
    done = spark.createDataFrame([("t", 0, 10), ("t", 1, 100)], "topic string, partition int, position long")
    found = {r.partition: (r.lag, r.status) for r in quality.lag_check(marks, done).collect()}
    assert found == {0: (0, "ok"), 1: (1400, "warn"), 2: (20000, "fail")}


def test_incremental_extract_starts_empty(make):
    df = make([{"ts": "2024-01-01 00:10:00"}, {"ts": "2024-01-01 01:10:00"}, {"ts": "2024-01-01 02:10:00"}])
    end = F.lit("2024-01-01 02:30:00").cast("timestamp")
    empty = df.where("false").select(F.col("timestamp").alias("hour_start"))
    first = privacy.extract_after(df, empty, end)
    assert sorted(str(r.hour_start) for r in first.collect()) == ["2024-01-01 00:00:00", "2024-01-01 01:00:00"]
    assert privacy.extract_after(df, first, end).count() == 0


def test_anomaly(make):
    rows = [{"ts": f"2024-01-01 {h:02d}:00:0{i}"} for h in range(10) for i in range(1 + h % 2)]
    rows += [{"ts": f"2024-01-01 10:00:{i:02d}"} for i in range(40)]
    found = insights.anomaly_windows(make(rows)).where("is_anomaly").collect()
    assert [str(r.slot_start) for r in found] == ["2024-01-01 10:00:00"]


def test_profile_sketch(make):
    df = make([{"ts": "2024-01-01 00:00:00", "source": None}, {"ts": "2024-01-01 00:00:01"}])
    rows = {r.column_name: r for r in insights.profile_columns(df, ["source", "event_id"]).collect()}
    assert rows["source"].null_percent == 50.0 and rows["event_id"].distinct_values == 2
