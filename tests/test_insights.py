"""Address prefixes, kinds of values, sketches by day."""

import ipaddress
import random

from pyspark.sql import functions as F

from clickloom.operators import insights


def test_ranges_become_the_fewest_blocks(spark):
    rng, top = random.Random(3), (1 << 32) - 1
    ranges = [(0, top), (0, 0), (top, top), (1, top - 1), (5, 6), (7, 8), (255, 256), (0, 2 ** 31 - 1)]
    for _ in range(200):
        a = rng.randrange(top)
        ranges.append((a, min(top, a + rng.randrange(1 << rng.randrange(1, 32)))))
    networks = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ranges)], "id int, first_ip long, last_ip long")
    found = {}
    for r in insights.address_prefixes(networks).collect():
        found.setdefault(r.id, set()).add((r._prefix << r._bits, 32 - r._bits))
    for i, (a, b) in enumerate(ranges):
        wanted = {(int(n.network_address), n.prefixlen) for n in ipaddress.summarize_address_range(
            ipaddress.ip_address(a), ipaddress.ip_address(b))}
        assert found[i] == wanted


def test_many_ranges_in_one_block(spark):
    """65,536 ranges of one address in one /16, and a hot address: every address meets its own range only."""
    base = 10 << 24
    networks = spark.range(1 << 16).select(F.format_string("n%d", "id").alias("name"), (F.col("id") + base).alias("first_ip"),
                                           (F.col("id") + base).alias("last_ip"))
    whole = spark.createDataFrame([("whole", base, base + 2 ** 24 - 1)], "name string, first_ip long, last_ip long")
    events = spark.range(20000).select(F.col("id").cast("string").alias("event_id"), F.when(F.col("id") % 2 == 0, base + 7).when(
        F.col("id") % 7 == 0, F.lit(None)).otherwise(base + F.col("id") * 11).alias("ip"))
    found = insights.locate_ip(events, networks.unionByName(whole), F.col("ip"))
    assert found.columns == ["event_id", "ip", "name"] and found.count() == 20000
    wrong = F.when(F.col("ip").isNull(), F.col("name").isNotNull()).when(
        F.col("ip") - base < (1 << 16), F.col("name") != F.format_string("n%d", F.col("ip") - base)).otherwise(F.col("name") != "whole")
    assert found.where(wrong).count() == 0


def test_kinds_merge(spark):
    def kind(*values):
        rows = spark.createDataFrame([(v,) for v in values], "v string")
        return rows.agg(F.bit_or(insights.value_kind(F.col("v"))).alias("b")).select(insights.kind_name(F.col("b"))).first()[0]
    assert kind("1", "-20", None) == "integer" and kind("1", "2.5") == "number" and kind("1e5", ".5") == "number"
    assert kind("true", "FALSE") == "boolean" and kind("true", "1") == "text" and kind("1", "x") == "text"
    assert kind(None) == "null" and kind("") == "text" and kind("9" * 30) == "number"


def test_changed_types(spark):
    rows = [("2024-01-01", "a", {"k": "1", "p": "2"}), ("2024-01-01", "a", {"k": "x"}), ("2024-01-02", "a", {"k": "5", "p": "1.5"}),
            ("2024-01-02", "b", {}), ("2024-01-02", "a", {"k": None, "new": "1"})]
    events = spark.createDataFrame(rows, "ts string, event_type string, properties map<string,string>").withColumn(
        "timestamp", F.col("ts").cast("timestamp"))
    baseline = spark.createDataFrame([("a", "k", "integer"), ("a", "p", "number"), ("b", "z", None)],
                                     "event_type string, key string, kind string")
    found = {(str(r.day), r.event_type, r.key, r.rows, r.drift) for r in insights.schema_drift(events, baseline).collect()}
    assert found == {("2024-01-01", "a", "k", 2, "changed_type"), ("2024-01-02", "a", "new", 1, "new_key"),
                     ("2024-01-02", "b", "z", 0, "missing_key")}


def test_sketches_merge_over_days(spark, tmp_path):
    rows = spark.range(40000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("day"),
        (F.col("id") % 5000).alias("user"), F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("value"))
    rows.write.partitionBy("day").parquet(f"{tmp_path}/rows")
    table = spark.read.parquet(f"{tmp_path}/rows")
    path = f"{tmp_path}/sketches"
    for day in range(1, 5):
        one = table.where(F.col("day") == F.lit(f"2024-01-0{day}").cast("date"))
        assert len(one.inputFiles()) and "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
        insights.daily_sketches(one, ["user", "value"], F.col("day")).write.mode("append").parquet(path)
    merged = {r.column_name: r for r in insights.merged_profile(spark.read.parquet(path)).collect()}
    assert abs(merged["user"].distinct_values / 5000 - 1) < 0.05 and abs(merged["value"].distinct_values / 36000 - 1) < 0.05
    assert merged["value"].null_percent == 10.0 and merged["value"].rows == 40000
    assert abs(merged["value"].quantiles[0] / 20000 - 1) < 0.05
    part = insights.merged_profile(spark.read.parquet(path).where("day >= '2024-01-03'"))
    assert part.where("column_name = 'user'").first()["rows"] == 20000
