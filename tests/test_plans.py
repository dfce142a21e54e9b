"""Shapes of physical plans: pruning, pushdown, no pair joins, hot keys split at run time."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickloom.operators import enrich
from clickloom.plans import registered
from clickloom.sources import readers, tables

BATCH = sorted(n for n in registered.QUERIES if not n.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text, name):
    found = re.findall(rf"/{name}\.parquet\].*?ReadSchema: struct<([^>]*)>", text)
    return [set(re.findall(r"(\w+):", f)) for f in found]


@pytest.mark.parametrize("name", BATCH)
def test_no_pair_joins(spark, sf_dir, name):
    text = plan(registered.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text


def test_scans_read_only_what_is_used(spark, sf_dir):
    assert read_columns(plan(registered.QUERIES["active_users"](spark, sf_dir)), "events") == [{"ts", "user_id"}]
    assert read_columns(plan(registered.QUERIES["event_rate"](spark, sf_dir)), "events") == [{"ts"}]
    assert read_columns(plan(registered.QUERIES["top_products"](spark, sf_dir)), "lineitem") == [
        {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"}]


def test_filters_reach_the_scan(spark, sf_dir):
    assert "EqualTo(event_type,purchase)" in plan(registered.QUERIES["hourly_revenue"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00" in plan(registered.QUERIES["rolling_extract"](spark, sf_dir))


def test_messages_are_parsed_once(spark, sf_dir):
    sent = spark.createDataFrame([("{}", None, 0, 0)], "value string, timestamp timestamp, offset long, partition int")
    text = plan(enrich.require_fields(readers.parse_events(sent)))
    assert text.count("from_json(") == 1


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture
def small_limits(spark):
    """Limits so low that a few thousand rows count as a skewed partition."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_hot_user_is_split_in_the_profile_join(spark, small_limits):
    n = F.col("id")
    events = spark.range(0, 40000, numPartitions=8).select(
        n.cast("string").alias("event_id"), F.when(n % 3 == 0, "hot").otherwise((n % 500).cast("string")).alias("user_id"),
        F.sha2(n.cast("string"), 256).alias("payload"))
    people = spark.range(500).select(F.col("id").cast("string").alias("user_id"), F.lit("A").alias("customer_segment")).union(
        spark.createDataFrame([("hot", "B")], "user_id string, customer_segment string"))
    joined = enrich.join_profiles(events, people)
    assert "skew=true" in final_plan(joined)
    # also when a grouping follows that would otherwise reuse the join's partitions
    counted = joined.groupBy("user_id", "customer_segment").agg(F.count("*").alias("n"), F.max("payload").alias("p"))
    assert "skew=true" in final_plan(counted)
    assert counted.where("user_id = 'hot'").first()["n"] == 13334


def test_events_without_product_are_spread(spark, small_limits):
    n = F.col("id")
    events = spark.range(0, 40000, numPartitions=8).select(
        n.cast("string").alias("event_id"), F.when(n % 100 == 0, F.create_map(F.lit("product_id"), F.lit("1")))
        .otherwise(F.create_map(F.lit("k"), F.lit("1"))).alias("properties"))
    goods = spark.createDataFrame([("1", 9.0), ("2", 8.0)], "product_id string, price double")
    joined = enrich.join_products(events, goods)
    text = final_plan(joined)
    assert "SortMergeJoin" in text and "skew=true" not in text
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) < 40000 / 3
    assert joined.where("price = 9").count() == 400


def test_tables_are_broadcast_by_their_rows_not_by_their_files(spark, make, tmp_path):
    """A profile table of 14 MB in files of less than the limit of 10 MB does not pass through the driver."""
    path = f"{tmp_path}/profiles"
    spark.range(250_000, numPartitions=1).select(F.md5(F.col("id").cast("string")).alias("user_id")).write.parquet(path)
    files = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path))
    profiles = spark.read.schema("user_id string").parquet(path)
    plan = enrich.join_profiles(make([{"ts": "2024-01-01 00:00:00"}]), profiles)._jdf.queryExecution().sparkPlan().toString()
    small = enrich.join_profiles(make([{"ts": "2024-01-01 00:00:00"}]), profiles.limit(10))
    assert files < 10 << 20 and "BroadcastHashJoin" not in plan and small.count() == 1
