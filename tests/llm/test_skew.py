"""Joins whose hot key is split at run time."""

import pytest
from pyspark.sql import functions as F

from clickloom.llm import near_dedup, warc_zip
from clickloom.llm.common import written

LIMITS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
          "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
          "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
          "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
          "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def small_limits(spark):
    before = {n: spark.conf.get(n, None) for n in LIMITS}
    for n, v in LIMITS.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_of_one_payload(spark, small_limits):
    n = F.col("id")
    pages = spark.range(0, 40000, numPartitions=8).select(
        n.alias("page_id"), F.sha2((-n).cast("string"), 512).alias("url"), F.when(n % 3 == 0, "same").otherwise(F.sha2(n.cast("string"), 256)).alias("html"))
    found = warc_zip.typed(pages)
    assert "skew=true" in final_plan(found)
    assert found.where("record_type = 'revisit'").count() == 13333


def test_a_key_of_many_contents(spark, small_limits):
    n = F.col("id")
    shared = written(spark.range(0, 40000, numPartitions=8).select(
        F.sha2(n.cast("string"), 256).cast("binary").alias("content"), F.when(n % 3 == 0, -1).otherwise(n % 9000).alias("key")), "shared")
    none = spark.createDataFrame([], "u binary, v binary")
    keep, plans = near_dedup.written, []

    def noted(df, name):
        if name == "open":
            plans.append(final_plan(df))
        return keep(df, name)
    near_dedup.written = noted
    try:
        assert near_dedup.rooted(shared, none).count() == 40000 - shared.groupBy("key").count().where("count = 1").count()
    finally:
        near_dedup.written = keep
    assert "skew=true" in plans[0]
