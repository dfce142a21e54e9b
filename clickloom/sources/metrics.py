"""Metric samples recorded from events and sessions: counters that restart weekly, and hourly gauges."""

from pyspark.sql import DataFrame, Window, functions as F

from clickloom.functions.numeric import slot, slot_start


def event_counters(events: DataFrame, every: str = "1 hour", restart: str = "7 days") -> DataFrame:
    """``events_total{event_type,source}`` sampled at the end of each slot that had events."""
    counts = (events.groupBy("event_type", "source", slot_start(F.col("timestamp"), every).alias("ts"))
              .agg(F.count("*").alias("n"))
              .withColumn("life", slot(F.col("ts"), restart)))
    so_far = (Window.partitionBy("event_type", "source", "life").orderBy("ts")
              .rowsBetween(Window.unboundedPreceding, 0))
    return counts.select(
        "ts", F.lit("events_total").alias("metric"),
        F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("source"), F.col("source")).alias("labels"),
        F.sum("n").over(so_far).cast("double").alias("value"))


def lag_gauges(events: DataFrame, every: str = "1 hour") -> DataFrame:
    """``processing_delay_ms{partition}``: the longest delay of each slot and partition."""
    delay = F.unix_millis("kafka_timestamp") - F.unix_millis("timestamp")
    return (events.groupBy("partition", slot_start(F.col("timestamp"), every).alias("ts"))
            .agg(F.max(delay).cast("double").alias("value"))
            .select("ts", F.lit("processing_delay_ms").alias("metric"),
                    F.create_map(F.lit("partition"), F.col("partition").cast("string")).alias("labels"),
                    "value"))


def abandonment_counter(sessions: DataFrame, every: str = "1 hour", restart: str = "7 days") -> DataFrame:
    """``cart_abandonment_total``: abandoned carts by the end of each slot in which a session ended with one."""
    counts = (sessions.where("abandoned_cart").groupBy(slot_start(F.col("session_end"), every).alias("ts"))
              .agg(F.count("*").alias("n")).withColumn("life", slot(F.col("ts"), restart)))
    so_far = Window.partitionBy("life").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return counts.select("ts", F.lit("cart_abandonment_total").alias("metric"),
                         F.create_map().cast("map<string,string>").alias("labels"),
                         F.sum("n").over(so_far).cast("double").alias("value"))
