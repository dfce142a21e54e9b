"""The windowed analytics in the form Spark accepts on a stream.

A stream cannot count distinct values directly. Here each event is split into one tagged row
per counted value; the first aggregation keeps one state row per (group, tag, value), the
second counts those rows. The counts are exact, and the state of a busy group is spread over
its values instead of lying in one set. Both levels share the window, so append mode closes
them with the same watermark.
"""

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import business as rules
from clickloom.functions.numeric import money
from clickloom.operators import sessions as session_rules
from clickloom.operators.windows import (FUNNEL_STAGES, behavior_columns, flat_window, funnel_rates)

# ---- Fixed values: how late events may be ----------------------------------------------------
ENRICH_DELAY = "10 minutes"
SESSION_DELAY = "30 minutes"
DEMO_METRICS_DELAY = "30 seconds"
DEMO_BEHAVIOR_DELAY = "1 minute"
SIMPLE_DELAY = "10 seconds"
# ---------------------------------------------------------------------------------------------


def watermarked(events: DataFrame, delay: str) -> DataFrame:
    return events.withWatermark("timestamp", delay)


def _tagged(events: DataFrame, **counted: str) -> DataFrame:
    """One row per counted value; only the first of an event carries its sums (``_lead``)."""
    entries = [F.struct(F.lit(tag).alias("tag"), F.col(c).cast("string").alias("id"),
                        F.lit(i == 0).alias("lead")) for i, (tag, c) in enumerate(counted.items())]
    exploded = events.withColumn("_t", F.explode(F.array(*entries)))
    return exploded.withColumns({"_tag": F.col("_t.tag"), "_id": F.col("_t.id"),
                                 "_lead": F.col("_t.lead")}).drop("_t")


def _if_lead(value: Column) -> Column:
    return F.when(F.col("_lead"), value)


def _distinct(tag: str) -> Column:
    return F.count(F.when((F.col("_tag") == tag) & F.col("_id").isNotNull(), 1))


def realtime_metrics(enriched: DataFrame, size: str = "1 minute", delay: str = ENRICH_DELAY) -> DataFrame:
    rows = _tagged(watermarked(enriched, delay), user="user_id", session="session_id")
    score = money(F.col("data_quality_score"))
    per_value = (rows.groupBy(F.window("timestamp", size).alias("window"), "event_type", "source",
                              "customer_segment", "_tag", "_id")
                 .agg(F.count(_if_lead(F.lit(1))).alias("n"),
                      F.sum(_if_lead(money(F.col("event_revenue")))).alias("revenue"),
                      F.sum(_if_lead(score)).alias("score"), F.count(_if_lead(score)).alias("scores")))
    return flat_window(
        per_value.groupBy("window", "event_type", "source", "customer_segment")
        .agg(F.sum("n").alias("event_count"), _distinct("user").alias("unique_users"),
             _distinct("session").alias("unique_sessions"),
             F.sum("revenue").cast("double").alias("total_revenue"),
             F.try_divide(F.sum("score").cast("double"), F.sum("scores")).alias("avg_quality_score")))


def session_metrics(events: DataFrame, gap: str = session_rules.GAP, delay: str = SESSION_DELAY) -> DataFrame:
    """Sessions of a stream, emitted once the watermark passes their end.

    The set of types is as small as the vocabulary; ordered event lists come from the lake
    table through ``operators.sessions.session_sequences``.
    """
    cart = F.col("event_type").isin("add_to_cart", "remove_from_cart")
    merged = (watermarked(events, delay)
              .groupBy("session_id", "user_id", F.session_window("timestamp", gap))
              .agg(F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
                   F.count("*").alias("total_events"),
                   F.size(F.collect_set("event_type")).cast("long").alias("unique_event_types"),
                   F.sum(money(F.col("event_revenue"))).cast("double").alias("session_revenue"),
                   F.min(F.struct("timestamp", "source", "customer_segment")).alias("first"),
                   F.coalesce(F.max(F.col("event_type") == "purchase"), F.lit(False)).alias("has_purchase"),
                   F.coalesce(F.max(cart), F.lit(False)).alias("has_cart_activity")))
    shaped = merged.select(
        "session_id", "user_id", "session_window", "session_start", "session_end", "total_events",
        "unique_event_types", "session_revenue", F.col("first.customer_segment").alias("customer_segment"),
        F.col("first.source").alias("source"), "has_purchase", "has_cart_activity")
    return session_rules.add_flags(shaped)


def conversion_funnel(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                      delay: str = SESSION_DELAY) -> DataFrame:
    kind = F.col("event_type")
    reached = [F.max(((kind == stage) & F.col("session_id").isNotNull()).cast("int")).alias(name)
               for name, stage in FUNNEL_STAGES.items()]
    per_session = (watermarked(events, delay)
                   .groupBy(F.window("timestamp", size, slide).alias("window"), "source",
                            "customer_segment", "session_id")
                   .agg(*reached, F.sum(F.when(kind == "purchase", money(F.col("event_revenue")))).alias("revenue")))
    counted = per_session.groupBy("window", "source", "customer_segment").agg(
        *[F.sum(n).alias(n) for n in FUNNEL_STAGES], F.sum("revenue").cast("double").alias("total_revenue"))
    return funnel_rates(flat_window(counted))


def user_behavior(events: DataFrame, size: str = "1 hour", slide: str = "10 minutes",
                  delay: str = SESSION_DELAY) -> DataFrame:
    """One state row for each user and window. Its sets hold the sessions and types that a user has in one window."""
    wide = watermarked(events, delay).groupBy("user_id", F.window("timestamp", size, slide).alias("window")).agg(
        F.count("*").alias("events_count"), F.size(F.collect_set("session_id")).cast("long").alias("session_count"),
        F.size(F.collect_set("event_type")).cast("long").alias("unique_event_types"),
        F.sum(money(F.col("event_revenue"))).cast("double").alias("hourly_revenue"),
        F.min(F.struct("timestamp", "customer_segment"))["customer_segment"].alias("customer_segment"))
    return behavior_columns(flat_window(wide))


def demo_event_metrics(events: DataFrame, size: str = "30 seconds", slide: str = "10 seconds",
                       delay: str = DEMO_METRICS_DELAY, exact: bool = True) -> DataFrame:
    """``exact`` needs append mode; without it users are sketched and every mode works."""
    rows = watermarked(events, delay)
    window = F.window("timestamp", size, slide).alias("window")
    if not exact:
        wide = rows.groupBy(window, "event_type", "source").agg(
            F.count("*").alias("event_count"), F.sum("event_value").alias("total_value"),
            F.approx_count_distinct("user_id").alias("unique_users"), F.sum(money(F.col("price"))).alias("_price"),
            F.count("price").alias("_prices"))
    else:
        per_user = rows.groupBy(window, "event_type", "source", "user_id").agg(
            F.count("*").alias("n"), F.sum("event_value").alias("v"), F.sum(money(F.col("price"))).alias("p"),
            F.count("price").alias("ps"))
        wide = per_user.groupBy("window", "event_type", "source").agg(
            F.sum("n").alias("event_count"), F.sum("v").alias("total_value"),
            F.count("user_id").alias("unique_users"), F.sum("p").alias("_price"), F.sum("ps").alias("_prices"))
    rounded = F.round(F.try_divide(F.col("_price"), F.col("_prices")), 2).cast("double")
    return flat_window(wide.withColumn("avg_price", rounded).drop("_price", "_prices"))


def demo_user_behavior(events: DataFrame, size: str = "1 minute", more_than: int = 2,
                       delay: str = DEMO_BEHAVIOR_DELAY) -> DataFrame:
    kept = (watermarked(events, delay).groupBy(F.window("timestamp", size).alias("window"), "user_id")
            .agg(F.count("*").alias("events_per_minute"),
                 F.size(F.collect_set("event_type")).cast("long").alias("unique_event_types"),
                 F.sum("event_value").alias("user_score"), F.max("price").alias("max_purchase"),
                 F.min(F.struct("timestamp", "country"))["country"].alias("country"))
            .where(F.col("events_per_minute") > more_than))
    return flat_window(kept).drop("window_end")


def simple_summary(events: DataFrame, value: str = "value_usd", size: str = "20 seconds",
                   slide: str = "5 seconds", delay: str = SIMPLE_DELAY, exact: bool = True) -> DataFrame:
    rows = watermarked(events, delay)
    window = F.window("timestamp", size, slide).alias("window")
    if not exact:
        return flat_window(rows.groupBy(window, "event_type").agg(
            F.count("*").alias("count"), F.sum(money(F.col(value))).cast("double").alias("total_value"),
            F.approx_count_distinct("user_id").alias("unique_users")))
    per_user = rows.groupBy(window, "event_type", "user_id").agg(
        F.count("*").alias("n"), F.sum(money(F.col(value))).alias("v"))
    return flat_window(per_user.groupBy("window", "event_type").agg(
        F.sum("n").alias("count"), F.sum("v").cast("double").alias("total_value"),
        F.count("user_id").alias("unique_users")))


def deduplicated(events: DataFrame, delay: str = ENRICH_DELAY, keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """The first of several copies of an event that arrive within the watermark of each other."""
    return watermarked(events, delay).dropDuplicatesWithinWatermark(list(keys))
