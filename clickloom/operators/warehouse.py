"""Warehouse steps: upsert, summaries, compaction, change application, retention."""

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.numeric import money, ratio

# ---- Fixed values ---------------------------------------------------------------------------
UPDATED_COLUMNS = ["event_type", "properties", "customer_segment", "event_revenue"]
# zone -> (age in days -> tier, age at which a partition is dropped)
TIERS = {
    "raw": ([(30, "STANDARD_IA"), (90, "GLACIER"), (365, "DEEP_ARCHIVE")], 2555),
    "processed": ([(90, "STANDARD_IA"), (365, "GLACIER")], 2555),
    "logs": ([(7, "STANDARD_IA"), (30, "GLACIER")], 90),
}
# topic -> days kept
TOPIC_DAYS = {
    "ecommerce-events-raw": 7,
    "ecommerce-events-enriched": 30,
    "ecommerce-events-dlq": 90,
    "user-sessions": 30,
    "realtime-metrics": 3,
    "system-alerts": 30,
    "data-quality-issues": 90,
    "config-changes": 365,
}
# ---------------------------------------------------------------------------------------------


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. Copies of a key are reduced before they are shuffled."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def upsert(target: DataFrame, staging: DataFrame, as_of: Column | None = None,
           order: tuple[str, ...] = ("timestamp",), key: str = "event_id",
           updated: list[str] | None = None) -> DataFrame:
    """The target after updating matched rows and adding new ones.

    Staging is first reduced to the last row per key, so a key sent twice is added once. Rows
    without a key are added as they are, whatever keys the target holds.
    """
    updated = updated or UPDATED_COLUMNS
    now = F.current_timestamp() if as_of is None else as_of
    columns = target.columns
    keyed = latest_per_key(staging.where(F.col(key).isNotNull()), [key], list(order))
    changes = keyed.select(F.col(key), F.lit(True).alias("_hit"),
                           *[F.col(c).alias(f"_new_{c}") for c in updated])
    joined = target.join(changes, key, "left")
    kept = joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in updated
        else F.when(F.col("_hit"), now).otherwise(F.col(c)).alias(c) if c == "updated_at"
        else F.col(c) for c in columns])
    # distinct merges copies of a key on the map side, so a key sent often is shuffled once
    added = keyed.join(target.select(key).distinct(), key, "left_anti").unionByName(
        staging.where(F.col(key).isNull()))
    return kept.unionByName(added.select(*[c for c in columns if c in staging.columns]),
                            allowMissingColumns=True)


def by_partition(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Rows of a table partition brought together before a write, so that it gets few files
    instead of one per task; a partition above the advised size is split again at run time."""
    return df.hint("rebalance", *[F.col(p) for p in partitions])


def write_days(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace the partitions present in ``df``: a repeated run leaves the same table."""
    (by_partition(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def daily_summary(events: DataFrame, sessions: DataFrame, date: str = "event_date") -> DataFrame:
    """Per day: events, users, revenue, purchases per cart addition, mean session duration.

    A session id may have several sessions; they are summed to one row per id first, so the
    join multiplies no event. The mean duration is weighted by events.
    """
    minutes = sessions.groupBy("session_id").agg(
        F.sum(money(F.col("session_duration_minutes"))).alias("_minutes"))
    per_session = (events.groupBy(date, "session_id", "user_id")
                   .agg(F.count("*").alias("_n"), F.sum(money(F.col("event_revenue"))).alias("_revenue"),
                        F.count_if(F.col("event_type") == "purchase").alias("_purchases"),
                        F.count_if(F.col("event_type") == "add_to_cart").alias("_carts")))
    joined = per_session.join(minutes, "session_id", "left")
    weighted = F.col("_minutes") * F.col("_n")
    return joined.groupBy(F.col(date).alias("report_date")).agg(
        F.sum("_n").alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("_revenue").cast("double").alias("total_revenue"),
        ratio(F.sum("_purchases"), F.sum("_carts")).alias("conversion_rate"),
        ratio(F.sum(weighted), F.sum(F.when(F.col("_minutes").isNotNull(), F.col("_n"))))
        .alias("avg_session_duration"))


def daily_metrics(enriched: DataFrame) -> DataFrame:
    """Events, users, sessions and revenue per day, type, source and segment."""
    return (enriched.groupBy(F.to_date("timestamp").alias("metric_date"), "event_type", "source",
                             "customer_segment")
            .agg(F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users"),
                 F.count_distinct("session_id").alias("unique_sessions"),
                 F.sum(money(F.col("event_revenue"))).cast("double").alias("total_revenue")))


def user_segments(profiles: DataFrame, segment: Column) -> DataFrame:
    return profiles.groupBy(segment.alias("customer_value_segment")).agg(
        F.count("*").alias("users"),
        # a total in thousands has five decimals: four would round half of the values
        F.sum(F.col("total_spent").cast("decimal(20,6)")).cast("double").alias("total_spent"))


def apply_changes(target: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The target after op-coded change rows: ``d`` deletes, ``c`` and ``u`` replace."""
    last = latest_per_key(changes, [key], order)
    untouched = target.join(last.select(key), key, "left_anti")
    return untouched.unionByName(last.where(F.col("op") != "d").select(*target.columns))


def tier(zone: str, age_days: Column) -> Column:
    steps, dropped_at = TIERS[zone]
    chain = F.when(age_days >= dropped_at, "EXPIRED")
    for days, name in sorted(steps, reverse=True):
        chain = chain.when(age_days >= days, name)
    return chain.otherwise("STANDARD")


def partition_tiers(df: DataFrame, date: str, zone: str, as_of: Column) -> DataFrame:
    """Rows, age and storage tier of every date partition."""
    days = df.groupBy(F.col(date).alias("partition_date")).agg(F.count("*").alias("rows"))
    age = F.date_diff(as_of, "partition_date")
    return days.withColumns({"age_days": age, "tier": tier(zone, age)})


def within_retention(df: DataFrame, date: str, days: int, as_of: Column) -> DataFrame:
    return df.where(F.col(date) > F.date_sub(as_of, days))
