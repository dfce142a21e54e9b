"""Session metrics, alerts and inactivity sessions over tables.

Two events in one slot as long as the gap always belong to one session. Events are therefore
first aggregated per slot (with map-side combining); only these slot rows, at most the covered
time divided by the gap per key, are put in order to join neighbouring slots. One hot session
never meets in one task as single events.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions import business as rules
from clickloom.functions.numeric import money, seconds, slot
from clickloom.operators.ordered import chunk_rows, latest_so_far, number_rows
from clickloom.session import stored

SESSION_KEYS = ["session_id", "user_id"]
GAP = "30 minutes"


def _slots_with_session(slots: DataFrame, keys: list[str], gap: str) -> DataFrame:
    """Slot rows (first_us, last_us, _slot) with the start of the session they belong to."""
    by_slot = Window.partitionBy(*keys).orderBy("_slot")
    marked = slots.withColumns({
        "_last_before": F.max("last_us").over(by_slot.rangeBetween(Window.unboundedPreceding, -1)),
        "_slot_first": F.min("first_us").over(by_slot.rangeBetween(0, 0))})
    opens = (F.col("_last_before").isNull()
             | (F.col("_slot_first") - F.col("_last_before") > seconds(gap) * 1_000_000))
    return (marked.withColumn("_opens_at", F.when(opens, F.col("_slot_first")))
            .withColumn("session_us", F.max("_opens_at").over(
                by_slot.rangeBetween(Window.unboundedPreceding, 0)))
            .drop("_last_before", "_slot_first", "_opens_at"))


def add_flags(sessions: DataFrame) -> DataFrame:
    """Duration, cart flags and conversion from start, end and the two has_ flags."""
    minutes = (F.unix_timestamp("session_end") - F.unix_timestamp("session_start")) / F.lit(60.0)
    return (sessions.withColumn("session_duration_minutes", minutes)
            .withColumn("abandoned_cart", F.col("has_cart_activity") & ~F.col("has_purchase"))
            .withColumn("conversion_rate", F.when(
                F.col("has_cart_activity"),
                F.when(F.col("has_purchase"), F.lit(1.0)).otherwise(F.lit(0.0)))))


def session_metrics(events: DataFrame, gap: str = GAP) -> DataFrame:
    """One row per (session_id, user_id) and run of events without a longer pause than ``gap``.

    The segment and the source are those of the first event; equal times go by text.
    """
    keys = SESSION_KEYS
    us = F.unix_micros("timestamp")
    slots = (events.groupBy(*keys, slot(F.col("timestamp"), gap).alias("_slot"),
                            "event_type", "source", "customer_segment")
             .agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"),
                  F.count("*").alias("n"), F.sum(money(F.col("event_revenue"))).alias("revenue")))
    located = _slots_with_session(slots, keys, gap)
    cart = F.col("event_type").isin("add_to_cart", "remove_from_cart")
    merged = located.groupBy(*keys, "session_us").agg(
        F.max("last_us").alias("last_us"),
        F.sum("n").alias("total_events"),
        F.count_distinct("event_type").alias("unique_event_types"),
        F.sum("revenue").cast("double").alias("session_revenue"),
        F.min(F.struct("first_us", "source", "customer_segment")).alias("first"),
        F.coalesce(F.max(F.col("event_type") == "purchase"), F.lit(False)).alias("has_purchase"),
        F.coalesce(F.max(cart), F.lit(False)).alias("has_cart_activity"))
    start, end = F.timestamp_micros("session_us"), F.timestamp_micros("last_us")
    shaped = merged.select(
        *keys,
        F.struct(start.alias("start"),
                 F.timestamp_micros(F.col("last_us") + seconds(gap) * 1_000_000).alias("end"))
        .alias("session_window"),
        start.alias("session_start"), end.alias("session_end"),
        "total_events", "unique_event_types", "session_revenue",
        F.col("first.customer_segment").alias("customer_segment"),
        F.col("first.source").alias("source"), "has_purchase", "has_cart_activity")
    return add_flags(shaped)


def events_with_session(events: DataFrame, keys: list[str] | None = None, gap: str = GAP) -> DataFrame:
    """Events with the ``session_start`` of their session and their ``position`` in it.

    The rows of the slots are stored before the join: one that holds a large share of the events
    is then split at run time.
    """
    keys = keys or SESSION_KEYS
    us = F.unix_micros("timestamp")
    rows = events.withColumn("_slot", slot(F.col("timestamp"), gap))
    slots = rows.groupBy(*keys, "_slot").agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"))
    located = stored(_slots_with_session(slots, keys, gap).select(
        *[F.col(k).alias(f"_slot_{k}") for k in keys], F.col("_slot").alias("_slot_no"),
        F.timestamp_micros("session_us").alias("session_start")), "slots")
    same = F.col("_slot") == F.col("_slot_no")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_slot_{k}"))
    found = rows.join(located, same).drop("_slot", "_slot_no", *[f"_slot_{k}" for k in keys])
    return number_rows(found, [*keys, "session_start"], name="position")


def session_sequences(events: DataFrame, gap: str = GAP, chunk_size: int = 1000) -> DataFrame:
    """Ordered event types and properties of each session, in chunks; joins to
    ``session_metrics`` on (session_id, user_id, session_start)."""
    located = events_with_session(events, SESSION_KEYS, gap)
    chunks = chunk_rows(located, SESSION_KEYS + ["session_start"], ["event_type", "properties"],
                        "position", chunk_size)
    return (chunks.withColumnRenamed("event_type", "event_sequence")
            .withColumnRenamed("properties", "event_properties"))


def session_alerts(sessions: DataFrame, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    args = (F.col("abandoned_cart"), F.col("session_revenue"), F.col("session_duration_minutes"))
    return sessions.where(rules.needs_alert(*args)).select(
        "session_id", "user_id", "session_start", "session_end", "session_revenue",
        "abandoned_cart", rules.alert_type(*args).alias("alert_type"),
        now.alias("alert_timestamp"))


def inactivity_sessions(events: DataFrame, keys: list[str] | None = None, gap: str = GAP) -> DataFrame:
    """Numbered sessions per user: a pause longer than ``gap`` starts the next one."""
    keys = keys or ["user_id"]
    us = F.unix_micros("timestamp")
    slots = (events.groupBy(*keys, slot(F.col("timestamp"), gap).alias("_slot"))
             .agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.count("*").alias("n")))
    merged = (_slots_with_session(slots, keys, gap).groupBy(*keys, "session_us")
              .agg(F.max("last_us").alias("last_us"), F.sum("n").alias("total_events")))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("session_us"))
    return merged.select(
        *keys, number.alias("session_number"), F.timestamp_micros("session_us").alias("session_start"),
        F.timestamp_micros("last_us").alias("session_end"), "total_events")


def session_age(events: DataFrame, start_type: str = "session_started",
                limit: str = "24 hours") -> DataFrame:
    """Each event with the latest start event of its user and whether that session, counted
    from its start, is older than ``limit``."""
    started = F.when(F.col("event_type") == start_type, F.col("timestamp"))
    aged = latest_so_far(events, ["user_id"], started, name="started_at")
    elapsed = F.unix_micros("timestamp") - F.unix_micros("started_at")
    return aged.withColumn("is_expired", elapsed > seconds(limit) * 1_000_000)
