"""Business figures over event tables: totals, rates, rankings, mixes and latency."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.numeric import money, money_sum, percent, ratio, seconds, slot_start

_purchase = lambda: F.col("event_type") == "purchase"


def revenue_by_type(events: DataFrame, value: str = "value") -> DataFrame:
    return (events.groupBy("event_type")
            .agg(F.count("*").alias("event_count"), money_sum(F.col(value)).alias("total_value"),
                 F.count_distinct("user_id").alias("unique_users"))
            .orderBy(F.desc("total_value"), "event_type"))


def user_activity(events: DataFrame, value: str = "value") -> DataFrame:
    """Per user: events, value and the set of types, which is no larger than the vocabulary."""
    per_type = (events.groupBy("user_id", "event_type")
                .agg(F.count("*").alias("n"), F.sum(money(F.col(value))).alias("v")))
    return (per_type.groupBy("user_id")
            .agg(F.sum("n").alias("total_events"), F.sum("v").cast("double").alias("total_value"),
                 F.array_sort(F.collect_set("event_type")).alias("event_types"))
            .orderBy(F.desc("total_value"), "user_id"))


def group_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().orderBy(*keys)


def kpi_totals(enriched: DataFrame) -> DataFrame:
    """Revenue, orders, sessions, orders per session in percent, revenue per order."""
    totals = enriched.agg(
        F.sum(F.when(_purchase(), money(F.col("event_revenue")))).cast("double").alias("total_revenue"),
        F.count_if(_purchase()).alias("total_orders"),
        F.count_distinct("session_id").alias("total_sessions"))
    return totals.withColumns({
        "conversion_rate_percent": percent(F.col("total_orders"), F.col("total_sessions")),
        "average_order_value": ratio(F.col("total_revenue"), F.col("total_orders"))})


def revenue_per_slot(enriched: DataFrame, every: str = "1 hour") -> DataFrame:
    return (enriched.where(_purchase())
            .groupBy(slot_start(F.col("timestamp"), every).alias("slot_start"))
            .agg(money_sum(F.col("event_revenue")).alias("revenue"), F.count("*").alias("orders")))


def active_per_slot(events: DataFrame, every: str = "1 hour") -> DataFrame:
    return (events.groupBy(slot_start(F.col("timestamp"), every).alias("slot_start"))
            .agg(F.count_distinct("user_id").alias("active_users"),
                 F.count_distinct("session_id").alias("active_sessions")))


def top(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """The ``k`` largest rows; equal values go by key. Each task keeps only its own ``k``."""
    return df.orderBy(F.desc(by), key).limit(k)


def top_per_slot(df: DataFrame, slot: str, by: str, key: str, k: int) -> DataFrame:
    """The ``k`` largest aggregated rows of every slot."""
    order = Window.partitionBy(slot).orderBy(F.desc(by), key)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_categories(enriched: DataFrame, k: int = 5) -> DataFrame:
    views = (enriched.where((F.col("event_type") == "product_view") & F.col("category").isNotNull())
             .groupBy("category").agg(F.count("*").alias("views")))
    return top(views, "views", "category", k)


def top_products(items: DataFrame, k: int = 10) -> DataFrame:
    sold = items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        F.sum(money(F.col("price") * F.col("quantity"))).cast("double").alias("revenue"))
    return top(sold, "units", "product_id", k)


def sessions_by_source(events: DataFrame) -> DataFrame:
    return events.groupBy("source").agg(F.count_distinct("session_id").alias("sessions"))


def cart_abandonment(sessions: DataFrame) -> DataFrame:
    """Sessions with cart activity and no purchase, in percent of those with cart activity."""
    counts = sessions.agg(F.count_if("has_cart_activity").alias("cart_sessions"),
                          F.count_if("abandoned_cart").alias("abandoned_sessions"))
    return counts.withColumn("abandonment_percent",
                             percent(F.col("abandoned_sessions"), F.col("cart_sessions")))


def event_rate(events: DataFrame, every: str = "5 minutes") -> DataFrame:
    """Events per second and per minute in each slot."""
    width = seconds(every)
    return (events.groupBy(slot_start(F.col("timestamp"), every).alias("slot_start"))
            .agg(F.count("*").alias("events"))
            .withColumns({"events_per_second": F.col("events") / F.lit(float(width)),
                          "events_per_minute": F.col("events") * 60 / F.lit(float(width))}))


def error_rate(events: DataFrame, every: str = "1 hour", errors: Column | None = None) -> DataFrame:
    errors = F.col("event_type") == "error" if errors is None else errors
    return (events.groupBy(slot_start(F.col("timestamp"), every).alias("slot_start"))
            .agg(F.count("*").alias("events"), F.count_if(errors).alias("errors"))
            .withColumn("error_rate", ratio(F.col("errors"), F.col("events"))))


def event_mix(events: DataFrame) -> DataFrame:
    """Count per type and its share; the total runs over the few type rows only."""
    counts = events.groupBy("event_type").agg(F.count("*").alias("events"))
    total = F.sum("events").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share_percent", percent(F.col("events"), total))


def label_values(df: DataFrame, label: Column, name: str = "label_value") -> DataFrame:
    return df.select(label.alias(name)).where(F.col(name).isNotNull()).distinct()
