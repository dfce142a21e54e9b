"""Validation, enrichment joins, derived columns and quality scoring."""

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import business as rules

REQUIRED = ("event_id", "user_id", "event_type", "timestamp")
# Keys of rows without a product: a prefix no product id has, and how many there are.
NO_PRODUCT, NULL_SPREAD = "\u0000none-", 4096


def require_fields(events: DataFrame, fields: tuple[str, ...] = REQUIRED) -> DataFrame:
    return events.dropna(subset=list(fields))


def join_profiles(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join on the user. Spark broadcasts profiles below its size limit, else it shuffles
    both sides and splits a user that fills more than its share of a partition."""
    return events.join(profiles, "user_id", "left")


def join_products(events: DataFrame, products: DataFrame) -> DataFrame:
    """Left join on the product named in the properties.

    Most events name none. Their key is replaced by one of ``NULL_SPREAD`` keys that no product
    has, so they do not all meet in the partition that null hashes to.
    """
    named = F.col("properties")["product_id"]
    none = F.concat(F.lit(NO_PRODUCT), F.pmod(F.xxhash64("event_id"), F.lit(NULL_SPREAD)).cast("string"))
    left = events.withColumn("_product", F.coalesce(named, none))
    return left.join(products, left["_product"] == products["product_id"], "left").drop("_product")


def join_updates(events: DataFrame, updates: DataFrame, key: str, updated: str,
                 within: str = "1 hour", event_delay: str = "10 minutes",
                 update_delay: str = "1 hour") -> DataFrame:
    """Stream-stream left join with a changing dimension: an update counts for events up to
    ``within`` after it. Both sides carry a watermark, so state is bounded and rows without a
    match are emitted once no match can come."""
    left = events.withWatermark("timestamp", event_delay)
    right = (updates.withColumnRenamed(key, "_key").withWatermark(updated, update_delay))
    condition = ((left[key] == right["_key"])
                 & (right[updated] <= left["timestamp"])
                 & (right[updated] >= left["timestamp"] - F.expr(f"interval {within}")))
    return left.join(right, condition, "left").drop("_key")


def derive(events: DataFrame, as_of: Column | None = None, literal_nulls: bool = False) -> DataFrame:
    """Calendar columns, revenue and value segment. ``as_of`` is the processing time."""
    now = F.current_timestamp() if as_of is None else as_of
    weekday = F.dayofweek("timestamp")
    return events.withColumns({
        "enriched_timestamp": now,
        "processing_date": F.to_date(now),
        "hour_of_day": F.hour("timestamp"),
        "day_of_week": weekday,
        "is_weekend": weekday.isin(1, 7),
        "event_revenue": rules.event_revenue(
            F.col("event_type"), F.col("properties"), F.col("price"), literal_nulls),
        "customer_value_segment": rules.customer_value_segment(
            F.col("total_spent"), F.col("total_orders"), literal_nulls),
    })


def score(events: DataFrame) -> DataFrame:
    scored = events.withColumn("data_quality_score", rules.quality_score(
        F.col("event_id"), F.col("user_id"), F.col("properties"), F.col("metadata")))
    return scored.withColumn("is_valid_event", F.col("data_quality_score") > rules.QUALITY_THRESHOLD)


def valid_events(scored: DataFrame) -> DataFrame:
    return scored.where("is_valid_event")


def quality_issues(scored: DataFrame, as_of: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return scored.where("NOT is_valid_event").select(
        "event_id", "user_id", "event_type", "timestamp", "data_quality_score",
        F.lit(rules.LOW_QUALITY).alias("issue_type"), now.alias("detected_at"))


def enrich(events: DataFrame, profiles: DataFrame, products: DataFrame,
           as_of: Column | None = None, literal_nulls: bool = False) -> DataFrame:
    """Validate, join both dimensions, derive and score; events may be a stream."""
    joined = join_products(join_profiles(require_fields(events), profiles), products)
    return score(derive(joined, as_of, literal_nulls))


def with_segment_and_revenue(events: DataFrame, profiles: DataFrame, products: DataFrame) -> DataFrame:
    """Events with what the analytics read of the enrichment: segment, revenue and score."""
    joined = join_products(join_profiles(require_fields(events), profiles), products)
    revenue = rules.event_revenue(F.col("event_type"), F.col("properties"), F.col("price"))
    return score(joined.withColumn("event_revenue", revenue))


def with_purchase_revenue(events: DataFrame) -> DataFrame:
    """Events with the revenue of purchases, which needs no dimension."""
    return events.withColumn("event_revenue", rules.event_revenue(
        F.col("event_type"), F.col("properties"), F.lit(None).cast("double")))
