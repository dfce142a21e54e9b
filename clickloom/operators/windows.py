"""Tumbling and sliding window metrics over tables.

Sliding windows first aggregate per slide. A distinct count over a window of ``k`` slides is a
sum over its slides: the slide at place ``d`` of the window (0 to k-1) adds the values whose
previous slide lies before the window, that is more than ``d`` slides back. These ``k`` counts
per slide are found by looking back once per value, so only slide totals, not events or values,
are copied into the windows that hold them.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions import business as rules
from clickloom.functions.numeric import money, money_sum, ratio, seconds, slot, slot_start
from clickloom.operators.ordered import chunk_rows, number_rows

FUNNEL_STAGES = {
    "sessions_with_pageview": "page_view",
    "sessions_with_product_view": "product_view",
    "sessions_with_add_to_cart": "add_to_cart",
    "sessions_with_purchase": "purchase",
}


def flat_window(df: DataFrame) -> DataFrame:
    """``window`` struct -> window_start and window_end in front."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def stamped(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    return df.withColumn("generated_at", F.current_timestamp() if as_of is None else as_of)


def realtime_metrics(enriched: DataFrame, size: str = "1 minute") -> DataFrame:
    return flat_window(
        enriched.groupBy(F.window("timestamp", size), "event_type", "source", "customer_segment")
        .agg(F.count("*").alias("event_count"),
             F.count_distinct("user_id").alias("unique_users"),
             F.count_distinct("session_id").alias("unique_sessions"),
             money_sum(F.col("event_revenue")).alias("total_revenue"),
             # score has one decimal: a fixed-point mean is the same in any row order
             (money_sum(F.col("data_quality_score")) / F.count("data_quality_score"))
             .alias("avg_quality_score")))


def funnel_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "product_view_rate": ratio(F.col("sessions_with_product_view"), F.col("sessions_with_pageview")),
        "add_to_cart_rate": ratio(F.col("sessions_with_add_to_cart"), F.col("sessions_with_product_view")),
        "conversion_rate": ratio(F.col("sessions_with_purchase"), F.col("sessions_with_add_to_cart")),
        "overall_conversion_rate": ratio(F.col("sessions_with_purchase"), F.col("sessions_with_pageview")),
    })


def _slides(size: str, slide: str) -> int:
    if seconds(size) % seconds(slide):
        raise ValueError(f"{slide} does not divide {size}")
    return seconds(size) // seconds(slide)


def _new_within(name: str, present: str, before: str, k: int) -> list[Column]:
    """``name_d``: rows present in this slide and not in the ``d`` slides before it."""
    return [F.expr(f"count(CASE WHEN {present} AND ({before} IS NULL OR _s - {before} > {d}) THEN 1 END)")
            .alias(f"{name}_{d}") for d in range(k)]


def _over_windows(slides: DataFrame, keys: list[str], size: str, slide: str, distinct: list[str],
                  additive: list[str]) -> DataFrame:
    """Window rows from slide totals: ``distinct`` take the count of their place, ``additive`` add up."""
    k, width = _slides(size, slide), seconds(slide)
    cells = [F.struct((F.col("_s") - d).alias("_w"), *[F.col(f"{n}_{d}").alias(n) for n in distinct], *additive)
             for d in range(k)]
    summed = (slides.select(*keys, F.inline(F.array(*cells))).groupBy("_w", *keys)
              .agg(*[F.sum(n).alias(n) for n in distinct + additive]))
    return summed.select(F.timestamp_seconds(F.col("_w") * width).alias("window_start"),
                         F.timestamp_seconds((F.col("_w") + k) * width).alias("window_end"),
                         *keys, *distinct, *additive)


def conversion_funnel(enriched: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Sessions that reached each stage at least once in the window, in any order."""
    kind, keys, k = F.col("event_type"), ["source", "customer_segment"], _slides(size, slide)
    stages = list(FUNNEL_STAGES)
    # A null session is not counted, its revenue is.
    reached = [F.max(((kind == stage) & F.col("session_id").isNotNull()).cast("int")).alias(name)
               for name, stage in FUNNEL_STAGES.items()]
    per_session = (enriched.groupBy(slot(F.col("timestamp"), slide).alias("_s"), *keys, "session_id")
                   .agg(*reached, F.sum(F.when(kind == "purchase", money(F.col("event_revenue")))).alias("_revenue")))
    earlier = (Window.partitionBy(*keys, "session_id").orderBy("_s")
               .rowsBetween(Window.unboundedPreceding, -1))
    dated = per_session.withColumns({
        f"_last_{n}": F.max(F.when(F.col(n) == 1, F.col("_s"))).over(earlier) for n in stages})
    counts = [c for n in stages for c in _new_within(n, f"{n} = 1", f"_last_{n}", k)]
    slides = dated.groupBy("_s", *keys).agg(*counts, F.sum("_revenue").alias("_revenue"))
    wide = _over_windows(slides, keys, size, slide, stages, ["_revenue"])
    return funnel_rates(wide.withColumn("total_revenue", F.col("_revenue").cast("double")).drop("_revenue"))


def behavior_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "avg_events_per_session": ratio(F.col("events_count"), F.col("session_count")),
        "is_high_activity": F.col("events_count") > rules.HIGH_ACTIVITY_EVENTS,
        "behavior_score": rules.behavior_score(
            F.col("events_count"), F.col("session_count"), F.col("unique_event_types"),
            F.col("hourly_revenue")),
    })


def user_behavior(enriched: DataFrame, size: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Activity of each user per window; the segment is that of the window's first event.

    An event is counted under its session, its type and its segment. The slide totals of a user
    are put in order, and each slide yields the windows in which it is the user's first one, by
    looking ahead to the slides that follow inside the window.
    """
    k, width = _slides(size, slide), seconds(slide)
    cell = lambda tag, c: F.struct(F.lit(tag).alias("tag"), F.col(c).alias("id"))
    rows = enriched.select(
        "user_id", slot(F.col("timestamp"), slide).alias("_s"), "timestamp", money(F.col("event_revenue")).alias("_money"),
        F.inline(F.array(cell("session", "session_id"), cell("type", "event_type"), cell("segment", "customer_segment"))))
    values = rows.groupBy("user_id", "_s", "tag", "id").agg(
        F.count("*").alias("_n"), F.sum("_money").alias("_money"), F.min("timestamp").alias("_first"))
    before = F.lag("_s").over(Window.partitionBy("user_id", "tag", "id").orderBy("_s"))
    dated = values.withColumn("_before", before)
    is_segment = F.col("tag") == "segment"
    counted = lambda tag: f"tag = '{tag}' AND id IS NOT NULL"
    slides = dated.groupBy("user_id", "_s").agg(
        F.sum(F.when(is_segment, F.col("_n"))).alias("n"),
        F.sum(F.when(is_segment, F.col("_money"))).alias("money"),
        F.min(F.when(is_segment, F.struct("_first", "id")))["id"].alias("customer_segment"),
        *_new_within("session", counted("session"), "_before", k),
        *_new_within("type", counted("type"), "_before", k))
    totals = slides.select(
        "user_id", "_s", "customer_segment", F.struct(
            "n", "money", F.array(*[f"session_{d}" for d in range(k)]).alias("session"),
            F.array(*[f"type_{d}" for d in range(k)]).alias("type")).alias("_t"))
    ordered = Window.partitionBy("user_id").orderBy("_s")
    ahead = totals.withColumns({
        "_before": F.lag("_s").over(ordered),
        **{f"_t{o}": F.first("_t").over(ordered.rangeBetween(o, o)) for o in range(k)}})

    def window(place: int) -> str:
        """The window in which this slide has ``place``; its later slides are those up to the end."""
        held = range(k - place)
        total = lambda part: " + ".join(f"coalesce(_t{o}.{part(o)}, 0)" for o in held)
        seen = " OR ".join(f"_t{o}.money IS NOT NULL" for o in held)
        return f"""IF(_before IS NULL OR _s - _before > {place}, named_struct(
            '_w', _s - {place}, 'events_count', {total(lambda o: "n")},
            'session_count', {total(lambda o: f"session[{place + o}]")},
            'unique_event_types', {total(lambda o: f"type[{place + o}]")},
            'hourly_revenue', CASE WHEN {seen} THEN cast({total(lambda o: "money")} AS double) END), NULL)"""

    opened = F.expr(f"array({', '.join(window(d) for d in range(k))})")
    wide = ahead.select("user_id", "customer_segment", F.inline(opened)).where(F.col("_w").isNotNull())
    shaped = wide.select(
        F.timestamp_seconds(F.col("_w") * width).alias("window_start"),
        F.timestamp_seconds((F.col("_w") + k) * width).alias("window_end"),
        "user_id", "events_count", "session_count", "unique_event_types", "hourly_revenue", "customer_segment")
    return behavior_columns(shaped)


def behavior_sequences(events: DataFrame, size: str = "1 hour", slide: str = "10 minutes",
                       chunk_size: int = 1000) -> DataFrame:
    """Ordered event types of each user and window, in chunks; joins to ``user_behavior``.

    An event is numbered once, inside its slide; its place in each window that holds the slide
    adds the counts of the window's earlier slides.
    """
    rows = events.select("user_id", "timestamp", "event_id", "event_type",
                         slot_start(F.col("timestamp"), slide).alias("_slide"))
    counts = rows.groupBy("user_id", "_slide").agg(F.count("*").alias("_n"))
    earlier = (Window.partitionBy("user_id", "_window").orderBy("_slide")
               .rowsBetween(Window.unboundedPreceding, -1))
    spread = counts.withColumn("_window", F.window("_slide", size, slide))
    placed = spread.select(
        F.col("user_id").alias("_user"), F.col("_slide").alias("_at_slide"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"),
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"))
    numbered = number_rows(rows, ["user_id", "_slide"], name="_at")
    joined = numbered.join(placed, numbered["user_id"].eqNullSafe(placed["_user"])
                           & (numbered["_slide"] == placed["_at_slide"]))
    chunks = chunk_rows(joined.withColumn("position", F.col("_at") + F.col("_ahead")),
                        ["user_id", "window_start", "window_end"], ["event_type"], "position", chunk_size)
    return chunks.withColumnRenamed("event_type", "event_sequence")


def with_demo_columns(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "session_id": rules.hour_session_id(F.col("user_id"), F.col("timestamp")),
        "is_mobile": F.col("source") == "mobile",
        "event_value": rules.event_value(F.col("event_type")),
        "customer_segment": rules.price_segment(F.col("price")),
    })


def _per_user_slides(events: DataFrame, keys: list[str], size: str, slide: str, sums: dict[str, Column]) -> DataFrame:
    """Slide totals of ``sums`` and the ``unique_users_d`` counts."""
    per_user = (events.groupBy(slot(F.col("timestamp"), slide).alias("_s"), *keys, "user_id")
                .agg(*[c.alias(n) for n, c in sums.items()]))
    before = F.lag("_s").over(Window.partitionBy(*keys, "user_id").orderBy("_s"))
    return per_user.withColumn("_before", before).groupBy("_s", *keys).agg(
        *[F.sum(n).alias(n) for n in sums],
        *_new_within("unique_users", "user_id IS NOT NULL", "_before", _slides(size, slide)))


def demo_event_metrics(events: DataFrame, size: str = "30 seconds", slide: str = "10 seconds") -> DataFrame:
    sums = {"event_count": F.count("*"), "total_value": F.sum("event_value"),
            "_price": F.sum(money(F.col("price"))), "_prices": F.count("price")}
    keys = ["event_type", "source"]
    wide = _over_windows(_per_user_slides(events, keys, size, slide, sums), keys, size, slide,
                         ["unique_users"], list(sums))
    rounded = F.round(F.try_divide(F.col("_price"), F.col("_prices")), 2).cast("double")
    return wide.withColumn("avg_price", rounded).drop("_price", "_prices")


def demo_user_behavior(events: DataFrame, size: str = "1 minute", more_than: int = 2) -> DataFrame:
    kept = (events.groupBy(F.window("timestamp", size), "user_id")
            .agg(F.count("*").alias("events_per_minute"),
                 F.count_distinct("event_type").alias("unique_event_types"),
                 F.sum("event_value").alias("user_score"), F.max("price").alias("max_purchase"),
                 F.min(F.struct("timestamp", "country"))["country"].alias("country"))
            .where(F.col("events_per_minute") > more_than))
    return flat_window(kept).drop("window_end")


def simple_summary(events: DataFrame, value: str = "value_usd", size: str = "20 seconds",
                   slide: str = "5 seconds") -> DataFrame:
    sums = {"count": F.count("*"), "total_value": F.sum(money(F.col(value)))}
    wide = _over_windows(_per_user_slides(events, ["event_type"], size, slide, sums), ["event_type"], size, slide,
                         ["unique_users"], list(sums))
    return wide.withColumn("total_value", F.col("total_value").cast("double"))
