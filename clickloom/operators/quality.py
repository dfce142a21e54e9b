"""Checks on data: freshness, table checks, expectations, quarantine, lag and health."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from clickloom import schemas
from clickloom.functions.numeric import money, ratio, seconds
from clickloom.sources.readers import parsed_once

# ---- Fixed values ---------------------------------------------------------------------------
FRESH_WITHIN = "1 hour"
BASE_SECONDS, SECONDS_PER_BLOCK, BLOCK_EVENTS, TIMEOUT_MARGIN = 300, 60, 10_000, 300
MIN_DISTINCT_USERS = 10
MAX_LAG, WARN_LAG = 10_000, 1_000
MAX_RETRIES = 3
EVENT_TYPES = ["page_view", "product_view", "add_to_cart", "remove_from_cart", "purchase",
               "search", "user_login", "form_submit", "link_click", "checkout_started"]
# ---------------------------------------------------------------------------------------------


def freshness(events: DataFrame, as_of: Column, within: str = FRESH_WITHIN) -> DataFrame:
    since = as_of - F.make_dt_interval(secs=F.lit(seconds(within)))
    seen = events.where((F.col("timestamp") >= since) & (F.col("timestamp") <= as_of)).agg(
        F.count("*").alias("event_count"), F.max("timestamp").alias("latest_event"))
    return seen.withColumn("passed", F.col("event_count") > 0)


def expected_duration(fresh: DataFrame) -> DataFrame:
    """Budget of a run: a base, and a minute per full 10 000 events."""
    n = F.col("event_count")
    blocks = ((n - F.pmod(n, F.lit(BLOCK_EVENTS))) / BLOCK_EVENTS).cast("long")
    expected = blocks * SECONDS_PER_BLOCK + BASE_SECONDS
    return fresh.select("event_count", expected.alias("expected_duration"),
                        (expected + TIMEOUT_MARGIN).alias("timeout_seconds"))


def _as_rows(one_row: DataFrame, checks: list[tuple[str, Column, Column]], name: str) -> DataFrame:
    cells = [F.struct(F.lit(n).alias(name), v.cast("long").alias("value"), p.alias("passed"))
             for n, v, p in checks]
    return one_row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def table_checks(df: DataFrame, day: Column, date: str = "processing_date") -> DataFrame:
    """Rows of the day, null ids of the table, distinct users of the day, in one pass."""
    today = F.col(date) == day
    counted = df.agg(F.count_if(today).alias("rows"),
                     F.count_if(F.col("event_id").isNull()).alias("null_ids"),
                     F.count_distinct(F.when(today, F.col("user_id"))).alias("users"))
    return _as_rows(counted, [
        ("events_loaded_for_day", F.col("rows"), F.col("rows") > 0),
        ("no_null_event_ids", F.col("null_ids"), F.col("null_ids") == 0),
        ("multiple_unique_users", F.col("users"), F.col("users") > MIN_DISTINCT_USERS)], "check")


@dataclass(frozen=True)
class Rule:
    """A named expectation; ``holds`` is the condition each row should meet."""
    name: str
    holds: Column | None = None
    unique: tuple[str, ...] = ()
    min_rows: int | None = None
    columns: tuple[tuple[str, str], ...] = ()


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", F.col(column).isNotNull())


def in_set(column: str, values: list) -> Rule:
    return Rule(f"{column}_in_set", F.col(column).isNull() | F.col(column).isin(*values))


def between(column: str, low, high) -> Rule:
    return Rule(f"{column}_between", F.col(column).isNull() | F.col(column).between(low, high))


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"{column}_matches", F.col(column).isNull() | F.col(column).rlike(pattern))


def fits_money(column: str) -> Rule:
    """Values that sums of money can hold; the others are left out of such sums."""
    return Rule(f"{column}_fits_money", F.col(column).isNull() | money(F.col(column)).isNotNull())


def unique(*columns: str) -> Rule:
    return Rule("_".join(columns) + "_unique", unique=columns)


def row_count(at_least: int) -> Rule:
    return Rule("row_count", min_rows=at_least)


def has_columns(**types: str) -> Rule:
    """The table has these columns, with these types; judged by its schema alone."""
    return Rule("has_columns", columns=tuple(types.items()))


def expect(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules in one aggregation: (rule, value, passed), value counting what breaks a rule
    (for ``row_count``: the rows; for ``has_columns``: columns that are missing or of another type)."""
    aggs, checks, found = [F.count("*").alias("_rows")], [], dict(df.dtypes)
    for i, rule in enumerate(rules):
        c = F.col(f"_r{i}")
        if rule.columns:
            wrong = sum(found.get(name) != kind for name, kind in rule.columns)
            checks.append((rule.name, F.lit(wrong), F.lit(wrong == 0)))
            continue
        if rule.min_rows is not None:
            aggs.append(F.count("*").alias(f"_r{i}"))
            checks.append((rule.name, c, c >= rule.min_rows))
            continue
        if rule.unique:
            every = F.lit(True)
            for name in rule.unique:
                every = every & F.col(name).isNotNull()
            aggs.append((F.count_if(every) - F.count_distinct(*[F.col(n) for n in rule.unique])).alias(f"_r{i}"))
        else:
            aggs.append(F.count_if(~F.coalesce(rule.holds, F.lit(False))).alias(f"_r{i}"))
        checks.append((rule.name, c, c == 0))
    return _as_rows(df.agg(*aggs), checks, "rule")


# The four suites by name; a suite is written against the columns its table always has.
SUITES: dict[str, Callable[[], list[Rule]]] = {
    "raw_events": lambda: [
        has_columns(event_id="string", event_type="string", timestamp="timestamp", user_id="string",
                    properties="map<string,string>", metadata="map<string,string>"),
        row_count(1), not_null("event_id"), not_null("user_id"), not_null("event_type"), not_null("timestamp"),
        in_set("event_type", EVENT_TYPES), unique("event_id")],
    "enriched_events": lambda: [
        row_count(1), not_null("event_id"), not_null("customer_segment"), not_null("customer_value_segment"),
        between("data_quality_score", 0.0, 1.0), between("hour_of_day", 0, 23), fits_money("event_revenue"),
        Rule("revenue_not_negative", F.col("event_revenue") >= 0)],
    "business_metrics": lambda: [
        row_count(1), unique("report_date"), not_null("total_revenue"),
        Rule("users_within_events", F.col("unique_users") <= F.col("total_events")),
        Rule("conversion_not_negative", F.col("conversion_rate").isNull() | (F.col("conversion_rate") >= 0))],
    "data_warehouse": lambda: [
        row_count(1), not_null("event_id"), unique("event_id"), fits_money("event_revenue"),
        Rule("day_is_that_of_the_event", F.col("event_date") == F.to_date("timestamp"))],
}


def run_suite(df: DataFrame, name: str) -> DataFrame:
    """The rules of a named suite on a table: (suite, rule, value, passed)."""
    return expect(df, SUITES[name]()).select(F.lit(name).alias("suite"), "rule", "value", "passed")


def item_rules() -> list[Rule]:
    """What a client guarantees of line items."""
    return [Rule("quantity_at_least_1", F.col("quantity") >= 1), Rule("price_above_0", F.col("price") > 0)]


def order_rules(total: str = "total_amount", discount: str = "discount_amount",
                items_total: str = "items_total") -> list[Rule]:
    """What a client guarantees of a purchase."""
    return [
        Rule("discount_within_a_fifth", F.col(discount).between(F.lit(0), F.col(total) * 0.2)),
        Rule("total_is_sum_of_items", F.abs(money(F.col(total)) - money(F.col(items_total))) < 0.01),
    ]


def parsed_messages(messages: DataFrame) -> DataFrame:
    """Messages with ``_e``, the parsed record and, as ``_bad``, what could not be read of it."""
    schema = T.StructType(schemas.RAW_EVENT.fields + [T.StructField("_bad", T.StringType())])
    return messages.withColumn("_e", F.explode(parsed_once(F.col("value"), schema, {"columnNameOfCorruptRecord": "_bad"})))


def events_of(parsed: DataFrame) -> DataFrame:
    """The events of ``parsed_messages``, as ``parse_events`` gives them."""
    return parsed.select(*[F.col(f"_e.{f.name}") for f in schemas.RAW_EVENT.fields],
                         F.col("timestamp").alias("kafka_timestamp"), "offset", "partition")


def quarantine(messages: DataFrame, as_of: Column | None = None,
               processor: str = "event_parser") -> DataFrame:
    """Messages that do not become a usable event, as dead-letter rows."""
    return dead_letters(parsed_messages(messages), as_of, processor)


def dead_letters(parsed: DataFrame, as_of: Column | None = None, processor: str = "event_parser") -> DataFrame:
    """The same from parsed messages."""
    now = F.current_timestamp() if as_of is None else as_of
    required = ["event_id", "user_id", "event_type", "timestamp"]
    absent = F.concat_ws(",", *[F.when(F.col(f"_e.{c}").isNull(), F.lit(c)) for c in required])
    unreadable = F.col("value").isNull() | F.col("_e").isNull() | F.col("_e._bad").isNotNull()
    # A record with one unreadable field still has the others; it is bad if a needed one is gone.
    kind = (F.when(absent == "", None)
            .when(unreadable, F.lit("UNPARSEABLE")).otherwise(F.lit("MISSING_FIELD")))
    return (parsed.withColumns({"_kind": kind, "_absent": absent}).where(F.col("_kind").isNotNull())
            .select(F.col("topic").alias("original_topic"),
                    F.col("partition").alias("original_partition"),
                    F.col("offset").alias("original_offset"),
                    F.col("timestamp").alias("original_timestamp"),
                    F.col("key").cast("string").alias("original_key"),
                    F.col("value").cast("string").alias("original_value"),
                    F.create_map().cast("map<string,string>").alias("original_headers"),
                    F.concat(F.lit("missing: "), F.col("_absent")).alias("error_message"),
                    F.col("_kind").alias("error_type"),
                    F.lit(processor).alias("processor_name"),
                    now.alias("failure_timestamp"),
                    F.lit(MAX_RETRIES).alias("retry_count")))


def lag_check(high_marks: DataFrame, positions: DataFrame, max_lag: int = MAX_LAG,
              warn_lag: int = WARN_LAG) -> DataFrame:
    """Lag per topic partition from (topic, partition, high_mark) and (…, position)."""
    both = high_marks.join(positions, ["topic", "partition"], "left")
    lag = F.col("high_mark") - F.coalesce("position", F.lit(0))
    return both.select(
        "topic", "partition", "high_mark", F.coalesce("position", F.lit(0)).alias("position"),
        lag.alias("lag"),
        F.when(lag > max_lag, "fail").when(lag > warn_lag, "warn").otherwise("ok").alias("status"))


def _health_status(score: Column) -> Column:
    return F.when(score > 75, "healthy").when(score > 25, "degraded").otherwise("unhealthy")


def consumer_health(stats: DataFrame) -> DataFrame:
    """Score from (is_running, current_lag, processed, failed)."""
    lag = F.col("current_lag")
    by_lag = (F.when(~F.col("is_running"), 0).when(lag > 10_000, 25).when(lag > 5_000, 50).otherwise(100))
    errors = ratio(F.col("failed"), F.col("processed") + F.col("failed"))
    limit = F.when(errors > 0.1, 25).when(errors > 0.05, 75).otherwise(100)
    score = F.least(by_lag, limit)
    return stats.withColumns({"health_score": score, "status": _health_status(score)})


def producer_health(stats: DataFrame) -> DataFrame:
    """Score from (circuit_state, queue_size)."""
    state = F.col("circuit_state")
    score = (F.when(state == "OPEN", 0).when(state == "HALF_OPEN", 50)
             .when(F.col("queue_size") > 1000, 25).otherwise(100))
    return stats.withColumns({"health_score": score, "status": _health_status(score)})


def consumer_stats(log: DataFrame) -> DataFrame:
    """Messages, bytes and mean time per topic and status from (topic, status, bytes, ms)."""
    return log.groupBy("topic", "status").agg(
        F.count("*").alias("messages"), F.sum("bytes").alias("total_bytes"),
        ratio(F.sum("ms"), F.count("ms")).alias("mean_ms"))
