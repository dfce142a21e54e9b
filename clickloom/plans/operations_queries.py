"""Queries on data quality, the warehouse and whose data may be used."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from clickloom.functions import business as rules
from clickloom.functions.numeric import money, money_sum, slot_start
from clickloom.operators import enrich, privacy, quality, sessions, warehouse
from clickloom.plans.catalog import (ENR, EV, REVENUE, as_of, enriched_events, events, money_sql, priced_events,
                                     query, ratio_sql, sessions_sql, slot_sql)
from clickloom.plans.event_queries import _item_ctes
from clickloom.plans.report_queries import HOUR, revenue_events
from clickloom.sources import envelopes, tables

LATE = "2024-01-30 23:00:00"


@query("freshness", f"""WITH {EV}, f AS (SELECT count(*) AS event_count, max("timestamp") AS latest_event FROM ev
WHERE "timestamp" >= TIMESTAMP '{LATE}' - INTERVAL 1 HOUR AND "timestamp" <= TIMESTAMP '{LATE}')
SELECT *, event_count > 0 AS passed FROM f""")
def freshness(spark, sf_dir):
    return quality.freshness(tables.canonical_events(spark, sf_dir, since="2024-01-30 22:00:00"), as_of(LATE))


@query("expected_duration", f"""SELECT count(*) AS event_count, 300 + (count(*) // 10000) * 60 AS expected_duration,
  600 + (count(*) // 10000) * 60 AS timeout_seconds FROM events""")
def expected_duration(spark, sf_dir):
    return quality.expected_duration(events(spark, sf_dir).agg(F.count("*").alias("event_count")))


@query("warehouse_checks", f"""WITH {EV}, t AS (SELECT
  count(*) FILTER (WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15') AS r, count(*) FILTER (WHERE event_id IS NULL) AS z,
  count(DISTINCT CASE WHEN CAST("timestamp" AS DATE) = DATE '2024-01-15' THEN user_id END) AS u FROM ev)
SELECT 'events_loaded_for_day' AS "check", r AS value, r > 0 AS passed FROM t
UNION ALL SELECT 'no_null_event_ids', z, z = 0 FROM t UNION ALL SELECT 'multiple_unique_users', u, u > 10 FROM t""")
def warehouse_checks(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("processing_date", F.to_date("timestamp"))
    return quality.table_checks(rows, F.lit("2024-01-15").cast("date"))


@query("expectations", f"""WITH {EV}, t AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE event_id IS NULL) AS a, count(*) FILTER (WHERE event_type = 'error') AS b,
  count(*) FILTER (WHERE NOT property_price BETWEEN 10 AND 500) AS c, count(*) - count(DISTINCT event_id) AS d,
  count(*) FILTER (WHERE product_id IS NULL) AS e FROM ev)
SELECT 'event_id_not_null' AS rule, a AS value, a = 0 AS passed FROM t
UNION ALL SELECT 'event_type_in_set', b, b = 0 FROM t UNION ALL SELECT 'price_between', c, c = 0 FROM t
UNION ALL SELECT 'session_id_matches', 0, TRUE FROM t UNION ALL SELECT 'event_id_unique', d, d = 0 FROM t
UNION ALL SELECT 'product_id_not_null', e, e = 0 FROM t UNION ALL SELECT 'row_count', n, n >= 100 FROM t
UNION ALL SELECT 'has_columns', 2, FALSE FROM t""")
def expectations(spark, sf_dir):
    p = F.col("properties")
    rows = events(spark, sf_dir).withColumns({
        "price": rules.number(p, "price"), "product_id": p["product_id"]})
    return quality.expect(rows, [
        quality.not_null("event_id"), quality.in_set("event_type", quality.EVENT_TYPES),
        quality.between("price", 10, 500), quality.matches("session_id", r"^\d+_\d{8}$"),
        quality.unique("event_id"), quality.not_null("product_id"), quality.row_count(100),
        # two of these are not so: there is no coupon, and a price is a double
        quality.has_columns(event_id="string", timestamp="timestamp", price="string", coupon="string")])


@query("expectation_suites", f"""WITH {ENR},
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS odd, count(*) - count(DISTINCT event_id) AS twice,
  count(*) FILTER (WHERE customer_segment IS NULL) AS unknown FROM enr),
d AS (SELECT count(DISTINCT CAST("timestamp" AS DATE)) AS days FROM enr)
SELECT 'raw_events' AS suite, 'has_columns' AS rule, 0 AS value, true AS passed UNION ALL SELECT 'raw_events', 'row_count', n, n >= 1 FROM c
UNION ALL SELECT 'raw_events', unnest(['event_id_not_null', 'user_id_not_null', 'event_type_not_null', 'timestamp_not_null']), 0, true
UNION ALL SELECT 'raw_events', 'event_type_in_set', odd, odd = 0 FROM c
UNION ALL SELECT 'raw_events', 'event_id_unique', twice, twice = 0 FROM c
UNION ALL SELECT 'enriched_events', 'row_count', n, n >= 1 FROM c
UNION ALL SELECT 'enriched_events', 'customer_segment_not_null', unknown, unknown = 0 FROM c
UNION ALL SELECT 'enriched_events', unnest(['event_id_not_null', 'customer_value_segment_not_null', 'data_quality_score_between',
  'hour_of_day_between', 'event_revenue_fits_money', 'revenue_not_negative']), 0, true
UNION ALL SELECT 'business_metrics', 'row_count', days, days >= 1 FROM d
UNION ALL SELECT 'business_metrics', unnest(['report_date_unique', 'total_revenue_not_null', 'users_within_events',
  'conversion_not_negative']), 0, true
UNION ALL SELECT 'data_warehouse', 'row_count', n, n >= 1 FROM c
UNION ALL SELECT 'data_warehouse', 'event_id_unique', twice, twice = 0 FROM c
UNION ALL SELECT 'data_warehouse', unnest(['event_id_not_null', 'event_revenue_fits_money', 'day_is_that_of_the_event']), 0, true""")
def expectation_suites(spark, sf_dir):
    """The four named suites, each on its table."""
    raw, rows = events(spark, sf_dir), enriched_events(spark, sf_dir)
    stored_rows = rows.withColumn("event_date", F.to_date("timestamp"))
    days = warehouse.daily_summary(stored_rows, sessions.session_metrics(rows))
    tables_of = {"raw_events": raw, "enriched_events": rows, "business_metrics": days, "data_warehouse": stored_rows}
    return reduce(DataFrame.unionByName, [quality.run_suite(df, name) for name, df in tables_of.items()])


@query("rule_violations", f"""WITH {_item_ctes()}, t AS (SELECT count(*) FILTER (WHERE quantity < 1) AS a,
  count(*) FILTER (WHERE price <= 0) AS b FROM items)
SELECT 'quantity_at_least_1' AS rule, a AS value, a = 0 AS passed FROM t
UNION ALL SELECT 'price_above_0', b, b = 0 FROM t""")
def rule_violations(spark, sf_dir):
    return quality.expect(envelopes.purchase_items(tables.purchase_events(spark, sf_dir)), quality.item_rules())


@query("order_violations", """WITH lines AS (SELECT l_orderkey,
  sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS items_total,
  CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS discount FROM lineitem GROUP BY 1),
t AS (SELECT count(*) FILTER (WHERE NOT discount BETWEEN 0 AND o_totalprice * CAST(0.2 AS DOUBLE)) AS a,
  count(*) FILTER (WHERE NOT abs(CAST(o_totalprice AS DECIMAL(18,4)) - items_total) < 0.01) AS b
  FROM orders JOIN lines ON l_orderkey = o_orderkey)
SELECT 'discount_within_a_fifth' AS rule, a AS value, a = 0 AS passed FROM t
UNION ALL SELECT 'total_is_sum_of_items', b, b = 0 FROM t""")
def order_violations(spark, sf_dir):
    lines = tables.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(money(F.col("l_extendedprice"))).alias("items_total"),
        F.sum(money(F.col("l_extendedprice") * F.col("l_discount"))).cast("double").alias("discount_amount"))
    orders = tables.table(spark, sf_dir, "orders")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey).withColumnRenamed("o_totalprice", "total_amount")
    return quality.expect(joined, quality.order_rules())


@query("quarantine", f"""WITH {EV}
SELECT 'ecommerce-events-raw' AS original_topic, user_no % 24 AS original_partition, n AS original_offset,
  kafka_timestamp AS original_timestamp, user_id AS original_key, '{{broken ' || event_id AS original_value,
  'missing: event_id,user_id,event_type,timestamp' AS error_message, 'UNPARSEABLE' AS error_type,
  'event_parser' AS processor_name, TIMESTAMP '2024-01-31' AS failure_timestamp, CAST(3 AS BIGINT) AS retry_count
FROM ev WHERE n % 97 = 0""")
def quarantine(spark, sf_dir):
    return quality.quarantine(tables.messages(spark, sf_dir), as_of()).drop("original_headers")


@query("lag_check", f"""WITH {EV}, h AS (SELECT user_no % 24 AS "partition", max(n) + 1 AS high_mark,
  max(CASE WHEN "timestamp" < TIMESTAMP '2024-01-25' THEN n END) + 1 AS pos FROM ev GROUP BY 1)
SELECT 'ecommerce-events-raw' AS topic, "partition", high_mark, coalesce(pos, 0) AS position,
  high_mark - coalesce(pos, 0) AS lag, CASE WHEN high_mark - coalesce(pos, 0) > 10000 THEN 'fail'
  WHEN high_mark - coalesce(pos, 0) > 1000 THEN 'warn' ELSE 'ok' END AS status FROM h""")
def lag_check(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("topic", F.lit("ecommerce-events-raw"))
    marks = rows.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("high_mark"))
    done = (rows.where(F.col("timestamp") < F.lit("2024-01-25").cast("timestamp"))
            .groupBy("topic", "partition").agg((F.max("offset") + 1).alias("position")))
    return quality.lag_check(marks, done)


@query("health_score", f"""WITH {EV}, s AS (SELECT user_no % 24 AS "partition", user_no % 24 <> 7 AS is_running,
  max(n) - max(CASE WHEN "timestamp" < TIMESTAMP '2024-01-12' THEN n END) AS current_lag,
  count(*) FILTER (WHERE event_type <> 'error') AS processed,
  count(*) FILTER (WHERE event_type = 'error' AND n % 3 = 0) AS failed FROM ev GROUP BY 1, 2),
h AS (SELECT *, CAST(least(CASE WHEN NOT is_running THEN 0 WHEN current_lag > 10000 THEN 25 WHEN current_lag > 5000 THEN 50 ELSE 100 END,
  CASE WHEN {ratio_sql('failed', 'processed + failed')} > CAST(0.1 AS DOUBLE) THEN 25
       WHEN {ratio_sql('failed', 'processed + failed')} > CAST(0.05 AS DOUBLE) THEN 75 ELSE 100 END) AS BIGINT) AS health_score FROM s)
SELECT *, CASE WHEN health_score > 75 THEN 'healthy' WHEN health_score > 25 THEN 'degraded' ELSE 'unhealthy' END AS status FROM h""")
def health_score(spark, sf_dir):
    error = F.col("event_type") == "error"
    before = F.col("timestamp") < F.lit("2024-01-12").cast("timestamp")
    odd = F.col("offset") % 3 == 0
    stats = events(spark, sf_dir).groupBy("partition").agg(
        (F.max("offset") - F.max(F.when(before, F.col("offset")))).alias("current_lag"),
        F.count_if(~error).alias("processed"), F.count_if(error & odd).alias("failed"))
    return quality.consumer_health(stats.withColumn("is_running", F.col("partition") != 7))


@query("producer_health", f"""WITH {EV}, s AS (SELECT source, count(*) FILTER (WHERE event_type = 'error') AS queue_size FROM ev GROUP BY 1),
h AS (SELECT source, CASE source WHEN 'web' THEN 'CLOSED' WHEN 'mobile' THEN 'HALF_OPEN' ELSE 'OPEN' END AS circuit_state, queue_size FROM s),
p AS (SELECT *, CAST(CASE circuit_state WHEN 'OPEN' THEN 0 WHEN 'HALF_OPEN' THEN 50 ELSE CASE WHEN queue_size > 1000 THEN 25 ELSE 100 END END AS BIGINT) AS health_score FROM h)
SELECT *, CASE WHEN health_score > 75 THEN 'healthy' WHEN health_score > 25 THEN 'degraded' ELSE 'unhealthy' END AS status FROM p""")
def producer_health(spark, sf_dir):
    source = F.col("source")
    stats = events(spark, sf_dir).groupBy("source").agg(
        F.count_if(F.col("event_type") == "error").alias("queue_size"))
    return quality.producer_health(stats.withColumn("circuit_state", F.when(source == "web", "CLOSED")
                                   .when(source == "mobile", "HALF_OPEN").otherwise("OPEN")))


@query("consumer_stats", f"""WITH {EV}
SELECT source AS topic, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
  count(*) AS messages, CAST(sum(length(session_id)) AS BIGINT) AS total_bytes,
  CAST(sum(epoch_us(kafka_timestamp) // 1000 - epoch_us("timestamp") // 1000) AS DOUBLE) / count(*) AS mean_ms
FROM ev GROUP BY 1, 2""")
def consumer_stats(spark, sf_dir):
    log = events(spark, sf_dir).select(
        F.col("source").alias("topic"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.length("session_id").alias("bytes"),
        (F.unix_millis("kafka_timestamp") - F.unix_millis("timestamp")).alias("ms"))
    return quality.consumer_stats(log)


_UPSERT_STAGED = """
staged AS (SELECT event_id, event_type, CAST(total_amount AS VARCHAR) IS NULL AS x, "timestamp", user_id,
  CASE WHEN n % 5 = 0 THEN 'VIP' ELSE customer_segment END AS customer_segment,
  event_revenue + 1 AS event_revenue FROM enr WHERE "timestamp" >= TIMESTAMP '2024-01-20'),
target AS (SELECT event_id, event_type, "timestamp", user_id, customer_segment, event_revenue FROM enr
  WHERE "timestamp" < TIMESTAMP '2024-01-25')"""


@query("warehouse_upsert", f"""WITH {ENR}, {_UPSERT_STAGED}
SELECT t.event_id, t.event_type, t."timestamp", t.user_id,
  CASE WHEN s.event_id IS NULL THEN t.customer_segment ELSE s.customer_segment END AS customer_segment,
  CASE WHEN s.event_id IS NULL THEN t.event_revenue ELSE s.event_revenue END AS event_revenue,
  CASE WHEN s.event_id IS NOT NULL THEN TIMESTAMP '2024-01-31' END AS updated_at
FROM target t LEFT JOIN staged s ON s.event_id = t.event_id
UNION ALL SELECT event_id, event_type, "timestamp", user_id, customer_segment, event_revenue, NULL FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.event_id = s.event_id)""")
def warehouse_upsert(spark, sf_dir):
    rows = priced_events(spark, sf_dir).select(
        "event_id", "event_type", "timestamp", "user_id", "properties", "customer_segment", "event_revenue", "offset")
    cut = lambda day: F.lit(day).cast("timestamp")
    target = (rows.where(F.col("timestamp") < cut("2024-01-25")).drop("offset")
              .withColumn("updated_at", F.lit(None).cast("timestamp")))
    later = rows.where(F.col("timestamp") >= cut("2024-01-20"))
    staging = later.select(
        "event_id", "event_type", "timestamp", "user_id", "properties",
        F.when(F.col("offset") % 5 == 0, "VIP").otherwise(F.col("customer_segment")).alias("customer_segment"),
        (F.col("event_revenue") + 1).alias("event_revenue"))
    return warehouse.upsert(target, staging, as_of()).drop("properties")


@query("daily_summary", f"""WITH {ENR} {sessions_sql(21600)},
m AS (SELECT session_id, sum(CAST(session_duration_minutes AS DECIMAL(18,4))) AS minutes FROM sessions GROUP BY 1)
SELECT CAST("timestamp" AS DATE) AS report_date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
  {money_sql('event_revenue')} AS total_revenue,
  {ratio_sql("count(*) FILTER (WHERE event_type = 'purchase')", "count(*) FILTER (WHERE event_type = 'add_to_cart')")} AS conversion_rate,
  CAST(sum(minutes) AS DOUBLE) / count(minutes) AS avg_session_duration
FROM enr LEFT JOIN m USING (session_id) GROUP BY 1""")
def daily_summary(spark, sf_dir):
    rows = priced_events(spark, sf_dir).withColumn("event_date", F.to_date("timestamp"))
    return warehouse.daily_summary(rows, sessions.session_metrics(rows, "6 hours"))


@query("daily_metrics", f"""WITH {ENR}
SELECT CAST("timestamp" AS DATE) AS metric_date, event_type, source, customer_segment, count(*) AS event_count,
  count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions,
  {money_sql('event_revenue')} AS total_revenue FROM enr GROUP BY ALL""")
def daily_metrics(spark, sf_dir):
    return warehouse.daily_metrics(priced_events(spark, sf_dir))


@query("latest_per_key", f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY "timestamp" DESC, event_id DESC) AS nth FROM ev)
SELECT user_id, event_id, event_type, "timestamp", source FROM r WHERE nth = 1""")
def latest_per_key(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "event_type", "timestamp", "source")
    return warehouse.latest_per_key(rows, ["user_id"], ["timestamp", "event_id"])


@query("retention_tiers", """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS partition_date, count(*) AS "rows",
  date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age_days FROM orders GROUP BY ALL)
SELECT *, CASE WHEN age_days >= 2555 THEN 'EXPIRED' WHEN age_days >= 365 THEN 'DEEP_ARCHIVE'
  WHEN age_days >= 90 THEN 'GLACIER' WHEN age_days >= 30 THEN 'STANDARD_IA' ELSE 'STANDARD' END AS tier FROM d""")
def retention_tiers(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return warehouse.partition_tiers(orders, "day", "raw", F.lit("2002-01-01").cast("date"))


@query("retention_filter", f"""WITH {EV}
SELECT CAST("timestamp" AS DATE) AS day, count(*) AS events FROM ev
WHERE CAST("timestamp" AS DATE) > DATE '2024-01-31' - 7 GROUP BY 1""")
def retention_filter(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    kept = warehouse.within_retention(rows, "day", warehouse.TOPIC_DAYS["ecommerce-events-raw"],
                                      F.lit("2024-01-31").cast("date"))
    return kept.groupBy("day").agg(F.count("*").alias("events"))


@query("cdc_apply", """WITH changes AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE o_orderstatus WHEN 'F' THEN 'd' ELSE 'u' END AS op FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 'X', o_totalprice + 1, o_orderdate + INTERVAL 1 DAY, 'u' FROM orders WHERE o_orderkey % 6 = 0
  UNION ALL SELECT o_orderkey + 100000000, o_orderstatus, o_totalprice, o_orderdate, 'c' FROM orders WHERE o_orderkey % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, op DESC) AS nth FROM changes)
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.o_orderkey = o.o_orderkey)
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM r WHERE nth = 1 AND op <> 'd'""")
def cdc_apply(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    key = F.col("o_orderkey")
    first = orders.where(key % 3 == 0).withColumn("op", F.when(F.col("o_orderstatus") == "F", "d").otherwise("u"))
    second = orders.where(key % 6 == 0).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"),
        (F.col("o_orderdate") + F.expr("interval 1 day")).alias("o_orderdate"), F.lit("u").alias("op"))
    new = orders.where(key % 50 == 0).withColumns({"o_orderkey": key + 100000000, "op": F.lit("c")})
    return warehouse.apply_changes(orders, first.unionByName(second).unionByName(new), "o_orderkey",
                                   ["o_orderdate", "op"])


@query("opt_out_filter", f"""WITH {EV}
SELECT event_id, user_id, event_type FROM ev WHERE user_no NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def opt_out_filter(spark, sf_dir):
    out = tables.table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").cast("string").alias("user_id"))
    return privacy.without_users(events(spark, sf_dir), out).select("event_id", "user_id", "event_type")


@query("erase_user", f"""WITH {EV}
SELECT CAST("timestamp" AS DATE) AS day, count(*) AS events, count(DISTINCT user_id) AS users FROM ev
WHERE user_id <> '8' GROUP BY 1""")
def erase_user(spark, sf_dir):
    rows = events(spark, sf_dir)
    gone = rows.where(F.col("user_id") == "8").select("user_id").distinct()
    kept = privacy.without_users(rows, gone)
    return kept.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


@query("region_access", """SELECT r_name AS region, count(*) AS customers, min(c_custkey) AS first_customer
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('EUROPE', 'AFRICA') GROUP BY 1""")
def region_access(spark, sf_dir):
    customers = tables.table(spark, sf_dir, "customer")
    nations, regions = tables.table(spark, sf_dir, "nation"), tables.table(spark, sf_dir, "region")
    placed = (customers.join(nations, customers.c_nationkey == nations.n_nationkey)
              .join(regions, nations.n_regionkey == regions.r_regionkey))
    seen = privacy.visible_to(placed, "EU", F.col("r_name"), {"EU": ["EUROPE", "AFRICA"]})
    return seen.groupBy(F.col("r_name").alias("region")).agg(
        F.count("*").alias("customers"), F.min("c_custkey").alias("first_customer"))


@query("rolling_extract", f"""WITH {REVENUE}
SELECT {HOUR} AS hour_start, event_type, count(*) AS event_count, {money_sql('event_revenue')} AS revenue
FROM rev WHERE "timestamp" >= TIMESTAMP '2024-01-24' GROUP BY ALL""")
def rolling_extract(spark, sf_dir):
    rows = enrich.with_purchase_revenue(tables.canonical_events(spark, sf_dir, since="2024-01-24"))
    return privacy.rolling_extract(rows, as_of())


@query("incremental_extract", f"""WITH {REVENUE}
SELECT {HOUR} AS hour_start, event_type, count(*) AS event_count, {money_sql('event_revenue')} AS revenue
FROM rev WHERE "timestamp" >= (SELECT max({HOUR}) + INTERVAL 1 HOUR FROM ev WHERE "timestamp" < TIMESTAMP '2024-01-29')
  AND "timestamp" < TIMESTAMP '2024-01-31' GROUP BY ALL""")
def incremental_extract(spark, sf_dir):
    rows = revenue_events(spark, sf_dir)
    done = rows.where(F.col("timestamp") < F.lit("2024-01-29").cast("timestamp")).select(
        slot_start(F.col("timestamp"), "1 hour").alias("hour_start"))
    return privacy.extract_after(rows, done, as_of())


@query("auto_event_filter", f"""WITH {EV}
SELECT event_type, count(*) AS events FROM ev WHERE event_type NOT IN ('page_view', 'user_login') GROUP BY 1""")
def auto_event_filter(spark, sf_dir):
    kept = privacy.without_types(events(spark, sf_dir), ["page_view", "user_login"])
    return kept.groupBy("event_type").agg(F.count("*").alias("events"))


@query("source_switch", f"""WITH {EV}
SELECT source, event_type, count(*) AS events FROM ev WHERE source <> 'synthetic' GROUP BY 1, 2""")
def source_switch(spark, sf_dir):
    rows = events(spark, sf_dir)
    switches = rows.select("source", (F.col("source") != "synthetic").alias("enabled")).distinct()
    return privacy.by_source_switch(rows, switches).groupBy("source", "event_type").agg(F.count("*").alias("events"))


@query("odd_amounts", f"""WITH {EV}, t AS (SELECT event_type, n % 13 = 0 AS odd, CASE WHEN n % 13 = 0 THEN NULL ELSE v END AS v FROM ev)
SELECT event_type, CAST(sum(CAST(v AS DECIMAL(18,4))) AS DOUBLE) AS revenue, count(*) FILTER (WHERE odd) AS left_out
FROM t GROUP BY 1""")
def odd_amounts(spark, sf_dir):
    """Every 13th amount is one that no sum of money can hold: it is left out and counted, and stops nothing."""
    n = F.col("offset")
    texts = F.when(n % 39 == 0, "1e20").when(n % 39 == 13, "NaN").when(n % 39 == 26, "-Infinity")
    rows = events(spark, sf_dir).withColumn("amount", F.coalesce(texts, F.col("value").cast("string")).cast("double"))
    return rows.groupBy("event_type").agg(
        money_sum(F.col("amount")).alias("revenue"),
        F.count_if(~quality.fits_money("amount").holds).alias("left_out"))
