"""Queries on parsing, enrichment, sessions and windows."""

from pyspark.sql import functions as F

from clickloom.functions import business as rules
from clickloom.operators import carts, enrich, kpi, ordered, sessions, warehouse, windows
from clickloom.plans.catalog import (ENR, EV, as_of, enriched_events, events, money_sql,
                                     priced_events, query, ratio_sql, sessions_sql, slot_sql)
from clickloom.sources import envelopes, readers, tables


@query("parse_events", f"""WITH {EV}
SELECT event_id, event_type, "timestamp", user_id, session_id, source, product_id, quantity,
  CASE WHEN no_metadata THEN NULL ELSE 'prod' END AS environment, kafka_timestamp, n AS "offset",
  user_no % 24 AS "partition"
FROM ev WHERE n % 97 <> 0""")
def parse_events(spark, sf_dir):
    parsed = enrich.require_fields(readers.parse_events(tables.messages(spark, sf_dir)))
    p = F.col("properties")
    return parsed.select(
        "event_id", "event_type", "timestamp", "user_id", "session_id", "source",
        p["product_id"].alias("product_id"), p["quantity"].try_cast("int").alias("quantity"),
        F.col("metadata")["environment"].alias("environment"), "kafka_timestamp", "offset", "partition")


@query("enrich_events", f"""WITH {ENR}
SELECT event_id, event_type, "timestamp", user_id, session_id, source, customer_segment, location,
  known_product AS product_id, category, brand, price, DATE '2024-01-31' AS processing_date,
  CAST(hour("timestamp") AS BIGINT) AS hour_of_day, CAST(dayofweek("timestamp") + 1 AS BIGINT) AS day_of_week,
  dayofweek("timestamp") IN (0, 6) AS is_weekend, event_revenue, customer_value_segment,
  data_quality_score, data_quality_score > CAST(0.7 AS DOUBLE) AS is_valid_event
FROM enr""")
def enrich_events(spark, sf_dir):
    return enriched_events(spark, sf_dir).select(
        "event_id", "event_type", "timestamp", "user_id", "session_id", "source", "customer_segment",
        "location", "product_id", "category", "brand", "price", "processing_date", "hour_of_day",
        "day_of_week", "is_weekend", "event_revenue", "customer_value_segment",
        "data_quality_score", "is_valid_event")


@query("valid_events_by_hour", f"""WITH {ENR}
SELECT CAST(hour("timestamp") AS BIGINT) AS hour_of_day, count(*) AS events,
  {money_sql('event_revenue')} AS revenue
FROM enr WHERE data_quality_score > CAST(0.7 AS DOUBLE) GROUP BY 1""")
def valid_events_by_hour(spark, sf_dir):
    valid = enrich.valid_events(priced_events(spark, sf_dir))
    return valid.groupBy(F.hour("timestamp").alias("hour_of_day")).agg(
        F.count("*").alias("events"), F.sum(F.col("event_revenue").cast("decimal(18,4)"))
        .cast("double").alias("revenue"))


@query("quality_issues", f"""WITH {ENR}
SELECT event_id, user_id, event_type, "timestamp", data_quality_score,
  'LOW_QUALITY_SCORE' AS issue_type, TIMESTAMP '2024-01-31 00:00:00' AS detected_at
FROM enr WHERE NOT data_quality_score > CAST(0.7 AS DOUBLE)""")
def quality_issues(spark, sf_dir):
    return enrich.quality_issues(enrich.score(enrich.require_fields(events(spark, sf_dir))), as_of())


@query("session_sequence", f"""WITH {EV}
SELECT event_id, session_id, "timestamp",
  row_number() OVER (PARTITION BY session_id ORDER BY "timestamp", event_id) AS session_sequence FROM ev""")
def session_sequence(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "session_id", "timestamp")
    return ordered.number_rows(rows, ["session_id"])


@query("realtime_metrics", f"""WITH {ENR}
SELECT {slot_sql('"timestamp"', 60)} AS window_start,
  {slot_sql('"timestamp"', 60)} + INTERVAL 1 MINUTE AS window_end, event_type, source, customer_segment,
  count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT session_id) AS unique_sessions, {money_sql('event_revenue')} AS total_revenue,
  {money_sql('data_quality_score')} / count(*) AS avg_quality_score
FROM enr GROUP BY ALL""")
def realtime_metrics(spark, sf_dir):
    return windows.realtime_metrics(priced_events(spark, sf_dir))


@query("realtime_metrics_daily", f"""WITH {ENR}
SELECT {slot_sql('"timestamp"', 86400)} AS window_start,
  {slot_sql('"timestamp"', 86400)} + INTERVAL 1 DAY AS window_end, event_type, source, customer_segment,
  count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT session_id) AS unique_sessions, {money_sql('event_revenue')} AS total_revenue,
  {money_sql('data_quality_score')} / count(*) AS avg_quality_score
FROM enr GROUP BY ALL""")
def realtime_metrics_daily(spark, sf_dir):
    return windows.realtime_metrics(priced_events(spark, sf_dir), "1 day")


def _sessions(spark, sf_dir, gap="30 minutes"):
    return sessions.session_metrics(priced_events(spark, sf_dir), gap)


def _session_query(seconds):
    return f"""WITH {ENR} {sessions_sql(seconds)}
SELECT session_id, user_id, session_start, session_end,
  session_end + to_seconds({seconds}) AS window_end, total_events, unique_event_types, session_revenue,
  customer_segment, source, has_purchase, has_cart_activity, session_duration_minutes, abandoned_cart,
  conversion_rate FROM sessions"""


def _flat_sessions(df):
    return df.withColumn("window_end", F.col("session_window.end")).drop("session_window")


@query("session_metrics", _session_query(1800))
def session_metrics(spark, sf_dir):
    return _flat_sessions(_sessions(spark, sf_dir))


@query("session_metrics_6h", _session_query(21600))
def session_metrics_6h(spark, sf_dir):
    return _flat_sessions(_sessions(spark, sf_dir, "6 hours"))


def sequences_sql(size: int, closed: str = "true") -> str:
    return f"""WITH {ENR} {sessions_sql(21600)},
placed AS (SELECT *, row_number() OVER (PARTITION BY session_id, user_id, run ORDER BY "timestamp", event_id) - 1 AS place,
  min("timestamp") OVER (PARTITION BY session_id, user_id, run) AS session_start,
  max("timestamp") OVER (PARTITION BY session_id, user_id, run) AS session_end FROM numbered)
SELECT session_id, user_id, session_start, CAST(place // {size} AS BIGINT) AS chunk,
  count(*) AS entries, string_agg(event_type, ',' ORDER BY "timestamp", event_id) AS event_sequence,
  string_agg(coalesce(product_id, '-'), ',' ORDER BY "timestamp", event_id) AS product_sequence
FROM placed WHERE {closed} GROUP BY session_id, user_id, run, session_start, place // {size}"""


def _sequences(spark, sf_dir, size):
    rows = sessions.session_sequences(events(spark, sf_dir), "6 hours", size)
    names = F.transform("event_properties", lambda m: F.coalesce(m["product_id"], F.lit("-")))
    return rows.withColumn("product_sequence", names).drop("event_properties")


@query("session_sequences", sequences_sql(1000))
def session_sequences(spark, sf_dir):
    return _sequences(spark, sf_dir, 1000)


@query("session_sequences_in_chunks", sequences_sql(2))
def session_sequences_in_chunks(spark, sf_dir):
    return _sequences(spark, sf_dir, 2)


@query("session_alerts", f"""WITH {ENR} {sessions_sql(21600)}
SELECT session_id, user_id, session_start, session_end, session_revenue, abandoned_cart,
  CASE WHEN abandoned_cart THEN 'CART_ABANDONMENT' WHEN session_revenue > 500 THEN 'HIGH_VALUE_SESSION'
       WHEN session_duration_minutes > 60 THEN 'LONG_SESSION' END AS alert_type,
  TIMESTAMP '2024-01-31 00:00:00' AS alert_timestamp
FROM sessions WHERE abandoned_cart OR session_revenue > 500 OR session_duration_minutes > 60""")
def session_alerts(spark, sf_dir):
    return sessions.session_alerts(_sessions(spark, sf_dir, "6 hours"), as_of())


@query("conversion_funnel", f"""WITH {ENR},
spread AS (SELECT enr.*, {slot_sql('"timestamp"', 60)} - to_minutes(i) AS window_start
  FROM enr, generate_series(0, 4) g(i)),
counted AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, source, customer_segment,
  count(DISTINCT CASE WHEN event_type = 'page_view' THEN session_id END) AS sessions_with_pageview,
  count(DISTINCT CASE WHEN event_type = 'product_view' THEN session_id END) AS sessions_with_product_view,
  count(DISTINCT CASE WHEN event_type = 'add_to_cart' THEN session_id END) AS sessions_with_add_to_cart,
  count(DISTINCT CASE WHEN event_type = 'purchase' THEN session_id END) AS sessions_with_purchase,
  {money_sql("CASE WHEN event_type = 'purchase' THEN event_revenue END")} AS total_revenue
  FROM spread GROUP BY ALL)
SELECT *, {ratio_sql('sessions_with_product_view', 'sessions_with_pageview')} AS product_view_rate,
  {ratio_sql('sessions_with_add_to_cart', 'sessions_with_product_view')} AS add_to_cart_rate,
  {ratio_sql('sessions_with_purchase', 'sessions_with_add_to_cart')} AS conversion_rate,
  {ratio_sql('sessions_with_purchase', 'sessions_with_pageview')} AS overall_conversion_rate
FROM counted""")
def conversion_funnel(spark, sf_dir):
    return windows.conversion_funnel(priced_events(spark, sf_dir))


@query("user_behavior", f"""WITH {ENR},
spread AS (SELECT enr.*, {slot_sql('"timestamp"', 600)} - to_minutes(10 * i) AS window_start
  FROM enr, generate_series(0, 5) g(i)),
wide AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS events_count,
  count(DISTINCT session_id) AS session_count, count(DISTINCT event_type) AS unique_event_types,
  {money_sql('event_revenue')} AS hourly_revenue, arg_min(struct_pack(s := customer_segment), "timestamp") AS f
  FROM spread GROUP BY window_start, user_id)
SELECT * EXCLUDE (f), f.s AS customer_segment,
  {ratio_sql('events_count', 'session_count')} AS avg_events_per_session,
  events_count > 50 AS is_high_activity,
  (least(events_count / CAST(10 AS DOUBLE), 10) + least(unique_event_types * CAST(2 AS DOUBLE), 10)
   + least(hourly_revenue / 100, 10) + least(session_count * CAST(5 AS DOUBLE), 10)) / 4 AS behavior_score
FROM wide""")
def user_behavior(spark, sf_dir):
    return windows.user_behavior(priced_events(spark, sf_dir))


@query("behavior_sequences", f"""WITH {EV},
spread AS (SELECT ev.*, {slot_sql('"timestamp"', 600)} - to_minutes(10 * i) AS window_start
  FROM ev, generate_series(0, 5) g(i)),
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id, window_start ORDER BY "timestamp", event_id) - 1 AS place FROM spread)
SELECT user_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, CAST(place // 1000 AS BIGINT) AS chunk,
  count(*) AS entries, string_agg(event_type, ',' ORDER BY "timestamp", event_id) AS event_sequence
FROM placed GROUP BY user_id, window_start, place // 1000""")
def behavior_sequences(spark, sf_dir):
    return windows.behavior_sequences(events(spark, sf_dir))


def _demo_sql(price: str) -> str:
    return EV + f""",
demo AS (SELECT event_id, make_timestamp(epoch_us(TIMESTAMP '2024-01-01')
    + (epoch_us("timestamp") - epoch_us(TIMESTAMP '2024-01-01')) // 1000) AS "timestamp",
  user_id, event_type, {price} AS price,
  CASE n % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS source,
  CASE user_no % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'CA' WHEN 3 THEN 'DE' ELSE 'FR' END AS country,
  CASE event_type WHEN 'page_view' THEN 1 WHEN 'product_view' THEN 3 WHEN 'add_to_cart' THEN 10
       WHEN 'purchase' THEN 100 ELSE 0 END AS event_value FROM ev)"""


_DEMO = _demo_sql("property_price")


# A removal has its price here: a demo event has one whatever its type. A click on a product has a quantity.
@query("demo_enriched_events", f"""WITH {_demo_sql("CASE WHEN quantity IS NOT NULL THEN v END")}
SELECT event_id, "timestamp", user_id || '_' || strftime("timestamp", '%Y%m%d%H') AS session_id,
  source = 'mobile' AS is_mobile, CAST(event_value AS BIGINT) AS event_value,
  CASE WHEN price > 200 THEN 'premium' WHEN price > 50 THEN 'standard' ELSE 'budget' END AS customer_segment
FROM demo""")
def demo_enriched_events(spark, sf_dir):
    return windows.with_demo_columns(tables.demo_events(spark, sf_dir, removal_prices=True)).select(
        "event_id", "timestamp", "session_id", "is_mobile", "event_value", "customer_segment")


@query("demo_event_metrics", f"""WITH {_DEMO},
spread AS (SELECT demo.*, {slot_sql('"timestamp"', 10)} - to_seconds(10 * i) AS window_start
  FROM demo, generate_series(0, 2) g(i))
SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, event_type, source,
  count(*) AS event_count, CAST(sum(event_value) AS BIGINT) AS total_value,
  count(DISTINCT user_id) AS unique_users,
  CAST(round(sum(CAST(price * 100 AS BIGINT)) / CAST(nullif(count(price), 0) AS DOUBLE)) / 100 AS DOUBLE) AS avg_price
FROM spread GROUP BY window_start, event_type, source""")
def demo_event_metrics(spark, sf_dir):
    return windows.demo_event_metrics(windows.with_demo_columns(tables.demo_events(spark, sf_dir)))


@query("demo_user_behavior", f"""WITH {_DEMO}
SELECT {slot_sql('"timestamp"', 60)} AS window_start, user_id, count(*) AS events_per_minute,
  count(DISTINCT event_type) AS unique_event_types, CAST(sum(event_value) AS BIGINT) AS user_score,
  max(price) AS max_purchase, arg_min(country, "timestamp") AS country
FROM demo GROUP BY 1, 2 HAVING count(*) > 2""")
def demo_user_behavior(spark, sf_dir):
    return windows.demo_user_behavior(windows.with_demo_columns(tables.demo_events(spark, sf_dir)))


@query("simple_summary", f"""WITH {_DEMO},
spread AS (SELECT demo.*, {slot_sql('"timestamp"', 5)} - to_seconds(5 * i) AS window_start
  FROM demo, generate_series(0, 3) g(i))
SELECT window_start, window_start + INTERVAL 20 SECOND AS window_end, event_type, count(*) AS "count",
  {money_sql('price')} AS total_value, count(DISTINCT user_id) AS unique_users
FROM spread GROUP BY window_start, event_type""")
def simple_summary(spark, sf_dir):
    return windows.simple_summary(tables.demo_events(spark, sf_dir), "price")


@query("event_revenue_by_type", f"""WITH {ENR}
SELECT event_type, count(*) AS event_count, {money_sql('event_revenue')} AS total_value,
  count(DISTINCT user_id) AS unique_users FROM enr GROUP BY event_type""")
def event_revenue_by_type(spark, sf_dir):
    return kpi.revenue_by_type(priced_events(spark, sf_dir), "event_revenue")


@query("user_activity", f"""WITH {EV}
SELECT user_id, count(*) AS total_events, {money_sql('v')} AS total_value,
  array_to_string(list_sort(list(DISTINCT event_type)), ',') AS event_types FROM ev GROUP BY user_id""")
def user_activity(spark, sf_dir):
    return kpi.user_activity(events(spark, sf_dir), "value")


@query("group_count", f"""WITH {EV}
SELECT user_id, event_type, count(*) AS "count" FROM ev GROUP BY 1, 2""")
def group_count(spark, sf_dir):
    return kpi.group_count(events(spark, sf_dir), ["user_id", "event_type"])


@query("customer_value_segments", f"""WITH {ENR}
SELECT CASE WHEN total_spent > 1000 AND total_orders > 10 THEN 'VIP'
       WHEN total_spent > 500 AND total_orders > 5 THEN 'Premium'
       WHEN total_spent > 100 AND total_orders > 2 THEN 'Regular' ELSE 'New' END AS customer_value_segment,
  count(*) AS users, CAST(sum(CAST(total_spent AS DECIMAL(20,6))) AS DOUBLE) AS total_spent FROM profile GROUP BY 1""")
def customer_value_segments(spark, sf_dir):
    return warehouse.user_segments(tables.profiles(spark, sf_dir), rules.customer_value_segment(
        F.col("total_spent"), F.col("total_orders")))


def _cart_sql(source: str) -> str:
    """Steps through each user's events with the items of the cart as a map; ``source`` ends in ``cart``."""
    def items(held):
        entry = f"{held}[o.product]"
        return f"""CASE o.event_type WHEN 'purchase' THEN MAP {{}}::MAP(VARCHAR, STRUCT(units BIGINT, price DECIMAL(18,4)))
    ELSE map_concat({held}, MAP([o.product], [struct_pack(
      units := greatest(0, coalesce({entry}.units, 0) + CASE o.event_type WHEN 'add_to_cart' THEN o.quantity ELSE -o.quantity END),
      price := CASE WHEN o.event_type = 'add_to_cart' THEN coalesce(o.price, {entry}.price) ELSE {entry}.price END)])) END"""
    return f"""WITH RECURSIVE {source},
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS at FROM cart),
r AS (SELECT o.user_id, o.at, o.event_id, o.event_type, o."timestamp",
    {items("(MAP {}::MAP(VARCHAR, STRUCT(units BIGINT, price DECIMAL(18,4))))")} AS items FROM o WHERE o.at = 1
  UNION ALL SELECT o.user_id, o.at, o.event_id, o.event_type, o."timestamp", {items("r.items")}
  FROM r JOIN o ON o.user_id = r.user_id AND o.at = r.at + 1)
SELECT event_id, user_id, event_type, "timestamp", CAST(coalesce(list_sum(list_transform(map_values(items),
  lambda x: CAST(x.units * coalesce(x.price, 0) AS DECIMAL(38,4)))), 0) AS DOUBLE) AS cart_total FROM r"""


@query("cart_totals", _cart_sql(f"""{EV},
cart AS (SELECT event_id, user_id, event_type, "timestamp", coalesce(product_id, '') AS product,
  coalesce(quantity, 1) AS quantity, CAST(property_price AS DECIMAL(18,4)) AS price
  FROM ev WHERE event_type IN ('add_to_cart', 'remove_from_cart', 'purchase'))"""))
def cart_totals(spark, sf_dir):
    return carts.cart_totals(events(spark, sf_dir, ("click", "purchase"))).select(
        "event_id", "user_id", "event_type", "timestamp", "cart_total")


CART_LINES = """lines AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_quantity AS BIGINT), CAST(floor(l_extendedprice) AS BIGINT)) AS id,
  CAST(o_custkey AS VARCHAR) AS user_id, o_orderdate + to_seconds(60 * l_linenumber) AS t, CAST(l_partkey % 50 AS VARCHAR) AS product,
  CAST(l_quantity AS BIGINT) AS n, floor(l_extendedprice / l_quantity) AS price, l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cart AS (SELECT id || '-a' AS event_id, user_id, 'add_to_cart' AS event_type, t AS "timestamp", product, n AS quantity,
    CASE WHEN line % 7 <> 6 THEN CAST(price AS DECIMAL(18,4)) END AS price FROM lines
  UNION ALL SELECT id || '-r', user_id, 'remove_from_cart', t + to_seconds(90), product, CASE line % 4 WHEN 0 THEN 99 ELSE n // 2 END,
    NULL FROM lines WHERE line % 2 = 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), 'purchase', o_orderdate + INTERVAL 12 HOUR, '', 1, NULL
    FROM orders WHERE o_orderkey % 3 = 0)"""


@query("cart_items", _cart_sql(CART_LINES))
def cart_items(spark, sf_dir):
    """Order lines as carts: products come again at other prices, removals carry none and may take more than is there."""
    return carts.cart_totals(tables.cart_events(spark, sf_dir), columns=["event_id", "user_id", "event_type", "timestamp"])


def _idle_query(seconds):
    return f"""WITH {EV},
gaps AS (SELECT *, CASE WHEN epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) <= {seconds * 1_000_000}
    THEN 0 ELSE 1 END AS opens FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp")),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING)
    AS run FROM gaps)
SELECT user_id, CAST(run AS BIGINT) AS session_number, min("timestamp") AS session_start,
  max("timestamp") AS session_end, count(*) AS total_events FROM numbered GROUP BY user_id, run"""


@query("inactivity_sessions", _idle_query(1800))
def inactivity_sessions(spark, sf_dir):
    return sessions.inactivity_sessions(events(spark, sf_dir))


@query("idle_day_sessions", _idle_query(86400))
def idle_day_sessions(spark, sf_dir):
    return sessions.inactivity_sessions(events(spark, sf_dir), gap="24 hours")


@query("daily_expiry_sessions", f"""WITH {EV},
aged AS (SELECT event_id, user_id, "timestamp", max(CASE WHEN event_type = 'user_login' THEN "timestamp" END)
  OVER (PARTITION BY user_id ORDER BY "timestamp", event_id ROWS UNBOUNDED PRECEDING) AS started_at FROM ev)
SELECT *, epoch_us("timestamp") - epoch_us(started_at) > 86400000000 AS is_expired FROM aged""")
def daily_expiry_sessions(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "event_type", "timestamp")
    return sessions.session_age(rows, "user_login").drop("event_type")


def _item_ctes():
    return """
items AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
  CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(l_partkey AS VARCHAR) AS product_id, l_extendedprice / l_quantity AS price,
  UNNEST(CASE WHEN l_quantity >= 2 THEN [CAST(floor(l_quantity / 2) AS BIGINT),
    CAST(l_quantity - floor(l_quantity / 2) AS BIGINT)] ELSE [CAST(l_quantity AS BIGINT)] END) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query("purchase_items", f"WITH {_item_ctes()} SELECT * FROM items")
def purchase_items(spark, sf_dir):
    return envelopes.purchase_items(tables.purchase_events(spark, sf_dir)).select(
        "event_id", "user_id", "order_id", "product_id", "price", "quantity")


@query("top_products", f"""WITH {_item_ctes()}
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, {money_sql('price * quantity')} AS revenue
FROM items GROUP BY product_id ORDER BY units DESC, product_id LIMIT 10""")
def top_products(spark, sf_dir):
    return kpi.top_products(envelopes.purchase_items(tables.purchase_events(spark, sf_dir)))


@query("web_envelope", f"""WITH {EV}
SELECT user_id AS record_key, event_id, event_type, "timestamp", user_id, session_id, source,
  product_id, CASE WHEN no_metadata THEN NULL ELSE 'prod' END AS environment,
  CASE WHEN no_metadata THEN NULL ELSE '1.0.0' END AS sdk_version,
  CASE WHEN no_metadata THEN NULL ELSE source END AS platform,
  CASE WHEN no_metadata THEN NULL ELSE date_trunc('day', "timestamp") END AS session_start_time
FROM ev""")
def web_envelope(spark, sf_dir):
    sent = tables.web_payloads(spark, sf_dir)
    return envelopes.web_metadata(envelopes.web_events(sent)).select(
        "record_key", "event_id", "event_type", "timestamp", "user_id", "session_id", "source",
        F.col("properties")["product_id"].alias("product_id"), "environment", "sdk_version",
        "platform", "session_start_time")


@query("normalise_mobile", f"""WITH {EV},
named AS (SELECT *, CASE event_type WHEN 'product_view' THEN 'product_viewed' WHEN 'add_to_cart' THEN
  'product_added' WHEN 'purchase' THEN 'purchase_completed' ELSE event_type END AS name FROM ev)
SELECT sha256(user_id || '|' || session_id || '|' || CAST(epoch_us("timestamp") // 1000 AS VARCHAR) || '|' || name)
    AS event_id, event_type, date_trunc('milliseconds', "timestamp") AS "timestamp", user_id, session_id,
  'mobile' AS source, product_id, CASE WHEN n % 2 = 0 THEN 'ios' ELSE 'android' END AS platform,
  'prod' AS environment, CAST(2 AS BIGINT) AS metadata_entries
FROM named""")
def normalise_mobile(spark, sf_dir):
    return envelopes.mobile_events(tables.mobile_payloads(spark, sf_dir)).select(
        "event_id", "event_type", "timestamp", "user_id", "session_id", "source",
        F.col("properties")["product_id"].alias("product_id"),
        F.col("metadata")["platform"].alias("platform"),
        F.col("metadata")["environment"].alias("environment"),
        F.size("metadata").alias("metadata_entries"))
