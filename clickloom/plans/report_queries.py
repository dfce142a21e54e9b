"""Queries on business figures, metric samples and insight reports."""

from pyspark.sql import functions as F

from clickloom.functions.numeric import band, money_sum, ratio, slot_start
from clickloom.operators import enrich, insights, kpi, sessions, timeseries as ts, warehouse
from clickloom.plans.catalog import (ENR, EV, REVENUE, as_of, events, money_sql, priced_events,
                                     query, ratio_sql, sessions_sql, slot_sql)
from clickloom.plans.event_queries import _item_ctes
from clickloom.session import fresh_path, stored
from clickloom.sources import envelopes, metrics, tables

HOUR = slot_sql('"timestamp"', 3600)


def revenue_events(spark, sf_dir, types=()):
    return enrich.with_purchase_revenue(events(spark, sf_dir, types))


_TOTALS = f"""SELECT {money_sql("CASE WHEN event_type = 'purchase' THEN event_revenue END")} AS total_revenue,
  count(*) FILTER (WHERE event_type = 'purchase') AS total_orders,
  count(DISTINCT session_id) AS total_sessions FROM rev"""


@query("kpi_totals", f"""WITH {REVENUE}, t AS ({_TOTALS})
SELECT *, {ratio_sql('total_orders', 'total_sessions')} * 100 AS conversion_rate_percent,
  {ratio_sql('total_revenue', 'total_orders')} AS average_order_value FROM t""")
def kpi_totals(spark, sf_dir):
    return kpi.kpi_totals(revenue_events(spark, sf_dir))


@query("conversion_rate", f"""WITH {REVENUE}, t AS ({_TOTALS})
SELECT {ratio_sql('total_orders', 'total_sessions')} * 100 AS conversion_rate_percent,
  CASE WHEN {ratio_sql('total_orders', 'total_sessions')} * 100 >= 3 THEN 'green'
       WHEN {ratio_sql('total_orders', 'total_sessions')} * 100 >= 1 THEN 'yellow' ELSE 'red' END AS band FROM t""")
def conversion_rate(spark, sf_dir):
    steps, lowest = ts.CONVERSION_BANDS
    return kpi.kpi_totals(revenue_events(spark, sf_dir)).select(
        "conversion_rate_percent", band(F.col("conversion_rate_percent"), steps, lowest).alias("band"))


@query("average_order_value", f"""WITH {REVENUE}
SELECT source, {money_sql('event_revenue')} AS revenue, count(*) AS orders,
  {money_sql('event_revenue')} / count(*) AS average_order_value
FROM rev WHERE event_type = 'purchase' GROUP BY source""")
def average_order_value(spark, sf_dir):
    return (revenue_events(spark, sf_dir, ("purchase",)).groupBy("source")
            .agg(money_sum(F.col("event_revenue")).alias("revenue"), F.count("*").alias("orders"))
            .withColumn("average_order_value", ratio(F.col("revenue"), F.col("orders"))))


@query("hourly_revenue", f"""WITH {REVENUE}
SELECT {HOUR} AS slot_start, {money_sql('event_revenue')} AS revenue, count(*) AS orders
FROM rev WHERE event_type = 'purchase' GROUP BY 1""")
def hourly_revenue(spark, sf_dir):
    return kpi.revenue_per_slot(revenue_events(spark, sf_dir, ("purchase",)))


@query("active_users", f"""WITH {EV}
SELECT {HOUR} AS slot_start, count(DISTINCT user_id) AS active_users,
  count(DISTINCT session_id) AS active_sessions FROM ev GROUP BY 1""")
def active_users(spark, sf_dir):
    return kpi.active_per_slot(events(spark, sf_dir))


@query("top_categories", f"""WITH {ENR}
SELECT category, count(*) AS views FROM enr WHERE event_type = 'product_view' AND category IS NOT NULL
GROUP BY category ORDER BY views DESC, category LIMIT 5""")
def top_categories(spark, sf_dir):
    views = enrich.join_products(events(spark, sf_dir, ("click",)), tables.products(spark, sf_dir))
    return kpi.top_categories(views)


@query("top_categories_daily", f"""WITH {ENR},
c AS (SELECT {slot_sql('"timestamp"', 86400)} AS slot_start, category, count(*) AS views FROM enr
  WHERE event_type = 'product_view' AND category IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY slot_start ORDER BY views DESC, category) AS rank FROM c)
SELECT * FROM r WHERE rank <= 5""")
def top_categories_daily(spark, sf_dir):
    views = enrich.join_products(events(spark, sf_dir, ("click",)), tables.products(spark, sf_dir))
    counts = (views.where((F.col("event_type") == "product_view") & F.col("category").isNotNull())
              .groupBy(slot_start(F.col("timestamp"), "1 day").alias("slot_start"), "category")
              .agg(F.count("*").alias("views")))
    return kpi.top_per_slot(counts, "slot_start", "views", "category", 5)


@query("traffic_sources", f"WITH {EV} SELECT source, count(DISTINCT session_id) AS sessions FROM ev GROUP BY 1")
def traffic_sources(spark, sf_dir):
    return kpi.sessions_by_source(events(spark, sf_dir))


@query("cart_abandonment", f"""WITH {ENR} {sessions_sql(21600)}, t AS (
SELECT count(*) FILTER (WHERE has_cart_activity) AS cart_sessions,
  count(*) FILTER (WHERE abandoned_cart) AS abandoned_sessions FROM sessions)
SELECT *, {ratio_sql('abandoned_sessions', 'cart_sessions')} * 100 AS abandonment_percent FROM t""")
def cart_abandonment(spark, sf_dir):
    rows = revenue_events(spark, sf_dir).withColumn("customer_segment", F.lit(None).cast("string"))
    return kpi.cart_abandonment(sessions.session_metrics(rows, "6 hours"))


@query("cart_abandonment_rate", f"""WITH {ENR} {sessions_sql(21600)},
hourly AS (SELECT {slot_sql('session_end', 3600)} AS ts, count(*) AS n FROM sessions WHERE abandoned_cart GROUP BY 1),
samples AS (SELECT ts, CAST(sum(n) OVER (PARTITION BY epoch_us(ts) // 604800000000 ORDER BY ts ROWS UNBOUNDED PRECEDING)
  AS DOUBLE) AS value FROM hourly),
steps AS (SELECT *, lag(value) OVER (ORDER BY ts) AS before FROM samples),
gains AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS gain FROM steps)
SELECT {slot_sql('ts', 21600)} AS window_start, sum(gain) AS increase, sum(gain) / CAST(21600 AS DOUBLE) * 100 AS abandonment_rate
FROM gains GROUP BY 1""")
def cart_abandonment_rate(spark, sf_dir):
    """The dashboard's own panel: the rate per second of the abandonment counter, times 100."""
    rows = revenue_events(spark, sf_dir).withColumn("customer_segment", F.lit(None).cast("string"))
    counter = ts.with_series(metrics.abandonment_counter(sessions.session_metrics(rows, "6 hours")))
    return ts.counter_rate(counter, "6 hours").select("window_start", "increase",
                                                     (F.col("per_second") * 100).alias("abandonment_rate"))


@query("event_rate", f"""WITH {EV}
SELECT {slot_sql('"timestamp"', 300)} AS slot_start, count(*) AS events,
  count(*) / CAST(300 AS DOUBLE) AS events_per_second, count(*) * 60 / CAST(300 AS DOUBLE) AS events_per_minute
FROM ev GROUP BY 1""")
def event_rate(spark, sf_dir):
    return kpi.event_rate(events(spark, sf_dir))


@query("error_rate", f"""WITH {EV}
SELECT {HOUR} AS slot_start, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS errors,
  {ratio_sql("count(*) FILTER (WHERE event_type = 'error')", 'count(*)')} AS error_rate FROM ev GROUP BY 1""")
def error_rate(spark, sf_dir):
    return kpi.error_rate(events(spark, sf_dir))


@query("event_mix", f"""WITH {EV}, c AS (SELECT event_type, count(*) AS events FROM ev GROUP BY 1)
SELECT event_type, events, {ratio_sql('events', 'sum(events) OVER ()')} * 100 AS share_percent FROM c""")
def event_mix(spark, sf_dir):
    return kpi.event_mix(events(spark, sf_dir))


def _quantile_sql(source, keys, q):
    """``source`` has keys, le and cumulative."""
    on = " AND ".join(f"m.{k} = p.{k}" for k in keys)
    part = ", ".join(keys)
    return f"""
pos AS (SELECT *, coalesce(lag(le) OVER w, 0) AS lower_le, coalesce(lag(cumulative) OVER w, 0) AS below,
  CAST({q} AS DOUBLE) * max(cumulative) OVER (PARTITION BY {part}) AS target FROM {source}
  WINDOW w AS (PARTITION BY {part} ORDER BY le)),
hit AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY le) AS nth FROM pos
  WHERE cumulative >= target AND target > 0),
q AS (SELECT {part}, CASE WHEN isinf(le) THEN lower_le ELSE lower_le + (le - lower_le)
    * ((target - below) / CAST(cumulative - below AS DOUBLE)) END AS quantile_value FROM hit WHERE nth = 1)"""


_BOUNDS = ", ".join(f"CAST({b} AS DOUBLE)" for b in ts.LATENCY_BOUNDS) + ", CAST('inf' AS DOUBLE)"
_HISTOGRAM = f"""
delays AS (SELECT event_type,
  CAST(epoch_us(kafka_timestamp) // 1000 - epoch_us("timestamp") // 1000 AS DOUBLE) / 1000 AS seconds FROM ev),
bounds AS (SELECT UNNEST([{_BOUNDS}]) AS le),
hist AS (SELECT event_type, le, count(*) FILTER (WHERE seconds <= le) AS cumulative
  FROM delays, bounds GROUP BY event_type, le)"""


def _delay_histogram(spark, sf_dir):
    delay = (F.unix_millis("kafka_timestamp") - F.unix_millis("timestamp")) / F.lit(1000.0)
    return ts.histogram(events(spark, sf_dir), delay, ["event_type"], ts.LATENCY_BOUNDS)


@query("latency_histogram", f"""WITH {EV}, {_HISTOGRAM}
SELECT event_type, CAST(le AS VARCHAR) AS le, cumulative FROM hist""")
def latency_histogram(spark, sf_dir):
    rows = _delay_histogram(spark, sf_dir)
    le = F.col("le")
    return rows.withColumn("le", F.when(le == float("inf"), "inf").otherwise(le.cast("string")))


@query("latency_quantiles", f"""WITH {EV}, {_HISTOGRAM}, {_quantile_sql('hist', ['event_type'], 0.95)},
p95 AS (SELECT event_type, quantile_value * 1000 AS p95_ms FROM q)
SELECT * FROM p95""")
def latency_quantiles(spark, sf_dir):
    found = ts.histogram_quantile(_delay_histogram(spark, sf_dir), ["event_type"], 0.95)
    return found.select("event_type", (F.col("quantile_value") * 1000).alias("p95_ms"))


@query("histogram_quantile", f"""WITH {EV}, {_HISTOGRAM}, {_quantile_sql('hist', ['event_type'], 0.5)}
SELECT event_type, quantile_value FROM q""")
def histogram_quantile(spark, sf_dir):
    return ts.histogram_quantile(_delay_histogram(spark, sf_dir), ["event_type"], 0.5)


_COUNTERS = f"""
hourly AS (SELECT event_type, source, {HOUR} AS ts, count(*) AS n FROM ev GROUP BY ALL),
samples AS (SELECT event_type, source, ts, CAST(sum(n) OVER (PARTITION BY event_type, source,
  epoch_us(ts) // 604800000000 ORDER BY ts ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value FROM hourly),
steps AS (SELECT *, lag(value) OVER (PARTITION BY event_type, source ORDER BY ts) AS before FROM samples),
gains AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END
  AS gain FROM steps),
increase AS (SELECT event_type, source, {slot_sql('ts', 21600)} AS window_start, sum(gain) AS increase
  FROM gains GROUP BY ALL)"""


def _counters(spark, sf_dir):
    return ts.with_series(metrics.event_counters(events(spark, sf_dir)))


@query("counter_samples", f"""WITH {EV}, {_COUNTERS} SELECT event_type, source, ts, value FROM samples""")
def counter_samples(spark, sf_dir):
    return metrics.event_counters(events(spark, sf_dir)).select(
        F.col("labels")["event_type"].alias("event_type"), F.col("labels")["source"].alias("source"), "ts", "value")


@query("counter_increase", f"""WITH {EV}, {_COUNTERS}
SELECT 'events_total' AS metric, '{{"event_type":"' || event_type || '","source":"' || source || '"}}' AS series,
  window_start, increase FROM increase""")
def counter_increase(spark, sf_dir):
    return ts.counter_increase(_counters(spark, sf_dir), "6 hours")


@query("counter_rate", f"""WITH {EV}, {_COUNTERS}
SELECT event_type, window_start, sum(increase) / CAST(21600 AS DOUBLE) AS per_second
FROM increase GROUP BY ALL""")
def counter_rate(spark, sf_dir):
    # counters hold whole numbers: the sum of increases is exact, the division comes last
    grown = ts.sum_by(ts.counter_increase(_counters(spark, sf_dir), "6 hours"), ["event_type"],
                      "increase", ["window_start"])
    return grown.select("event_type", "window_start",
                        (F.col("increase") / F.lit(21600.0)).alias("per_second"))


@query("top_series", f"""WITH {EV}, {_COUNTERS},
s AS (SELECT window_start, event_type, sum(increase) AS increase FROM increase GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY increase DESC, event_type) AS rank FROM s)
SELECT * FROM r WHERE rank <= 3""")
def top_series(spark, sf_dir):
    grown = ts.sum_by(ts.counter_increase(_counters(spark, sf_dir), "6 hours"), ["event_type"],
                      "increase", ["window_start"])
    return kpi.top_per_slot(grown, "window_start", "increase", "event_type", 3)


_GAUGES = f"""
gauges AS (SELECT user_no % 24 AS part, {HOUR} AS ts,
  CAST(max(epoch_us(kafka_timestamp) // 1000 - epoch_us("timestamp") // 1000) AS DOUBLE) AS value FROM ev GROUP BY ALL)"""


def _gauges(spark, sf_dir):
    return ts.with_series(metrics.lag_gauges(events(spark, sf_dir)))


@query("gauge_last", f"""WITH {EV}, {_GAUGES}
SELECT CAST(part AS VARCHAR) AS "partition", arg_max(value, ts) AS value, max(ts) AS ts FROM gauges GROUP BY 1""")
def gauge_last(spark, sf_dir):
    return ts.gauge_last(_gauges(spark, sf_dir)).select(ts.label("partition").alias("partition"), "value", "ts")


@query("series_stats", f"""WITH {EV}, {_GAUGES},
l AS (SELECT part, arg_max(value, ts) AS value FROM gauges GROUP BY 1)
SELECT 'processing_delay_ms' AS metric, avg(value) * CAST(100 AS DOUBLE) AS mean_value, count(*) AS series_count FROM l""")
def series_stats(spark, sf_dir):
    return ts.series_stats(ts.gauge_last(_gauges(spark, sf_dir)), 100.0)


@query("label_values", f"""WITH {EV} SELECT DISTINCT 'prod' AS label_value FROM ev WHERE NOT no_metadata""")
def label_values(spark, sf_dir):
    return kpi.label_values(events(spark, sf_dir), F.col("metadata")["environment"])


@query("category_values", """SELECT DISTINCT p_type AS label_value FROM part""")
def category_values(spark, sf_dir):
    return kpi.label_values(tables.products(spark, sf_dir), F.col("category"))


@query("threshold_bands", f"""WITH {EV}, r AS (SELECT {HOUR} AS slot_start,
  {ratio_sql("count(*) FILTER (WHERE event_type = 'error')", 'count(*)')} AS error_rate FROM ev GROUP BY 1)
SELECT slot_start, error_rate, CASE WHEN error_rate >= CAST(0.05 AS DOUBLE) THEN 'red'
  WHEN error_rate >= CAST(0.01 AS DOUBLE) THEN 'yellow' ELSE 'green' END AS band FROM r""")
def threshold_bands(spark, sf_dir):
    steps, lowest = ts.ERROR_RATE_BANDS
    return kpi.error_rate(events(spark, sf_dir)).select(
        "slot_start", "error_rate", band(F.col("error_rate"), steps, lowest).alias("band"))


@query("sustained_alerts", f"""WITH {EV},
r AS (SELECT source, {HOUR} AS slot_start,
  {ratio_sql("count(*) FILTER (WHERE event_type = 'error')", 'count(*)')} AS error_rate FROM ev GROUP BY ALL),
b AS (SELECT *, epoch_us(slot_start) // 3600000000 - row_number() OVER (PARTITION BY source ORDER BY slot_start)
  AS run FROM r WHERE error_rate > CAST(0.1 AS DOUBLE))
SELECT source, min(slot_start) AS started_at, max(slot_start) AS last_breach, count(*) AS windows,
  min(slot_start) + INTERVAL 2 HOUR AS fired_at FROM b GROUP BY source, run
HAVING max(slot_start) - min(slot_start) >= INTERVAL 2 HOUR""")
def sustained_alerts(spark, sf_dir):
    rates = (events(spark, sf_dir)
             .groupBy("source", slot_start(F.col("timestamp"), "1 hour").alias("slot_start"))
             .agg(ratio(F.count_if(F.col("event_type") == "error"), F.count("*")).alias("error_rate")))
    return ts.sustained(rates, ["source"], ts.rule_breach("HighErrorRate", F.col("error_rate")),
                        "1 hour", "2 hours")


# ---- insights --------------------------------------------------------------------------------

@query("anomaly_windows", f"""WITH {EV},
k AS (SELECT event_type, {HOUR} AS slot_start, count(*) AS n FROM ev GROUP BY ALL),
g AS (SELECT unnest(generate_series(min(slot_start), max(slot_start), INTERVAL 1 HOUR)) AS slot_start FROM k),
c AS (SELECT event_type, slot_start, coalesce(k.n, 0) AS events
  FROM (SELECT * FROM g, (SELECT DISTINCT event_type FROM k)) LEFT JOIN k USING (event_type, slot_start)),
w AS (SELECT *, count(*) OVER b AS n, sum(events) OVER b AS s, sum(events * events) OVER b AS s2 FROM c
  WINDOW b AS (PARTITION BY event_type ORDER BY slot_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)),
d AS (SELECT *, CAST(s AS DOUBLE) / nullif(n, 0) AS mean,
  CASE WHEN n >= 3 THEN sqrt(CAST(n * s2 - s * s AS DOUBLE) / (n * (n - 1))) END AS spread FROM w),
z AS (SELECT event_type, slot_start, events, (events - mean) / nullif(spread, 0) AS z_score FROM d)
SELECT event_type, slot_start, events, round(z_score, 6) AS z_score, coalesce(abs(z_score) > 3, FALSE) AS is_anomaly FROM z""")
def anomaly_windows(spark, sf_dir):
    return insights.anomaly_windows(events(spark, sf_dir)).withColumn("z_score", F.round("z_score", 6))


@query("revenue_vs_previous", f"""WITH {REVENUE},
d AS (SELECT CAST("timestamp" AS DATE) AS day, {money_sql('event_revenue')} AS revenue FROM rev GROUP BY 1),
p AS (SELECT *, lag(revenue) OVER (ORDER BY day) AS previous_revenue FROM d)
SELECT *, (revenue - previous_revenue) / nullif(previous_revenue, 0) AS growth FROM p""")
def revenue_vs_previous(spark, sf_dir):
    return insights.revenue_vs_previous(revenue_events(spark, sf_dir))


def _order_events(spark, sf_dir):
    return tables.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"), F.lit("purchase").alias("event_type"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_totalprice").alias("event_revenue"), F.col("o_totalprice").alias("amount"))


@query("customer_ltv", f"""WITH u AS (SELECT o_custkey, min(o_orderdate) AS f,
  sum(CAST(o_totalprice AS DECIMAL(18,4))) AS spent FROM orders GROUP BY 1)
SELECT strftime(f, '%Y-%m') AS cohort, count(*) AS users, CAST(sum(spent) AS DOUBLE) AS revenue,
  CAST(sum(spent) AS DOUBLE) / count(*) AS lifetime_value FROM u GROUP BY 1""")
def customer_ltv(spark, sf_dir):
    return insights.customer_ltv(_order_events(spark, sf_dir))


@query("geo_revenue", f"""WITH {ENR}
SELECT location, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
  {money_sql("CASE WHEN event_type = 'purchase' THEN event_revenue ELSE 0 END")} AS revenue FROM enr GROUP BY 1""")
def geo_revenue(spark, sf_dir):
    placed = enrich.join_profiles(revenue_events(spark, sf_dir), tables.profiles(spark, sf_dir, totals=False))
    return insights.geo_revenue(placed)


def _fifth_sql(column, name, order):
    return f"""CAST(ceil(5 * CAST(count(*) OVER (ORDER BY {column} {order} RANGE UNBOUNDED PRECEDING) AS DOUBLE)
    / count(*) OVER ()) AS BIGINT) AS {name}"""


@query("rfm_segments", f"""WITH u AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id,
  date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-01') AS recency_days, count(*) AS frequency,
  CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,4)))) AS BIGINT) AS monetary FROM orders GROUP BY o_custkey),
s AS (SELECT *, {_fifth_sql('recency_days', 'r_score', 'DESC')}, {_fifth_sql('frequency', 'f_score', 'ASC')},
  {_fifth_sql('monetary', 'm_score', 'ASC')} FROM u)
SELECT *, CASE WHEN r_score + f_score + m_score >= 13 THEN 'champion' WHEN r_score + f_score + m_score >= 10
  THEN 'loyal' WHEN r_score + f_score + m_score >= 7 THEN 'potential' ELSE 'at_risk' END AS rfm_segment FROM s""")
def rfm_segments(spark, sf_dir):
    return insights.rfm_segments(_order_events(spark, sf_dir), F.lit("2002-01-01").cast("date"))


@query("journey_transitions", f"""WITH {EV},
s AS (SELECT event_type, lead(event_type) OVER (PARTITION BY session_id ORDER BY "timestamp", event_id) AS nxt FROM ev)
SELECT event_type AS from_type, nxt AS to_type, count(*) AS transitions FROM s WHERE nxt IS NOT NULL GROUP BY ALL""")
def journey_transitions(spark, sf_dir):
    return insights.journey_transitions(events(spark, sf_dir))


@query("retention_cohorts", f"""WITH {EV},
w AS (SELECT DISTINCT user_id, CAST(date_trunc('week', "timestamp") AS DATE) AS week FROM ev),
c AS (SELECT *, min(week) OVER (PARTITION BY user_id) AS cohort_week FROM w)
SELECT cohort_week, CAST(date_diff('day', cohort_week, week) // 7 AS BIGINT) AS week_offset, count(*) AS users
FROM c GROUP BY ALL""")
def retention_cohorts(spark, sf_dir):
    return insights.retention_cohorts(events(spark, sf_dir))


@query("churn_flags", f"""WITH {EV}
SELECT user_id, max("timestamp") AS last_seen, count(*) AS events,
  max("timestamp") < TIMESTAMP '2024-01-31' - INTERVAL 1 DAY AS is_churned FROM ev GROUP BY 1""")
def churn_flags(spark, sf_dir):
    return insights.churn_flags(events(spark, sf_dir), as_of(), 1)


@query("product_performance", f"""WITH {EV}, {_item_ctes()},
seen AS (SELECT product_id, count(*) FILTER (WHERE event_type = 'product_view') AS views,
  count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds FROM ev
  WHERE product_id IS NOT NULL GROUP BY 1),
sold AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, {money_sql('price * quantity')} AS revenue
  FROM items GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_retailprice AS price,
  coalesce(views, 0) AS views, coalesce(cart_adds, 0) AS cart_adds, coalesce(units, 0) AS units,
  coalesce(revenue, 0) AS revenue, {ratio_sql('coalesce(units, 0)', 'coalesce(views, 0)')} AS units_per_view
FROM part LEFT JOIN seen ON seen.product_id = CAST(p_partkey AS VARCHAR)
  LEFT JOIN sold ON sold.product_id = CAST(p_partkey AS VARCHAR)""")
def product_performance(spark, sf_dir):
    return insights.product_performance(
        events(spark, sf_dir, ("click",)), envelopes.purchase_items(tables.purchase_events(spark, sf_dir)),
        tables.products(spark, sf_dir))


@query("schema_drift", f"""WITH {EV},
keys AS (SELECT CAST("timestamp" AS DATE) AS day, event_type, UNNEST(
  CASE WHEN event_type = 'remove_from_cart' THEN ['k', 'product_id', 'quantity']
       WHEN product_id IS NOT NULL THEN ['k', 'price', 'product_id', 'quantity']
       WHEN event_type = 'purchase' THEN ['k', 'total_amount'] ELSE ['k'] END) AS key
  FROM ev WHERE NOT no_properties),
daily AS (SELECT day, event_type, key, count(*) AS "rows" FROM keys GROUP BY ALL),
known AS (SELECT DISTINCT event_type, key FROM keys WHERE event_type <> 'purchase'
  UNION SELECT 'error', 'code'),
days AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS day, event_type FROM ev)
SELECT *, 'new_key' AS drift FROM daily d WHERE NOT EXISTS (SELECT 1 FROM known k
  WHERE k.event_type = d.event_type AND k.key = d.key)
UNION ALL SELECT *, 'changed_type' FROM daily WHERE key = 'price' AND event_type = 'add_to_cart'
UNION ALL SELECT days.day, days.event_type, known.key, 0, 'missing_key' FROM days JOIN known USING (event_type)
  WHERE NOT EXISTS (SELECT 1 FROM daily d WHERE d.day = days.day AND d.event_type = days.event_type AND d.key = known.key)""")
def schema_drift(spark, sf_dir):
    rows = events(spark, sf_dir)
    listed = (rows.where(F.col("event_type") != "purchase")
              .select("event_type", F.explode(F.map_keys("properties")).alias("key")).distinct())
    # Prices of additions are listed as whole numbers, which they are not; those of views as numbers.
    listed = listed.withColumn("kind", F.when(F.col("key") != "price", "integer").when(
        F.col("event_type") == "add_to_cart", "integer").otherwise("number"))
    # a key the contract lists and nobody sends
    promised = rows.where(F.col("event_type") == "error").select(
        "event_type", F.lit("code").alias("key"), F.lit("text").alias("kind")).distinct()
    return insights.schema_drift(rows, listed.unionByName(promised))


def _profile_sql(columns):
    return "\nUNION ALL ".join(f"""SELECT '{c}' AS column_name, count(*) AS "rows",
  {ratio_sql(f'count(*) - count({c})', 'count(*)')} * 100 AS null_percent, count(DISTINCT {c}) AS distinct_values,
  min({c}) AS min_value, max({c}) AS max_value FROM enr""" for c in columns)


@query("profile_columns", f"""WITH {ENR}
{_profile_sql(['event_id', 'event_type', 'user_id', 'source', 'customer_segment', 'known_product'])}"""
       .replace("'known_product'", "'product_id'"))
def profile_columns(spark, sf_dir):
    return insights.profile_columns(
        priced_events(spark, sf_dir),
        ["event_id", "event_type", "user_id", "source", "customer_segment", "product_id"], exact=True)


_SKETCHED = ["event_id", "user_id", "product_id", "event_revenue"]


def _sketches_sql():
    texts = [f"""SELECT '{c}' AS column_name, count(*) AS "rows", {ratio_sql(f'count(*) - count({n})', 'count(*)')} * 100 AS null_percent,
  count(DISTINCT {n}) AS exact_distinct, true AS distinct_near, CAST(NULL AS BOOLEAN) AS quantiles_near,
  min({n}) AS min_value, max({n}) AS max_value FROM enr"""
             for c, n in (("event_id", "event_id"), ("user_id", "user_id"), ("product_id", "known_product"))]
    return " UNION ALL ".join([*texts, """SELECT 'event_revenue', count(*), CAST(0 AS DOUBLE), count(DISTINCT event_revenue), true,
  true, NULL, NULL FROM enr"""])


@query("daily_sketches", f"WITH {ENR} {_sketches_sql()}")
def daily_sketches(spark, sf_dir):
    """Sketches kept by day: a first run over the days before the 25th, then one day at a time, merged at the end. Distinct
    counts are within 5 % of the exact ones, the values of the quantiles within 2 % of their rank."""
    path, rows = fresh_path(spark, "sketches"), priced_events(spark, sf_dir)
    store = lambda part: warehouse.write_days(insights.daily_sketches(part, _SKETCHED, F.to_date("timestamp")), path, ["day"])
    start = lambda day: F.lit(f"2024-01-{day}").cast("timestamp")
    store(rows.where(F.col("timestamp") < start(25)))
    for day in range(25, 31):
        store(rows.where((F.col("timestamp") >= start(day)) & (F.col("timestamp") < start(day + 1))))
    store(rows.where(F.col("timestamp") >= start(31)))
    ranks = (0.5, 0.95)
    found = stored(insights.merged_profile(spark.read.parquet(path), ranks), "profile")
    values = found.where("column_name = 'event_revenue'").first()["quantiles"]
    share = lambda test: F.avg(test.cast("int"))
    inside = [share(F.col("event_revenue") < v).alias(f"below_{i}") for i, v in enumerate(values)]
    inside += [share(F.col("event_revenue") <= v).alias(f"upto_{i}") for i, v in enumerate(values)]
    shares = rows.agg(*inside).first()
    close = all(shares[f"below_{i}"] - 0.02 <= q <= shares[f"upto_{i}"] + 0.02 for i, q in enumerate(ranks))
    exact = insights.profile_columns(rows, _SKETCHED, exact=True).select("column_name", F.col("distinct_values").alias("exact_distinct"))
    near = F.abs(F.col("distinct_values") - F.col("exact_distinct")) <= F.col("exact_distinct") * 0.05
    numeric = F.col("column_name") == "event_revenue"
    return found.join(exact, "column_name").select(
        "column_name", "rows", "null_percent", "exact_distinct", near.alias("distinct_near"),
        F.when(numeric, F.lit(close)).alias("quantiles_near"),
        F.when(~numeric, F.col("min_value")).alias("min_value"), F.when(~numeric, F.col("max_value")).alias("max_value"))


@query("ip_location", f"""WITH {EV}
SELECT event_id, n_name AS country FROM ev LEFT JOIN nation ON n_nationkey = user_no % 32""")
def ip_location(spark, sf_dir):
    rows = events(spark, sf_dir)
    # an address whose first octet is the nation's number, or one that belongs to no nation
    octet = lambda c, n: (c % n).cast("string")
    address = F.concat_ws(".", octet(F.col("user_id").cast("long"), 32), octet(F.col("offset"), 256),
                          octet(F.col("offset") * 7, 256), F.lit("1"))
    nations = tables.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("country"), (F.col("n_nationkey").cast("long") * 16777216).alias("first_ip"),
        (F.col("n_nationkey").cast("long") * 16777216 + 16777215).alias("last_ip"))
    return insights.locate_ip(rows, nations, insights.ip_number(address)).select("event_id", "country")
