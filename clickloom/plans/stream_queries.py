"""Streaming twins of the windowed queries: the events table is read as a stream to its end.

Append mode emits what the last watermark (latest event less the delay, in whole
milliseconds) closed; the SQL keeps the same windows.
"""

import time

from pyspark.sql import functions as F, types as T

from clickloom import schemas
from clickloom.functions.numeric import money_sum
from clickloom.operators import enrich, sessions, windows
from clickloom.plans import event_queries  # its SQL is reused below
from clickloom.plans.catalog import ENR, EV, ORACLES, as_of, money_sql, query, sessions_sql
from clickloom.session import brief_shuffles, configure, discard, fresh_path, stored
from clickloom.sources import readers, tables
from clickloom.streaming import carts, jobs, metrics, ordered as stream_ordered, sinks


def event_stream(spark, sf_dir):
    configure(spark)
    return tables.canonical(readers.table_stream(spark, sf_dir, tables.SCHEMAS["events"], "events.parquet"))


# A file of a batch holds about so many rows.
FILE_ROWS = 1_000_000


def arrivals(rows, parts, path):
    """Write the rows of each of ``parts`` (a column ``part``), one after the other, and return how many files each has:
    the same number for all, so that a trigger of that many files is a part, whatever tasks wrote it. No row is shuffled: a task
    writes what it reads."""
    spark, most = rows.sparkSession, rows.groupBy("part").count().agg(F.max("count")).first()[0]
    files = 1 + (most or 0) // FILE_ROWS
    for done, part in enumerate(parts, 1):
        of_part = rows.where(F.col("part") == part).drop("part")
        of_part.coalesce(files).write.mode("append").option("compression", "zstd").parquet(path)
        # There may be fewer tasks, and a task without rows writes no file.
        for _ in range(files * done - len(spark.read.schema(of_part.schema).parquet(path).inputFiles())):
            of_part.limit(0).write.mode("append").parquet(path)
    return files


def event_batches(spark, sf_dir):
    """The same stream in several batches, out of order: four, one a trigger, of about a week each; every other
    event of the last half hour before a cut comes with the next one."""
    configure(spark)
    path = fresh_path(spark, "event-files")
    rows = tables.table(spark, sf_dir, "events")
    late = F.when(F.col("event_id") % 2 == 1, 1800).otherwise(0)
    since = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    numbered = rows.withColumn("part", F.least(F.lit(3), F.floor((since + late) / (8 * 86400))))
    files = arrivals(numbered, range(4), path)
    return tables.canonical(readers.table_stream(spark, path, tables.SCHEMAS["events"], files_per_trigger=files))


def priced_batches(spark, sf_dir):
    return enrich.with_segment_and_revenue(
        event_batches(spark, sf_dir), tables.profiles(spark, sf_dir, totals=False, places=False),
        tables.products(spark, sf_dir))


def priced_stream(spark, sf_dir):
    return enrich.with_segment_and_revenue(
        event_stream(spark, sf_dir), tables.profiles(spark, sf_dir, totals=False, places=False),
        tables.products(spark, sf_dir))


def _closed(batch_sql: str, end: str, delay: str, clock: str = "SELECT max(ts) FROM events") -> str:
    return f"""SELECT * FROM ({batch_sql}) AS batch
WHERE {end} <= date_trunc('milliseconds', ({clock})) - INTERVAL {delay}"""


@query("stream_realtime_metrics", _closed(ORACLES["realtime_metrics_daily"], "window_end", "10 MINUTE"))
def stream_realtime_metrics(spark, sf_dir):
    return sinks.drain(spark, metrics.realtime_metrics(priced_stream(spark, sf_dir), "1 day"), "realtime")


@query("stream_session_metrics", _closed(ORACLES["session_metrics"], "window_end", "30 MINUTE"))
def stream_session_metrics(spark, sf_dir):
    found = metrics.session_metrics(priced_stream(spark, sf_dir))
    flat = found.withColumn("window_end", F.col("session_window.end")).drop("session_window")
    return sinks.drain(spark, flat, "sessions")


@query("stream_conversion_funnel", _closed(ORACLES["conversion_funnel"], "window_end", "30 MINUTE"))
def stream_conversion_funnel(spark, sf_dir):
    return sinks.drain(spark, metrics.conversion_funnel(priced_stream(spark, sf_dir)), "funnel")


@query("stream_user_behavior", _closed(ORACLES["user_behavior"], "window_end", "30 MINUTE"))
def stream_user_behavior(spark, sf_dir):
    return sinks.drain(spark, metrics.user_behavior(priced_stream(spark, sf_dir)), "behavior")


@query("stream_alerts", f"""SELECT * FROM ({ORACLES["session_alerts"]}) AS batch
WHERE session_end + INTERVAL 6 HOUR <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 30 MINUTE""")
def stream_alerts(spark, sf_dir):
    found = metrics.session_metrics(priced_stream(spark, sf_dir), "6 hours")
    return sinks.drain(spark, sessions.session_alerts(found, as_of()), "alerts")


@query("stream_parse", ORACLES["parse_events"])
def stream_parse(spark, sf_dir):
    sent = tables.as_messages(event_stream(spark, sf_dir))
    parsed = enrich.require_fields(readers.parse_events(sent))
    p = F.col("properties")
    return sinks.drain(spark, parsed.select(
        "event_id", "event_type", "timestamp", "user_id", "session_id", "source",
        p["product_id"].alias("product_id"), p["quantity"].try_cast("int").alias("quantity"),
        F.col("metadata")["environment"].alias("environment"), "kafka_timestamp", "offset", "partition"), "parsed")


@query("stream_dedup", f"""WITH {EV} SELECT event_id, event_type, "timestamp", user_id FROM ev""")
def stream_dedup(spark, sf_dir):
    # every event arrives twice, every third one three times
    copies = F.when(F.col("offset") % 3 == 0, 3).otherwise(2)
    sent = event_stream(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    once = metrics.deduplicated(sent).select("event_id", "event_type", "timestamp", "user_id")
    return sinks.drain(spark, once, "dedup")


@query("stream_interval_join", f"""WITH {EV}, u AS (SELECT user_id, "timestamp" AS updated, event_id AS update_id
  FROM ev WHERE event_type = 'user_login')
SELECT e.event_id, e.user_id, e."timestamp", u.updated, u.update_id FROM ev e JOIN u ON u.user_id = e.user_id
  AND u.updated <= e."timestamp" AND u.updated >= e."timestamp" - INTERVAL 1 HOUR
WHERE e.event_type <> 'user_login'""")
def stream_interval_join(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "timestamp")
    updates = event_stream(spark, sf_dir).where(F.col("event_type") == "user_login").select(
        "user_id", F.col("timestamp").alias("updated"), F.col("event_id").alias("update_id"))
    joined = enrich.join_updates(rows.where(F.col("event_type") != "user_login"), updates, "user_id", "updated")
    found = joined.where(F.col("update_id").isNotNull())
    return sinks.drain(spark, found.select("event_id", "user_id", "timestamp", "updated", "update_id"), "interval")


def demo_stream(spark, sf_dir):
    configure(spark)
    return tables.as_demo(event_stream(spark, sf_dir))


_DEMO_CLOCK = """SELECT make_timestamp(epoch_us(TIMESTAMP '2024-01-01')
  + (epoch_us(max(ts)) - epoch_us(TIMESTAMP '2024-01-01')) // 1000) FROM events"""


@query("stream_demo_event_metrics",
       _closed(ORACLES["demo_event_metrics"], "window_end", "30 SECOND", _DEMO_CLOCK))
def stream_demo_event_metrics(spark, sf_dir):
    return sinks.drain(spark, metrics.demo_event_metrics(windows.with_demo_columns(demo_stream(spark, sf_dir))), "demo")


@query("stream_demo_user_behavior",
       _closed(ORACLES["demo_user_behavior"], "window_start + INTERVAL 1 MINUTE", "1 MINUTE", _DEMO_CLOCK))
def stream_demo_user_behavior(spark, sf_dir):
    return sinks.drain(spark, metrics.demo_user_behavior(windows.with_demo_columns(demo_stream(spark, sf_dir))), "demou")


@query("stream_simple_summary", _closed(ORACLES["simple_summary"], "window_end", "10 SECOND", _DEMO_CLOCK))
def stream_simple_summary(spark, sf_dir):
    return sinks.drain(spark, metrics.simple_summary(demo_stream(spark, sf_dir), "price"), "simple")


# What a stream of ordered state has taken: the seconds that the last watermark has passed.
def _passed(clock: str, delay: str = "30 MINUTE", time: str = '"timestamp"') -> str:
    return f"date_trunc('second', {time}) + INTERVAL 1 SECOND <= date_trunc('milliseconds', ({clock})) - INTERVAL {delay}"


_CART_CLOCK = f"""WITH {EV} SELECT max("timestamp") FROM ev WHERE event_type IN ('add_to_cart', 'remove_from_cart', 'purchase')"""


@query("stream_cart_totals", f"""SELECT * FROM ({ORACLES["cart_totals"]}) AS batch WHERE {_passed(_CART_CLOCK)}""")
def stream_cart_totals(spark, sf_dir):
    """Events come in several batches and out of order; the totals are those of event-time order."""
    found = carts.cart_totals(event_batches(spark, sf_dir))
    return sinks.drain(spark, found, "carts").select("event_id", "user_id", "event_type", "timestamp", "cart_total")


@query("stream_cart_items", f"""SELECT * FROM ({ORACLES["cart_items"]}) AS batch
WHERE {_passed(f'WITH {event_queries.CART_LINES} SELECT max("timestamp") FROM cart', "1 DAY")}""")
def stream_cart_items(spark, sf_dir):
    """Carts of order lines in batches of three years; every other event of the last day before a cut comes a batch late."""
    path, rows = fresh_path(spark, "cart-files"), tables.cart_events(spark, sf_dir)
    year = lambda shift: F.floor(F.year(F.col("timestamp") + F.expr(f"interval {shift}")) / 3)
    late = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    kept = fresh_path(spark, "cart-events")
    parted = rows.withColumn("part", F.when(late, year("20 hours")).otherwise(year("0 hours")))
    with brief_shuffles(spark):
        parted.write.option("compression", "zstd").parquet(kept)
    numbered = spark.read.schema(parted.schema).parquet(kept)
    files = arrivals(numbered, sorted(r[0] for r in numbered.select("part").distinct().collect()), path)
    discard(spark, kept)
    sent = readers.table_stream(spark, path, rows.schema, files_per_trigger=files)
    found = carts.cart_totals(sent, "1 day", "9000 days")
    return sinks.drain(spark, found, "carts").select("event_id", "user_id", "event_type", "timestamp", "cart_total")


_EVENT_CLOCK = "SELECT max(ts) FROM events"


@query("stream_session_sequence", f"""SELECT * FROM ({ORACLES["session_sequence"]}) AS batch WHERE {_passed(_EVENT_CLOCK)}""")
def stream_session_sequence(spark, sf_dir):
    found = stream_ordered.session_positions(event_batches(spark, sf_dir))
    return sinks.drain(spark, found, "positions").select("event_id", "session_id", "timestamp", "session_sequence")


@query("stream_session_sequences", event_queries.sequences_sql(
    1000, _passed(_EVENT_CLOCK, time="(session_end + INTERVAL 6 HOUR)")))
def stream_session_sequences(spark, sf_dir):
    """The lists of closed sessions, from events in several batches and out of order."""
    found = sinks.drain(spark, stream_ordered.session_sequences(event_batches(spark, sf_dir), "6 hours"), "lists")
    names = F.transform("event_properties", lambda m: F.coalesce(m["product_id"], F.lit("-")))
    return found.withColumn("product_sequence", names).drop("event_properties")


@query("stream_behavior_sequences", _closed(ORACLES["behavior_sequences"], "window_end", "30 MINUTE"))
def stream_behavior_sequences(spark, sf_dir):
    """The lists of finished windows, from events in several batches and out of order."""
    return sinks.drain(spark, stream_ordered.behavior_sequences(event_batches(spark, sf_dir)), "window-lists")


@query("stream_enriched_sink", f"""WITH {ENR}
SELECT event_id, event_type, "timestamp", user_id, session_id, source, customer_segment, event_revenue, data_quality_score,
  customer_value_segment, known_product AS product_id FROM enr""")
def stream_enriched_sink(spark, sf_dir):
    return _messages_of(spark, _run_job(spark, sf_dir, "enriched_events"), """event_id string, event_type string,
        timestamp timestamp, user_id string, session_id string, source string, customer_segment string, event_revenue double,
        data_quality_score double, customer_value_segment string, product_id string""")


@query("stream_enrichment_job", f"""WITH {ENR}
SELECT CAST(hour("timestamp") AS BIGINT) AS hour_of_day, count(*) AS events, count(DISTINCT user_id) AS users,
  {money_sql('event_revenue')} AS revenue FROM enr
WHERE n % 97 <> 0 AND data_quality_score > CAST(0.7 AS DOUBLE) GROUP BY 1""")
def stream_enrichment_job(spark, sf_dir):
    """Messages through the shared enrichment job into its lake table, read back."""
    sent = tables.as_messages(event_stream(spark, sf_dir))
    target = fresh_path(spark, "enrichment")
    jobs.enrichment_job_shared(sent, tables.profiles(spark, sf_dir), tables.products(spark, sf_dir), target,
                               fresh_path(spark, "enrichment-checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(f"{target}/data_lake").groupBy("hour_of_day").agg(
        F.count("*").alias("events"), F.count_distinct("user_id").alias("users"),
        money_sum(F.col("event_revenue")).alias("revenue"))


@query("stream_session_job", f"""SELECT * FROM ({ORACLES["session_metrics"]}) AS batch
WHERE window_end <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 30 MINUTE""")
def stream_session_job(spark, sf_dir):
    """Enriched messages through the job that writes sessions and alerts from one state."""
    rows = priced_stream(spark, sf_dir)
    sent = rows.select(
        F.to_json(F.struct(*[f.name for f in schemas.SESSION_EVENT.fields]), schemas.JSON_TIME).alias("value"),
        F.col("kafka_timestamp").alias("timestamp"), "offset", "partition")
    target = fresh_path(spark, "sessions")
    jobs.sessions_and_alerts(sent, target, fresh_path(spark, "sessions-checkpoint"), once=True).awaitTermination()
    found = spark.read.parquet(f"{target}/session_metrics")
    return found.withColumn("window_end", F.col("session_window.end")).drop("session_window", "run", "batch")


@query("stream_session_batches", _closed(ORACLES["session_metrics"], "window_end", "30 MINUTE"))
def stream_session_batches(spark, sf_dir):
    found = metrics.session_metrics(priced_batches(spark, sf_dir))
    flat = found.withColumn("window_end", F.col("session_window.end")).drop("session_window")
    return sinks.drain(spark, flat, "sessions")


@query("stream_dedup_batches", f"""WITH {EV} SELECT event_id, event_type, "timestamp", user_id FROM ev""")
def stream_dedup_batches(spark, sf_dir):
    """Every event comes twice: the second copies are files of their own, one batch each."""
    sent = event_batches(spark, sf_dir).union(event_batches(spark, sf_dir))
    return sinks.drain(spark, metrics.deduplicated(sent).select("event_id", "event_type", "timestamp", "user_id"), "dedup")


@query("stream_late_events", f"""WITH {EV},
d AS (SELECT date_trunc('day', "timestamp") AS window_start, event_type, "timestamp" AS t,
  n % 3 = 0 AND "timestamp" < TIMESTAMP '2024-01-20' AS is_late FROM ev),
m AS (SELECT date_trunc('milliseconds', max(t)) - INTERVAL 10 MINUTE AS last_mark, date_trunc('milliseconds',
  max(t) FILTER (NOT is_late AND t < TIMESTAMP '2024-01-20')) - INTERVAL 10 MINUTE AS first_mark FROM d)
SELECT window_start, event_type, count(*) AS events FROM d
WHERE window_start + INTERVAL 1 DAY <= (SELECT last_mark FROM m)
  AND NOT (is_late AND window_start + INTERVAL 1 DAY <= (SELECT first_mark FROM m)) GROUP BY ALL""")
def stream_late_events(spark, sf_dir):
    """Days are counted on a stream whose third file is too late for the days that the first one closed: a batch leaves
    out rows that the watermark before the last batch had passed."""
    return sinks.drain(spark, late_days(spark, sf_dir), "late")


def late_days(spark, sf_dir, seen=lambda rows: rows):
    configure(spark)
    path = fresh_path(spark, "late-files")
    rows = tables.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    late = (F.col("event_id") % 3 == 0) & early
    for part in (~late & early, ~early, late):
        rows.where(part).coalesce(1).write.mode("append").parquet(path)
    sent = seen(tables.canonical(readers.table_stream(spark, path, tables.SCHEMAS["events"], files_per_trigger=1)))
    counted = (sent.withWatermark("timestamp", "10 minutes").groupBy(F.window("timestamp", "1 day"), "event_type")
               .agg(F.count("*").alias("events")))
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "events")


@query("stream_interval_unmatched", f"""WITH {EV}, u AS (SELECT user_id, "timestamp" AS updated FROM ev WHERE event_type = 'user_login'),
m AS (SELECT least((SELECT max("timestamp") FROM ev WHERE event_type <> 'user_login'), (SELECT max(updated) FROM u)) AS mark)
SELECT e.event_id, e.user_id, e."timestamp" FROM ev e, m WHERE e.event_type <> 'user_login'
  AND e."timestamp" < mark - INTERVAL 1 DAY AND NOT EXISTS (SELECT 1 FROM u WHERE u.user_id = e.user_id
    AND u.updated <= e."timestamp" AND u.updated >= e."timestamp" - INTERVAL 1 HOUR)""")
def stream_interval_unmatched(spark, sf_dir):
    """The other half of the left join: events without an update, a day and more before the end of the stream."""
    rows = event_batches(spark, sf_dir).select("event_id", "user_id", "event_type", "timestamp")
    updates = event_batches(spark, sf_dir).where(F.col("event_type") == "user_login").select(
        "user_id", F.col("timestamp").alias("updated"), F.col("event_id").alias("update_id"))
    joined = enrich.join_updates(rows.where(F.col("event_type") != "user_login"), updates, "user_id", "updated")
    found = joined.where(F.col("update_id").isNull()).select("event_id", "user_id", "timestamp")
    drained = sinks.drain(spark, found, "unmatched")
    table = tables.canonical_events(spark, sf_dir)
    ends = table.agg(F.least(F.max(F.when(F.col("event_type") != "user_login", F.col("timestamp"))),
                             F.max(F.when(F.col("event_type") == "user_login", F.col("timestamp")))).alias("mark"))
    return drained.join(F.broadcast(ends), F.col("timestamp") < F.col("mark") - F.expr("interval 1 day")).drop("mark")


def _sent(rows, schema):
    """Events as messages with one JSON text each."""
    return rows.select(
        F.to_json(F.struct(*[f.name for f in schema.fields]), schemas.JSON_TIME).alias("value"),
        F.col("kafka_timestamp").alias("timestamp"), "offset", "partition")


def _run_job(spark, sf_dir, output):
    """Run one output of the two jobs over several batches of messages; returns its folder. The dimensions are put together
    once, not for every batch."""
    target, checkpoints = fresh_path(spark, output), fresh_path(spark, f"{output}-checkpoint")
    if output in jobs.ENRICHMENT_OUTPUTS:
        started = jobs.enrichment_job(_sent(event_batches(spark, sf_dir), schemas.RAW_EVENT),
                                      stored(tables.profiles(spark, sf_dir), "profiles"), tables.products(spark, sf_dir),
                                      target, checkpoints, True, outputs=(output,))
    else:
        started = jobs.session_job(_sent(priced_batches(spark, sf_dir), schemas.SESSION_EVENT), target, checkpoints, True,
                                   outputs=(output,))
    for running in started:
        running.awaitTermination()
    return f"{target}/{output}"


def _messages_of(spark, folder, schema):
    return spark.read.text(folder).select(F.inline(readers.parsed_once(F.col("value"), _struct(schema))))


def _struct(text):
    return T.StructType.fromDDL(text)


@query("stream_metrics_sink", _closed(ORACLES["realtime_metrics"], "window_end", "10 MINUTE"))
def stream_metrics_sink(spark, sf_dir):
    return _messages_of(spark, _run_job(spark, sf_dir, "realtime_metrics"), """window_start timestamp, window_end timestamp,
        event_type string, source string, customer_segment string, event_count long, unique_users long,
        unique_sessions long, total_revenue double, avg_quality_score double""")


@query("stream_issues_sink", f"""WITH {ENR}
SELECT event_id, user_id, event_type, "timestamp", data_quality_score, 'LOW_QUALITY_SCORE' AS issue_type
FROM enr WHERE NOT data_quality_score > CAST(0.7 AS DOUBLE)""")
def stream_issues_sink(spark, sf_dir):
    return _messages_of(spark, _run_job(spark, sf_dir, "quality_issues"), """event_id string, user_id string,
        event_type string, timestamp timestamp, data_quality_score double, issue_type string""")


@query("stream_lake_table", f"""WITH {ENR}
SELECT CAST("timestamp" AS DATE) AS processing_date, count(*) AS events, {money_sql('event_revenue')} AS revenue
FROM enr WHERE data_quality_score > CAST(0.7 AS DOUBLE) GROUP BY 1""")
def stream_lake_table(spark, sf_dir):
    """The lake table as its own stream writes it: by event day, in several batches."""
    lake = spark.read.parquet(_run_job(spark, sf_dir, "data_lake"))
    return lake.groupBy(F.to_date("timestamp").alias("processing_date")).agg(
        F.count("*").alias("events"), money_sum(F.col("event_revenue")).alias("revenue"))


@query("stream_funnel_sink", _closed(ORACLES["conversion_funnel"], "window_end", "30 MINUTE"))
def stream_funnel_sink(spark, sf_dir):
    return _messages_of(spark, _run_job(spark, sf_dir, "conversion_funnel"), """window_start timestamp,
        window_end timestamp, source string, customer_segment string, sessions_with_pageview long,
        sessions_with_product_view long, sessions_with_add_to_cart long, sessions_with_purchase long,
        total_revenue double, product_view_rate double, add_to_cart_rate double, conversion_rate double,
        overall_conversion_rate double""")


@query("stream_behavior_table", _closed(ORACLES["user_behavior"], "window_end", "30 MINUTE"))
def stream_behavior_table(spark, sf_dir):
    """The behaviour table by segment; users without a profile are in its null partition."""
    return spark.read.parquet(_run_job(spark, sf_dir, "user_behavior"))


@query("stream_alerts_sink", f"""SELECT session_id, user_id, session_start, session_end, session_revenue, abandoned_cart, alert_type
FROM ({ORACLES["session_alerts"].replace(sessions_sql(21600), sessions_sql(1800))}) AS batch
WHERE session_end + INTERVAL 30 MINUTE <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 30 MINUTE""")
def stream_alerts_sink(spark, sf_dir):
    return _messages_of(spark, _run_job(spark, sf_dir, "session_alerts"), """session_id string, user_id string,
        session_start timestamp, session_end timestamp, session_revenue double, abandoned_cart boolean, alert_type string""")


def _windows_stream(spark, sf_dir, name, found, mode):
    """A windowed stream over several batches in update or complete mode, through the sink that numbers its batches."""
    path = fresh_path(spark, name)
    sinks.write_each(found, name, fresh_path(spark, f"{name}-checkpoint"),
                     lambda batch, stamp: sinks.replace_batch(batch, path, stamp), True, mode).awaitTermination()
    return sinks.batches(spark, path)


@query("stream_update_mode", f"""SELECT window_start, window_end, event_type, "count", total_value
FROM ({ORACLES["simple_summary"]}) AS batch""")
def stream_update_mode(spark, sf_dir):
    """Update mode: every batch writes the windows it changed, the latest value of each counts. Open windows are there."""
    found = metrics.simple_summary(tables.as_demo(event_batches(spark, sf_dir)), "price", exact=False)
    rows = _windows_stream(spark, sf_dir, "update", found.drop("unique_users"), "update")
    return sinks.latest_values(rows, ["window_start", "window_end", "event_type"])


@query("stream_complete_mode", f"""SELECT window_start, window_end, event_type, source, event_count, total_value, avg_price
FROM ({ORACLES["demo_event_metrics"]}) AS batch""")
def stream_complete_mode(spark, sf_dir):
    """Complete mode: every batch writes the whole result, the last one counts."""
    dressed = windows.with_demo_columns(tables.as_demo(event_batches(spark, sf_dir)))
    found = metrics.demo_event_metrics(dressed, exact=False).drop("unique_users")
    return sinks.last_batch(_windows_stream(spark, sf_dir, "complete", found, "complete"))


@query("stream_late_accounting", f"""WITH {EV},
d AS (SELECT date_trunc('day', "timestamp") AS day, event_type, "timestamp" AS t,
  n % 3 = 0 AND "timestamp" < TIMESTAMP '2024-01-20' AS is_late FROM ev),
p AS (SELECT *, CASE WHEN is_late THEN 2 WHEN t < TIMESTAMP '2024-01-20' THEN 0 ELSE 1 END AS part FROM d),
m AS (SELECT date_trunc('milliseconds', max(t) FILTER (part = 0)) - INTERVAL 10 MINUTE AS mark FROM p)
SELECT CAST(part AS BIGINT) AS batch, count(*) AS input_rows, CAST(max(CAST(t AS DATE)) AS VARCHAR) AS last_day,
  count(DISTINCT day || event_type) FILTER (part = 2 AND day + INTERVAL 1 DAY <= (SELECT mark FROM m)) AS late_groups
FROM p GROUP BY part""")
def stream_late_accounting(spark, sf_dir):
    """What the stream of ``stream_late_events`` read and dropped in each batch, from the progress log."""
    log = fresh_path(spark, "progress")
    listener = sinks.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        last = F.max(F.to_date("timestamp").cast("string")).alias("last_day")
        running = sinks.started(late_days(spark, sf_dir, lambda rows: rows.observe("read", last)), "late",
                                fresh_path(spark, "late"), fresh_path(spark, "late-checkpoint"))
        sinks.wait_logged(spark, log, running)
    finally:
        spark.streams.removeListener(listener)
    rows = sinks.progress(spark, log).where((F.col("run") == str(running.runId)) & (F.col("input_rows") > 0))
    return rows.select("batch", "input_rows", F.col("observed")["read"]["last_day"].alias("last_day"), "late_groups")


@query("stream_compacted_lake", f"""WITH {ENR}
SELECT event_id, CAST("timestamp" AS DATE) AS event_date, event_revenue FROM enr""")
def stream_compacted_lake(spark, sf_dir):
    """A lake table written batch by batch, compacted after two batches and again at the end; what later batches and the
    last, unfinished one hold is read beside it."""
    path, check = fresh_path(spark, "lake"), fresh_path(spark, "lake-checkpoint")
    rows = priced_batches(spark, sf_dir).select("event_id", F.to_date("timestamp").alias("event_date"), "event_revenue")

    def outputs(batch, stamp):
        sinks.replace_batch(batch, path, stamp, ("event_date",))
        if stamp[1] == 2:
            sinks.compact(spark, path, ["event_date"])
            sinks.clean(spark, path, ["event_date"])
    sinks.write_each(rows, "data_lake", check, outputs, once=True).awaitTermination()
    sinks.compact(spark, path, ["event_date"])
    return sinks.batches(spark, path).drop("run", "batch")


@query("stream_restart", ORACLES["parse_events"])
def stream_restart(spark, sf_dir):
    """Message files, one a trigger, through a stream that is stopped in mid-run and resumed from its checkpoint."""
    configure(spark)
    path, target, check = (fresh_path(spark, n) for n in ("message-files", "parsed", "parsed-checkpoint"))
    sent = tables.messages(spark, sf_dir)
    for part in range(6):
        sent.where(F.pmod(F.col("offset"), F.lit(6)) == part).coalesce(1).write.mode("append").options(**schemas.JSON_TIME).json(path)
    p = F.col("properties")

    def start(**trigger):
        parsed = enrich.require_fields(readers.parse_events(readers.message_stream(spark, path, 1))).select(
            "event_id", "event_type", "timestamp", "user_id", "session_id", "source",
            p["product_id"].alias("product_id"), p["quantity"].try_cast("int").alias("quantity"),
            F.col("metadata")["environment"].alias("environment"), "kafka_timestamp", "offset", "partition")
        return (parsed.writeStream.format("parquet").option("path", target).option("checkpointLocation", check)
                .trigger(**trigger).start())
    running = start(processingTime="0 seconds")
    while running.isActive and (running.lastProgress is None or running.lastProgress["batchId"] < 1):
        time.sleep(0.05)
    running.stop()
    start(availableNow=True).awaitTermination()
    return spark.read.parquet(target)
