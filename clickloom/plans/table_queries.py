"""Queries that write a table to the shared folder, change it there and read it back."""

from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import privacy, snapshots, warehouse
from clickloom.plans import flows
from clickloom.plans.catalog import (ENR, EV, as_of, events, money_sql, priced_events, query, ratio_sql,
                                     sessions_sql)
from clickloom.plans.operations_queries import _UPSERT_STAGED
from clickloom.session import fresh_path
from clickloom.sources import readers, tables

DAY = ["event_date"]


@query("lake_day_scan", f"""WITH {EV}
SELECT event_id, event_type, user_id, CAST(hour("timestamp") AS BIGINT) AS hour_of_day FROM ev
WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15'""")
def lake_day_scan(spark, sf_dir):
    path = fresh_path(spark, "lake")
    rows = events(spark, sf_dir).withColumns({
        "processing_date": F.to_date("timestamp"), "hour_of_day": F.hour("timestamp")})
    warehouse.write_days(rows, path, ["processing_date"])
    return readers.lake_day(spark, path, "2024-01-15").select("event_id", "event_type", "user_id", "hour_of_day")


@query("hour_layout_scan", f"""WITH {EV}
SELECT event_id, "timestamp" FROM ev WHERE "timestamp" >= TIMESTAMP '2024-01-10 06:00:00'
  AND "timestamp" < TIMESTAMP '2024-01-11 18:00:00'""")
def hour_layout_scan(spark, sf_dir):
    path = fresh_path(spark, "hours")
    rows = readers.with_hour_layout(events(spark, sf_dir).select("event_id", "timestamp"))
    warehouse.write_days(rows, path, ["year", "month", "day", "hour"])
    bound = lambda text: F.lit(text).cast("timestamp")
    found = spark.read.parquet(path).where(readers.hour_range(
        bound("2024-01-10 06:00:00"), bound("2024-01-11 18:00:00")))
    return found.select("event_id", "timestamp")


@query("json_sink_round_trip", f"""WITH {ENR}
SELECT event_id, event_type, "timestamp", user_id, session_id, source, customer_segment, event_revenue FROM enr""")
def json_sink_round_trip(spark, sf_dir):
    path = fresh_path(spark, "messages")
    rows = priced_events(spark, sf_dir).select(*[f.name for f in schemas.SESSION_EVENT.fields])
    readers.to_message_json(rows).write.text(path)
    sent = spark.read.text(path).select("value", F.lit(None).cast("timestamp").alias("timestamp"),
                                        F.lit(0).alias("offset"), F.lit(0).alias("partition"))
    return readers.parse_events(sent, schemas.SESSION_EVENT).select(
        "event_id", "event_type", "timestamp", "user_id", "session_id", "source", "customer_segment", "event_revenue")


@query("warehouse_table", f"""WITH {ENR}, {_UPSERT_STAGED}
SELECT CAST(t."timestamp" AS DATE) AS event_date, t.event_id,
  CASE WHEN s.event_id IS NULL THEN t.customer_segment ELSE s.customer_segment END AS customer_segment,
  CASE WHEN s.event_id IS NULL THEN t.event_revenue ELSE s.event_revenue END AS event_revenue
FROM target t LEFT JOIN staged s ON s.event_id = t.event_id
UNION ALL SELECT CAST("timestamp" AS DATE), event_id, customer_segment, event_revenue FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.event_id = s.event_id)""")
def warehouse_table(spark, sf_dir):
    path = fresh_path(spark, "events")
    rows = priced_events(spark, sf_dir).select(
        "event_id", "event_type", "timestamp", "user_id", "properties", "customer_segment", "event_revenue",
        "offset", F.to_date("timestamp").alias("event_date"))
    cut = lambda day: F.lit(day).cast("timestamp")
    target = rows.where(F.col("timestamp") < cut("2024-01-25")).drop("offset")
    snapshots.create(spark, path, target.withColumn("updated_at", F.lit(None).cast("timestamp")), DAY, ["event_id"])
    later = rows.where(F.col("timestamp") >= cut("2024-01-20"))
    staging = later.withColumns({
        "customer_segment": F.when(F.col("offset") % 5 == 0, "VIP").otherwise(F.col("customer_segment")),
        "event_revenue": F.col("event_revenue") + 1}).drop("offset")
    snapshots.upsert(spark, path, staging, as_of())
    return snapshots.read(spark, path).select("event_date", "event_id", "customer_segment", "event_revenue")


@query("erase_from_table", f"""WITH {EV}
SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS events, count(DISTINCT user_id) AS users FROM ev
WHERE user_no % 10 <> 8 GROUP BY 1""")
def erase_from_table(spark, sf_dir):
    path = fresh_path(spark, "events")
    rows = events(spark, sf_dir).select("event_id", "user_id", F.to_date("timestamp").alias("event_date"))
    snapshots.create(spark, path, rows, DAY, ["event_id"])
    gone = rows.where(F.col("user_id").endswith("8")).select("user_id").distinct()
    privacy.erase_from_table(spark, path, gone)
    return snapshots.read(spark, path).groupBy("event_date").agg(
        F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


@query("hourly_run", f"""WITH {ENR.replace("FROM raw)", "FROM raw WHERE n % 97 <> 0 AND NOT k % 20 = 0)")} {sessions_sql(1800)},
m AS (SELECT session_id, sum(CAST(session_duration_minutes AS DECIMAL(18,4))) AS minutes FROM sessions GROUP BY 1)
SELECT CAST("timestamp" AS DATE) AS report_date, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
  {money_sql('event_revenue')} AS total_revenue,
  {ratio_sql("count(*) FILTER (WHERE event_type = 'purchase')", "count(*) FILTER (WHERE event_type = 'add_to_cart')")} AS conversion_rate,
  CAST(sum(minutes) AS DOUBLE) / count(minutes) AS avg_session_duration
FROM enr LEFT JOIN m USING (session_id) GROUP BY 1""")
def hourly_run(spark, sf_dir):
    """The whole batch flow, from raw messages to the stored daily summary."""
    root = fresh_path(spark, "house")
    flows.hourly_run(spark, tables.messages(spark, sf_dir), tables.profiles(spark, sf_dir),
                     tables.products(spark, sf_dir), root, as_of(), "40 days")
    return spark.read.parquet(f"{root}/daily_summary").select(
        "report_date", "total_events", "unique_users", "total_revenue", "conversion_rate", "avg_session_duration")


# Partition values that folder names escape, and nulls on both levels.
_PLACES = """CASE CASE WHEN no_properties THEN 0 ELSE k END % 5 WHEN 0 THEN NULL WHEN 1 THEN 'h/w:1' WHEN 2 THEN 'a b%20' ELSE 'plain' END AS place,
  CASE WHEN user_no % 4 = 0 THEN NULL ELSE 'u' || CAST(user_no % 4 AS VARCHAR) END AS part"""
_ODD = ["place", "part"]


def _odd_table(spark, sf_dir):
    k, user = F.col("properties")["k"].cast("int"), F.col("user_id").cast("int")
    rows = events(spark, sf_dir).withColumn("k", F.coalesce(k, F.lit(0))).select(
        "event_id", "user_id", "timestamp", "event_type",
        F.when(F.col("k") % 5 == 1, "h/w:1").when(F.col("k") % 5 == 2, "a b%20").when(F.col("k") % 5 != 0, "plain").alias("place"),
        F.when(user % 4 != 0, F.concat(F.lit("u"), (user % 4).cast("string"))).alias("part"))
    path = fresh_path(spark, "odd")
    snapshots.create(spark, path, rows, _ODD, ["event_id"])
    return path, rows


@query("erase_odd_partitions", f"""WITH {EV}, t AS (SELECT event_id, user_no, {_PLACES} FROM ev)
SELECT event_id, place, part FROM t WHERE user_no % 10 <> 8 AND user_no % 4 <> 1""")
def erase_odd_partitions(spark, sf_dir):
    """Erases some users everywhere and every user of some partitions."""
    path, rows = _odd_table(spark, sf_dir)
    user = F.col("user_id").cast("int")
    gone = rows.where((user % 10 == 8) | (user % 4 == 1)).select("user_id").distinct()
    privacy.erase_from_table(spark, path, gone)
    return snapshots.read(spark, path).select("event_id", "place", "part")


@query("upsert_odd_partitions", f"""WITH {EV}, t AS (SELECT event_id, n, event_type, {_PLACES} FROM ev)
SELECT event_id, place, part, CASE WHEN n % 7 = 0 AND (place IS NULL OR place <> 'plain') THEN 'changed' ELSE event_type END AS event_type FROM t
UNION ALL SELECT 'new' || event_id, place, part, event_type FROM t WHERE n % 11 = 0 AND part IS NULL""")
def upsert_odd_partitions(spark, sf_dir):
    path, rows = _odd_table(spark, sf_dir)
    number = F.col("event_id").cast("long")
    changed = rows.where((number % 7 == 0) & ~F.col("place").eqNullSafe("plain")).withColumn("event_type", F.lit("changed"))
    new = rows.where((number % 11 == 0) & F.col("part").isNull()).withColumn("event_id", F.concat(F.lit("new"), "event_id"))
    snapshots.upsert(spark, path, changed.unionByName(new), as_of(), updated=["event_type"])
    return snapshots.read(spark, path).select("event_id", "place", "part", "event_type")


@query("replace_odd_partitions", f"""WITH {EV}, t AS (SELECT event_id, n, user_id, user_no, {_PLACES} FROM ev)
SELECT event_id, user_id, place, part FROM t WHERE user_no % 6 <> 0
UNION ALL SELECT 'all', user_id, NULL, 'moved' FROM t WHERE user_no % 6 = 0 GROUP BY user_id""")
def replace_odd_partitions(spark, sf_dir):
    """All rows of some users become one row each in a new partition."""
    path, rows = _odd_table(spark, sf_dir)
    moved = rows.where(F.col("user_id").cast("int") % 6 == 0).groupBy("user_id").agg(
        F.lit("all").alias("event_id"), F.max("timestamp").alias("timestamp"), F.lit("merged").alias("event_type"),
        F.lit(None).cast("string").alias("place"), F.lit("moved").alias("part"))
    snapshots.replace_rows(spark, path, moved, ["user_id"])
    return snapshots.read(spark, path).select("event_id", "user_id", "place", "part")
