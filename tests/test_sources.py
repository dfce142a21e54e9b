"""Readers and envelopes."""

import json

from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import enrich, quality
from clickloom.sources import envelopes, readers


def payloads(spark, *bodies):
    return spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "value string")


def message_rows(spark, *bodies):
    rows = [("k", b if b is None or isinstance(b, str) else json.dumps(b), "raw", 0, i) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp"))


EVENT = {"event_id": "e1", "event_type": "purchase", "timestamp": "2024-01-01T10:00:00.123456Z", "user_id": "u",
         "session_id": "s", "source": "web", "properties": {"total_amount": 12.5, "items": [
             {"product_id": "p1", "price": 2.5, "quantity": 2}, {"product_id": "p2", "price": 7.5, "quantity": 1}],
             "referrer": None}, "metadata": {"platform": "web"}}


def test_parse_and_quarantine(spark):
    sent = message_rows(spark, EVENT, "not json", {**EVENT, "timestamp": "bad"}, {**EVENT, "user_id": None}, None, "")
    parsed = readers.parse_events(sent)
    good = enrich.require_fields(parsed).collect()
    assert [(r.event_id, r.offset) for r in good] == [("e1", 0)]
    assert good[0].timestamp.microsecond == 123456
    assert good[0].properties["total_amount"] == "12.5" and good[0].properties["referrer"] is None
    bad = quality.quarantine(sent, F.lit("2024-01-02").cast("timestamp")).orderBy("original_offset").collect()
    assert [(r.original_offset, r.error_type) for r in bad] == [
        (1, "UNPARSEABLE"), (2, "UNPARSEABLE"), (3, "MISSING_FIELD"), (4, "UNPARSEABLE"), (5, "UNPARSEABLE")]
    assert bad[1].error_message == "missing: timestamp" and bad[2].error_message == "missing: user_id"
    assert bad[0].original_value == "not json" and bad[0].retry_count == 3
    assert len(good) + len(bad) == sent.count()


def test_items(spark):
    parsed = readers.parse_events(message_rows(spark, EVENT, {**EVENT, "properties": {"order_id": "o"}}))
    rows = envelopes.purchase_items(parsed).orderBy("product_id").collect()
    assert [(r.product_id, r.price, r.quantity) for r in rows] == [(None, None, None), ("p1", 2.5, 2), ("p2", 7.5, 1)]


def test_web_envelope(spark):
    sent = payloads(spark, {"records": [{"key": "u", "value": EVENT}, {"key": "v", "value": {**EVENT, "event_id": "e2"}}]},
                    {"records": []}, "junk")
    rows = envelopes.web_events(sent).orderBy("event_id").collect()
    assert [(r.record_key, r.event_id) for r in rows] == [("u", "e1"), ("v", "e2")]


def test_mobile_envelope(spark):
    common = {"platform": "ios", "sdk_version": "1.0.0", "timestamp": 1, "product_id": "p", "event_category": "ecommerce"}
    snake = {"event_name": "product_viewed", "properties": common, "timestamp": 1704110400000, "session_id": "s", "user_id": "u"}
    camel = {"eventName": "product_viewed", "properties": common, "timestamp": 1704110400000.0, "sessionId": "s", "userId": "u"}
    other = {"eventName": "app_opened", "timestamp": 1704110400001, "sessionId": "s", "userId": None}
    rows = envelopes.mobile_events(payloads(spark, {"events": [snake, camel, other], "api_key": "k", "environment": "prod"})).collect()
    assert rows[0] == rows[1]
    first = rows[0]
    assert first.event_type == "product_view" and str(first.timestamp) == "2024-01-01 12:00:00"
    assert first.properties == {"product_id": "p", "event_category": "ecommerce"}
    assert first.metadata == {"platform": "ios", "sdk_version": "1.0.0", "environment": "prod"}
    assert rows[2].event_type == "app_opened" and rows[2].event_id != first.event_id and rows[2].user_id is None


def test_lake_layouts_prune(spark, tmp_path):
    df = spark.range(48).select(F.timestamp_seconds(F.col("id") * 3600 + 1704067200).alias("timestamp"), "id")
    day = f"{tmp_path}/day"
    df.withColumn("processing_date", F.to_date("timestamp")).write.partitionBy("processing_date").parquet(day)
    found = readers.lake_day(spark, day, "2024-01-02")
    assert found.count() == 24
    assert "PartitionFilters: [isnotnull(processing_date" in found._jdf.queryExecution().toString()
    hourly = f"{tmp_path}/hour"
    readers.with_hour_layout(df).write.partitionBy("year", "month", "day", "hour").option("compression", "snappy").parquet(hourly)
    some = spark.read.parquet(hourly).where(readers.hour_range(
        F.lit("2024-01-01 22:00:00").cast("timestamp"), F.lit("2024-01-02 03:00:00").cast("timestamp")))
    assert some.count() == 5
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "DataFilters: []" in plan


def test_message_json_round_trip(spark):
    df = enrich.require_fields(readers.parse_events(message_rows(spark, EVENT)))
    text = readers.to_message_json(df).first().value
    again = readers.parse_events(message_rows(spark, text)).first()
    assert again.timestamp.microsecond == 123456 and again.properties["total_amount"] == "12.5"


def test_demo_removals_keep_their_price(spark, tmp_path):
    """A removal is classed by its price like every other demo event; carts need none on it."""
    from clickloom.plans.registered import ORACLES, QUERIES
    from tests.compare import connect, differences

    folder, rows = str(tmp_path), [(i, 1, "click", float(v), f'{{"k": {k}}}') for i, (v, k) in enumerate(
        [(300, 2), (60, 5), (10, 8), (300, 20), (300, 1), (60, 3)])]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string").selectExpr(
        "event_id", "timestamp_ntz'2024-01-02' AS ts", "user_id", "event_type", "value", "props").write.parquet(
        f"{folder}/events.parquet")
    segments = {r.event_id: r.customer_segment for r in QUERIES["demo_enriched_events"](spark, folder).collect()}
    assert segments == {"0": "premium", "1": "standard", "2": "budget", "3": "budget", "4": "premium", "5": "standard"}
    con = connect(folder)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    for name in ("demo_enriched_events", "demo_event_metrics"):
        assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) == ""
