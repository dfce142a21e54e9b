"""Jobs and sinks on small streams: late data, restarts, modes, and parity with the batch form."""

import json

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import enrich, sessions, windows
from clickloom.sources import readers, tables
from clickloom.streaming import jobs, metrics, sinks


def write_messages(spark, rows, path):
    """One JSON file of broker messages."""
    body = F.to_json(F.struct("event_id", "event_type", "timestamp", "user_id", "session_id", "source",
                              "properties", "metadata", "customer_segment", "event_revenue"), schemas.JSON_TIME)
    (rows.select(F.col("user_id").alias("key"), body.alias("value"), F.lit("t").alias("topic"),
                 F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"), F.col("timestamp"))
     .coalesce(1).write.mode("append").json(path))


def stream(spark, path, files=1):
    """A stream that reads one file per batch, in order of arrival."""
    events = readers.parse_events(readers.message_stream(spark, path, files), schemas.SESSION_EVENT)
    return enrich.require_fields(events)


def test_late_events_are_dropped(spark, make, tmp_path):
    path = f"{tmp_path}/in"
    write_messages(spark, make([{"ts": "2024-01-01 00:00:30", "event_id": "a"}, {"ts": "2024-01-01 00:20:00", "event_id": "b"}]), path)
    query_at = f"{tmp_path}/check"
    counts = metrics.demo_event_metrics(windows.with_demo_columns(
        stream(spark, path).withColumn("price", F.lit(1.0))), "1 minute", "1 minute", "10 minutes")

    def run():
        q = (counts.writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", query_at).trigger(availableNow=True).start())
        q.awaitTermination()
        return q
    run()
    # behind the watermark of 00:10; another one before 00:20 is still in time
    write_messages(spark, make([{"ts": "2024-01-01 00:00:40", "event_id": "late"}, {"ts": "2024-01-01 00:15:00", "event_id": "c"}]), path)
    second = run()
    write_messages(spark, make([{"ts": "2024-01-01 02:00:00", "event_id": "z"}]), path)
    run()
    rows = {str(r.window_start): r.event_count for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert rows == {"2024-01-01 00:00:00": 1, "2024-01-01 00:15:00": 1, "2024-01-01 00:20:00": 1}
    dropped = sum(o["numRowsDroppedByWatermark"] for p in second.recentProgress for o in p["stateOperators"])
    assert dropped == 1


def test_enrichment_job_equals_batch(spark, sf_dir, tmp_path):
    messages = tables.messages(spark, sf_dir)
    messages.coalesce(1).write.parquet(f"{tmp_path}/in")
    people, goods = tables.profiles(spark, sf_dir), tables.products(spark, sf_dir)
    sent = readers.message_stream(spark, f"{tmp_path}/in", file_format="parquet")
    target, checks = f"{tmp_path}/out", f"{tmp_path}/checks"
    for attempt in range(2):  # the second start finds nothing new and writes nothing twice
        for q in jobs.enrichment_job(sent, people, goods, target, checks, once=True):
            q.awaitTermination()
    batch = enrich.enrich(readers.parse_events(messages), people, goods)
    lake = spark.read.parquet(f"{target}/data_lake")
    assert lake.count() == batch.where("is_valid_event").count()
    assert {"processing_date", "hour_of_day"} <= set(lake.columns)
    texts = spark.read.text(f"{target}/enriched_events")
    assert texts.count() == batch.count()
    issues = spark.read.json(f"{target}/quality_issues")
    assert issues.count() == batch.where("NOT is_valid_event").count() > 0
    live = spark.read.json(f"{target}/realtime_metrics")
    whole = windows.realtime_metrics(batch)
    last = batch.agg(F.max("timestamp")).first()[0]
    closed = whole.where(F.unix_micros("window_end") <= F.unix_micros(F.lit(last)) - 600_000_000)
    columns = ["event_type", "source", "event_count", "unique_users", "unique_sessions", "total_revenue"]
    key = lambda df: sorted(map(str, df.select(F.col("window_start").cast("timestamp").alias("w"), *columns).collect()))
    assert key(live) == key(closed)


def test_shared_enrichment_writes_all_outputs(spark, sf_dir, tmp_path):
    messages = tables.messages(spark, sf_dir)
    messages.repartition(3).write.parquet(f"{tmp_path}/in")
    people, goods = tables.profiles(spark, sf_dir), tables.products(spark, sf_dir)
    sent = readers.message_stream(spark, f"{tmp_path}/in", 1, "parquet")
    jobs.enrichment_job_shared(sent, people, goods, f"{tmp_path}/out", f"{tmp_path}/checks", once=True).awaitTermination()
    read = lambda name: spark.read.parquet(f"{tmp_path}/out/{name}").count()
    assert read("enriched_events") + read("dead_letters") == messages.count()
    assert read("data_lake") + read("quality_issues") == read("enriched_events")


def test_session_job(spark, make, tmp_path):
    path = f"{tmp_path}/in"
    rows = make([
        {"ts": "2024-01-01 00:00:00", "event_type": "page_view"}, {"ts": "2024-01-01 00:10:00", "event_type": "add_to_cart"},
        {"ts": "2024-01-01 00:12:00", "event_type": "purchase", "event_revenue": 600.0, "session_id": "s2", "user_id": "u2"},
        {"ts": "2024-01-02 00:00:00", "session_id": "s3", "user_id": "u3"}])
    write_messages(spark, rows, path)
    sent = readers.message_stream(spark, path)
    target = f"{tmp_path}/out"
    for q in jobs.session_job(sent, target, f"{tmp_path}/checks", once=True):
        q.awaitTermination()
    found = {r.session_id: r for r in spark.read.json(f"{target}/session_metrics").collect()}
    assert set(found) == {"s1", "s2"}  # s3 is not over
    assert found["s1"].abandoned_cart and found["s1"].session_duration_minutes == 10.0
    alerts = {r.session_id: r.alert_type for r in spark.read.json(f"{target}/session_alerts").collect()}
    assert alerts == {"s1": "CART_ABANDONMENT", "s2": "HIGH_VALUE_SESSION"}
    funnel = spark.read.json(f"{target}/conversion_funnel")
    assert {r.metric_type for r in funnel.select("metric_type").distinct().collect()} == {"conversion_funnel"}
    first = funnel.where("window_start like '2024-01-01T00:12%'").first()
    assert first.sessions_with_purchase == 1 and first.total_revenue == 600.0
    behaviour = spark.read.parquet(f"{target}/user_behavior")
    # u1: slots 00:00 and 00:10 lie in 7 windows; u2: slot 00:10 in 6
    assert behaviour.count() == 13 and "customer_segment" in behaviour.columns
    jobs.sessions_and_alerts(sent, f"{tmp_path}/both", f"{tmp_path}/both-checks", once=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/both/session_metrics").count() == 2
    assert spark.read.parquet(f"{tmp_path}/both/session_alerts").count() == 2


def test_distinct_counts_over_several_batches(spark, make, tmp_path):
    path = f"{tmp_path}/in"
    for i in range(3):
        write_messages(spark, make([{"ts": f"2024-01-01 00:00:{10 + i}", "user_id": u, "session_id": f"{u}{i % 2}"}
                                    for u in ("u1", "u2", None)]), path)
    write_messages(spark, make([{"ts": "2024-01-01 05:00:00"}]), path)
    events = readers.parse_events(readers.message_stream(spark, path, 1), schemas.SESSION_EVENT)
    scored = events.withColumn("data_quality_score", F.lit(0.8))
    found = sinks.drain(spark, metrics.realtime_metrics(scored), "t").first()
    assert (found.event_count, found.unique_users, found.avg_quality_score) == (9, 2, 0.8)
    assert found.unique_sessions == 6


def test_complete_and_update_modes(spark, make, tmp_path):
    path = f"{tmp_path}/in"
    write_messages(spark, make([{"ts": "2024-01-01 00:00:01"}, {"ts": "2024-01-01 00:00:02", "user_id": "u2"}]), path)
    events = stream(spark, path).withColumn("price", F.lit(3.0))
    dressed = windows.with_demo_columns(events)
    for name, df, mode in (("complete_out", metrics.demo_event_metrics(dressed, exact=False), "complete"),
                           ("update_out", metrics.simple_summary(events, "price", exact=False), "update")):
        q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
             .option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start())
        q.awaitTermination()
        rows = spark.table(name).collect()
        assert len(rows) == (3 if mode == "complete" else 4) and all(r.unique_users == 2 for r in rows)


def test_interval_join_keeps_unmatched(spark, make, tmp_path):
    path, updates = f"{tmp_path}/in", f"{tmp_path}/updates"
    write_messages(spark, make([{"ts": "2024-01-01 00:30:00", "event_id": "hit"}, {"ts": "2024-01-01 03:00:00", "event_id": "miss"},
                                {"ts": "2024-01-03 00:00:00", "event_id": "end"}]), path)
    write_messages(spark, make([{"ts": "2024-01-01 00:00:00", "event_id": "up"}, {"ts": "2024-01-03 00:00:00", "event_id": "up2", "user_id": "z"}]), updates)
    right = stream(spark, updates).select("user_id", F.col("timestamp").alias("last_activity"), F.col("event_id").alias("update_id"))
    joined = enrich.join_updates(stream(spark, path), right, "user_id", "last_activity")
    found = {r.event_id: r.update_id for r in sinks.drain(spark, joined.select("event_id", "update_id"), "j").collect()}
    assert found["hit"] == "up" and found["miss"] is None


def test_broker_reader_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.broker_stream(spark, "host:9092", readers.RAW_TOPIC)


def test_cart_state_over_batches(spark, make, tmp_path):
    from clickloom.streaming import carts
    path = f"{tmp_path}/in"
    item = lambda product, price=None: {"product_id": product, "quantity": "2"} | ({"price": str(price)} if price else {})
    write_messages(spark, make([
        {"event_id": "b", "ts": "2024-01-01 00:02:00", "event_type": "add_to_cart", "properties": item("q", 5)},
        {"event_id": "a", "ts": "2024-01-01 00:01:00", "event_type": "add_to_cart", "properties": item("p", 10)},
        {"event_id": "x", "ts": "2024-01-01 00:01:00", "event_type": "add_to_cart", "properties": item("p", 1), "user_id": "u2"}]), path)
    write_messages(spark, make([
        {"event_id": "c", "ts": "2024-01-01 00:03:00", "event_type": "remove_from_cart", "properties": item("p")},
        {"event_id": "d", "ts": "2024-01-01 00:04:00", "event_type": "purchase"},
        {"event_id": "e", "ts": "2024-01-01 00:05:00", "event_type": "add_to_cart", "properties": item("p", 3)},
        {"event_id": "w", "ts": "2024-01-01 00:00:30", "event_type": "add_to_cart", "properties": {"price": "1e30"}}]), path)
    write_messages(spark, make([
        {"event_id": "z", "ts": "2024-01-01 02:00:00", "event_type": "add_to_cart", "properties": item("p", 1), "user_id": "u3"}]), path)
    found = {r.event_id: r.cart_total for r in sinks.drain(spark, carts.cart_totals(stream(spark, path)), "cart").collect()}
    # In event-time order whatever the order of arrival; a removal has the price of the addition; an amount that does not
    # fit counts as none; z is still open.
    assert found == {"w": 0.0, "a": 20.0, "b": 30.0, "c": 10.0, "d": 0.0, "e": 6.0, "x": 2.0}


def test_session_lists_of_streams(spark, make, tmp_path):
    from clickloom.streaming import ordered
    path = f"{tmp_path}/in"
    at = lambda minutes: f"2024-01-01 {minutes // 60:02d}:{minutes % 60:02d}:00"
    rows = [{"event_id": f"{m:03d}", "ts": at(m), "event_type": f"t{m}", "session_id": "s1" if m % 2 else "s2",
             "properties": {"n": str(m)}} for m in (1, 2, 3, 5, 7, 9, 11, 60, 63, 64)]
    for part in (rows[3:6] + rows[:1], rows[1:3] + rows[6:8], rows[8:]):
        write_messages(spark, make(part), path)
    write_messages(spark, make([{"ts": at(600), "session_id": "s9"}]), path)
    lists = sinks.drain(spark, ordered.session_sequences(stream(spark, path), chunk_size=4), "lists")
    batch = sessions.session_sequences(make(rows), chunk_size=4)
    key = lambda df: sorted(map(str, df.select("session_id", "user_id", "session_start", "chunk", "entries", "event_sequence",
                                               "event_properties").collect()))
    assert key(lists) == key(batch) and lists.count() == 5
    places = sinks.drain(spark, ordered.session_positions(stream(spark, path)), "places")
    found = {r.event_id: r.session_sequence for r in places.collect()}
    assert found == {f"{m:03d}": i + 1 for s in (0, 1) for i, m in enumerate(
        int(r["event_id"]) for r in rows if int(r["event_id"]) % 2 == s)}


def test_waiting_events_are_read_once():
    """One user with 100,000 waiting events: what is read and written of the state grows with the events, not with their
    square."""
    from clickloom.streaming import carts

    class State(dict):
        reads = 0

        def containsKey(self, k): return k in self
        def getValue(self, k): State.reads += len(self[k][0]) if isinstance(self[k][0], list) else 1; return self[k]
        def updateValue(self, k, v): self[k] = v
        def removeKey(self, k): del self[k]
        def exists(self): return None in self
        def get(self): return self[None]
        def update(self, v): self[None] = v
        def clear(self): dict.clear(self)

    class Handle:
        def __init__(self): self.timers = set()
        def getMapState(self, *_): return State()
        def getValueState(self, *_): return State()
        def registerTimer(self, at): self.timers.add(at)

    class Expired:
        def __init__(self, at): self.at = at
        def getExpiryTimeInMs(self): return self.at

    from pyspark.sql import Row
    n, handle, processor = 100_000, Handle(), carts.CartState(10 ** 15)
    processor.init(handle)
    events = [Row(us=1_000_000 * (i * 7919 % n) + i, event_id=str(i), event_type="add_to_cart", product=str(i % 9), units=1,
                  price=None) for i in range(n)]
    for at in range(0, n, 10_000):
        assert not list(processor.handleInputRows(("u",), iter(events[at:at + 10_000]), None))
    out = []
    for at in sorted(t for t in handle.timers):
        out += processor.handleExpiredTimer(("u",), None, Expired(at))
    assert [r.us for r in out] == sorted(e.us for e in events)
    assert State.reads < 3 * n and len(processor.waiting) == 0


def test_state_calls_are_shared_by_keys():
    """1000 sessions of a group in two batches: the state is called by chunk and page, not by event or key."""
    from pyspark.sql import Row

    from clickloom.streaming import ordered

    class State(dict):
        calls = 0

        def __getattribute__(self, name):
            State.calls += name in ("containsKey", "getValue", "updateValue", "removeKey", "keys")
            return dict.__getattribute__(self, name)

        def containsKey(self, k): return k in self
        def getValue(self, k): return self[k]
        def updateValue(self, k, v): self[k] = v
        def removeKey(self, k): del self[k]

    class Handle:
        def __init__(self): self.timers = set()
        def getMapState(self, *_): return State()
        def registerTimer(self, at): self.timers.add(at)

    class Time:
        def __init__(self, at): self.at = at
        def getExpiryTimeInMs(self): return min(handle.timers)
        def getCurrentWatermarkInMs(self): return self.at

    n, handle = 1000, Handle()
    processor = ordered.Positions(10 ** 9, ("session_id",))
    processor.init(handle)
    out = []
    for batch in range(2):
        rows = [Row(us=1_000_000 * (batch * n + i * 7 % n), event_id=str(i), session_id=str(i) if i else None) for i in range(n)]
        assert not list(processor.handleInputRows((5,), iter(rows), None))
        out += processor.handleExpiredTimer((5,), Time(1000 * n * (batch + 1)), Time(0))
    assert {(r.session_id, r.session_sequence) for r in out} == {(str(i) if i else None, b) for i in range(n) for b in (1, 2)}
    assert State.calls < n and len(processor.waiting) == 0
    # All are forgotten at the end of the idle time.
    assert not list(processor.handleExpiredTimer((5,), Time(10 ** 12), Time(0)))
    assert not processor.pages and not processor.alarms


@pytest.mark.parametrize("file_rows", [1_000_000, 40])
def test_batches_do_not_follow_the_files_of_the_table(spark, tmp_path, monkeypatch, file_rows):
    """A table in many files, some without rows of a week, comes in four batches and in nearly the order of its times."""
    from clickloom.plans import stream_queries
    monkeypatch.setattr(stream_queries, "FILE_ROWS", file_rows, raising=False)
    rows = spark.range(400).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 4320)").alias("ts"),
        (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"))
    # Of the last week there are only three events, fewer than files.
    rows.where("id < 160 or id in (170, 300, 399)").repartitionByRange(6, "ts").write.parquet(f"{tmp_path}/events.parquet")
    path, found = f"{tmp_path}/out", {}

    def outputs(batch, stamp):
        found[stamp[1]] = [r["offset"] for r in batch.select("offset").collect()]
    sinks.write_each(stream_queries.event_batches(spark, str(tmp_path)), "data_lake", f"{tmp_path}/check", outputs, True).awaitTermination()
    assert sorted(i for ids in found.values() for i in ids) == [*range(160), 170, 300, 399]
    assert sorted(found) == [0, 1, 2, 3]
    assert all(max(found[a]) < min(found[b]) for a in found for b in found if a < b and found[a] and found[b])


def test_carts_are_kept_as_packed_rows():
    """A chunk of waiting events and a page of carts are one value each; a cart goes on from its page as it was left."""
    from types import SimpleNamespace

    from pyspark.sql import Row

    from clickloom.streaming import carts

    class State(dict):
        containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.pop

    handle = SimpleNamespace(getMapState=lambda *_: State(), registerTimer=lambda at: None)
    processor = carts.CartState(10 ** 12, ("user_id",))
    processor.init(handle)
    event = lambda at, units, price: Row(event_id=str(at), us=at * 1_000_000, user_id=None, product="p", units=units, price=price,
                                         event_type="remove_from_cart" if units < 0 else "add_to_cart")
    out = []
    for at, rows in ((10, [event(2, -1, None), event(1, 2, 12_345)]), (20, [event(11, 3, 20_001)])):
        assert not list(processor.handleInputRows((1,), iter(rows), None))
        assert [type(v) for row in processor.waiting.values() for v in row] == [bytes]
        out += processor.handleExpiredTimer((1,), None, SimpleNamespace(getExpiryTimeInMs=lambda: at * 1000))
        assert [type(v) for row in processor.pages.values() for v in row] == [bytes]
    assert [(r.event_id, r.cart_total) for r in out] == [("1", 2.469), ("2", 1.2345), ("11", 8.0004)]


def test_events_come_as_texts_and_go_as_frames():
    """25,000 events of a group: what Spark hands over has one value for each event beside its time and group, and what it gets is
    three frames. Large and missing numbers and odd texts stay as they are."""
    import json
    from types import SimpleNamespace

    import pandas as pd

    from clickloom.streaming import carts, ordered

    class State(dict):
        containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.pop

    handle = SimpleNamespace(getMapState=lambda *_: State(), registerTimer=lambda at: None)
    names = ["user_id", "event_id", "event_type", "us", "cart_total"]
    processor, n = ordered.Framed(carts.CartState(10 ** 12, ("user_id",)), names), 25_000
    processor.init(handle)
    odd, large = 'a "b"\n\\\u2028\u00e9', 2 ** 53 + 1
    texts = [json.dumps({"us": i * 1_000_000 + large, "event_id": str(i), "user_id": odd if i % 2 else None, "product": None,
                         "event_type": "add_to_cart", "units": 1, "price": None if i > 1 else large}) for i in range(n)]
    frames = (pd.DataFrame({"event": texts[at:at + 1000]}) for at in range(0, n, 1000))
    assert not list(processor.handleInputRows((1,), frames, None))
    found = list(processor.handleExpiredTimer((1,), None, SimpleNamespace(getExpiryTimeInMs=lambda: 2 * large)))
    assert [len(f) for f in found] == [10_000, 10_000, 5_000] and all(list(f) == names for f in found)
    rows = [r for f in found for r in f.itertuples(index=False)]
    assert [(r.user_id, r.event_id, r.us) for r in rows] == [
        (odd if i % 2 else None, str(i), i * 1_000_000 + large) for i in range(n)]
    assert all(r.cart_total == (i // 2 + 1) * large / 10_000 for i, r in enumerate(rows))


def test_odd_values_pass_a_stream_of_carts(spark, make, tmp_path):
    from clickloom.streaming import carts
    path, odd = f"{tmp_path}/in", 'a "b"\n\\\u2028\u00e9'
    add = {"event_type": "add_to_cart"}
    write_messages(spark, make([
        add | {"event_id": odd, "ts": "2024-01-01 00:01:00", "properties": {"product_id": odd, "price": "999999999999.0001"}},
        add | {"event_id": "b", "ts": "2024-01-01 00:02:00.123456", "properties": {"product_id": odd}, "user_id": odd},
        add | {"event_id": "c", "ts": "2024-01-01 00:03:00", "properties": {"price": "0.5", "quantity": "2"}}]), path)
    write_messages(spark, make([{"event_id": "z", "ts": "2024-01-01 02:00:00", "event_type": "purchase"}]), path)
    found = sinks.drain(spark, carts.cart_totals(stream(spark, path)), "cart").collect()
    assert {(r.user_id, r.event_id, r.timestamp.microsecond, r.cart_total) for r in found} == {
        ("u1", odd, 0, 999999999999.0001), (odd, "b", 123456, 0.0), ("u1", "c", 0, 1000000000000.0001)}


def test_user_behavior_keeps_one_row_of_state_for_a_user_and_window(spark, tmp_path):
    path, start = str(tmp_path / "events"), F.timestamp_seconds(F.lit(1_704_067_200))
    rows = spark.range(60).select(
        (F.col("id") % 2).cast("string").alias("user_id"), (F.col("id") % 7).cast("string").alias("session_id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("event_type"),
        F.timestamp_seconds(F.unix_seconds(start) + F.col("id")).alias("timestamp"),
        F.lit(1.5).alias("event_revenue"), F.lit("New").alias("customer_segment"))
    rows.write.parquet(path)
    found = metrics.user_behavior(spark.readStream.schema(rows.schema).parquet(path))
    query = found.writeStream.format("memory").queryName("behavior_state").option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    states = [p["stateOperators"] for p in query.recentProgress]
    assert states and all(len(s) == 1 for s in states)
    assert max(s[0]["numRowsTotal"] for s in states) == 2 * 6


def test_cart_items_leave_no_copy_and_little_state(spark, tmp_path, monkeypatch):
    """The carts of order lines lie once as files of the stream, their shuffles go with the batches, waiting events are compressed."""
    import os
    import pickle

    from clickloom.plans import stream_queries
    from clickloom.plans.registered import ORACLES, QUERIES
    from clickloom.session import BRIEF
    from clickloom.streaming import ordered
    from tests.compare import connect, differences

    n, folder = F.col("id"), str(tmp_path / "in")
    day = F.expr("timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, cast(id * 7 as int))")
    spark.range(400).select(n.alias("o_orderkey"), (n % 9).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias(
        "o_totalprice"), day.alias("o_orderdate"), F.lit("1").alias("o_orderpriority")).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.range(1600).select(F.floor(n / 4).alias("l_orderkey"), (n % 7).alias("l_partkey"), (n % 3).alias("l_suppkey"), (n % 4 + 1).cast(
        "int").alias("l_linenumber"), (n % 5 + 1).cast("double").alias("l_quantity"), (n % 90 + 10).cast("double").alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("timestamp_ntz'1995-01-01'").alias("l_shipdate")).repartition(5).write.parquet(f"{folder}/lineitem.parquet")
    con = connect(folder)
    for name in ("orders", "lineitem"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 300)
    monkeypatch.setattr(stream_queries, "fresh_path", lambda spark, name: str(tmp_path / name))
    before = spark.conf.get(BRIEF)
    assert differences(QUERIES["stream_cart_items"](spark, folder), con, ORACLES["stream_cart_items"]) == ""
    assert not os.path.exists(tmp_path / "cart-events") and spark.conf.get(BRIEF) == before
    files = [f for f in os.listdir(tmp_path / "cart-files") if f.startswith("part-")]
    assert len(files) % 3 == 0 and len(files) > 3

    events = [(1_000_000 * i, f"{i}-1-{i * 7919 % 99991}-a", str(i % 3), "add_to_cart", str(i % 50), i % 9, 10_000 * i) for i in range(250)]
    state = ordered.packed(tuple(zip(*events)))
    assert ordered.unpacked(state) == tuple(zip(*events)) and len(state[0]) < len(pickle.dumps(events)) / 2
