"""Ordered operators and sessions against plain windows, with one key holding most rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from clickloom.operators import carts, insights, ordered, sessions, windows
from clickloom.sources import tables as tables_source


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 events: one session id holds half of them, one has no id, some share a time."""
    rnd, rows = random.Random(7), []
    for i in range(3000):
        session = "hot" if i % 2 else rnd.choice([None, "a", "b", "c"])
        second = rnd.randrange(0, 4 * 86400) if i % 7 else 3600
        kind = rnd.choice(["add_to_cart", "remove_from_cart", "purchase", "page_view", "session_started"])
        rows.append((f"{i:05d}", kind, second * 1_000_000 + rnd.randrange(3) * 500_000, session or "nobody", session,
                     rnd.choice(["web", "mobile"]), {"product_id": str(rnd.randrange(4)), "quantity": str(rnd.randrange(1, 4))}
                     | ({"price": str(rnd.randrange(1, 50))} if kind == "add_to_cart" else {}),
                     "A", float(rnd.randrange(10))))
    df = spark.createDataFrame(rows, "event_id string, event_type string, us long, user_id string, session_id string, "
                               "source string, properties map<string,string>, customer_segment string, event_revenue double")
    return df.withColumn("timestamp", F.timestamp_micros("us")).drop("us").cache()


ORDER = ["timestamp", "event_id"]


def test_number_rows(skewed):
    plain = F.row_number().over(Window.partitionBy("session_id").orderBy(*ORDER))
    found = ordered.number_rows(skewed.withColumn("plain", plain), ["session_id"])
    assert found.count() == 3000
    assert found.where("plain <> session_sequence").count() == 0


def test_latest_so_far(skewed):
    value = F.when(F.col("event_type") == "session_started", F.col("timestamp"))
    window = Window.partitionBy("user_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    found = ordered.latest_so_far(skewed.withColumn("plain", F.max(value).over(window)), ["user_id"], value)
    assert found.count() == 3000
    assert found.where("NOT (plain <=> latest)").count() == 0


def plain_carts(rows):
    """The total after each event, by a dictionary of products for each user."""
    wanted, carts_of = {}, {}
    for r in sorted(rows, key=lambda r: (r.timestamp, r.event_id)):
        cart = carts_of.setdefault(r.user_id, {})
        product, n = r.properties.get("product_id"), int(r.properties.get("quantity", 1))
        units, price = cart.get(product, (0, 0.0))
        if r.event_type == "add_to_cart":
            cart[product] = units + n, float(r.properties.get("price", price))
        elif r.event_type == "remove_from_cart":
            cart[product] = max(0, units - n), price
        elif r.event_type == "purchase":
            cart.clear()
        else:
            continue
        wanted[r.event_id] = sum(u * p for u, p in cart.values())
    return wanted


def test_cart_totals(skewed):
    assert {r.event_id: r.cart_total for r in carts.cart_totals(skewed).collect()} == plain_carts(skewed.collect())


def test_removals_take_the_price_of_the_addition(make):
    item = lambda product, quantity, price=None: {"product_id": product, "quantity": str(quantity)} | (
        {"price": str(price)} if price else {})
    steps = [("add_to_cart", item("a", 2, 10)), ("add_to_cart", item("b", 1, 5)), ("remove_from_cart", item("a", 2)),
             ("remove_from_cart", item("a", 3)), ("add_to_cart", item("a", 1, 7)), ("add_to_cart", item("a", 1)),
             ("add_to_cart", {"price": "bad"}), ("remove_from_cart", item("z", 1)), ("purchase", {}), ("remove_from_cart", item("b", 1)),
             ("add_to_cart", item("b", 2))]
    events = make([{"ts": f"2024-01-01 00:{i:02d}:00", "event_id": f"{i:02d}", "event_type": t, "properties": p}
                   for i, (t, p) in enumerate(steps)])
    found = [r.cart_total for r in carts.cart_totals(events).orderBy("event_id").collect()]
    assert found == [20.0, 25.0, 5.0, 5.0, 12.0, 19.0, 19.0, 19.0, 0.0, 0.0, 0.0]


def test_transitions(skewed):
    step = F.lead("event_type").over(Window.partitionBy("session_id").orderBy(*ORDER))
    plain = (skewed.withColumn("to_type", step).where("to_type IS NOT NULL")
             .groupBy(F.col("event_type").alias("from_type"), "to_type").agg(F.count("*").alias("transitions")))
    found = insights.journey_transitions(skewed)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.select(*found.columns).collect()))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_sequence_chunks_hold_every_row_in_order(skewed, size):
    chunks = ordered.sequence_chunks(skewed, ["session_id"], ["event_id"], chunk_size=size).collect()
    assert max(c.entries for c in chunks) <= size
    found = {}
    for c in sorted(chunks, key=lambda c: c.chunk):
        found.setdefault(c.session_id, []).extend(c.event_id)
    wanted = {}
    for r in sorted(skewed.collect(), key=lambda r: (r.timestamp, r.event_id)):
        wanted.setdefault(r.session_id, []).append(r.event_id)
    assert found == wanted


@pytest.mark.parametrize("gap", ["1 minute", "30 minutes", "6 hours"])
def test_sessions_equal_session_window(skewed, gap):
    plain = (skewed.groupBy("session_id", "user_id", F.session_window("timestamp", gap).alias("w"))
             .agg(F.count("*").alias("total_events"), F.count_distinct("event_type").alias("unique_event_types"),
                  F.sum("event_revenue").alias("session_revenue"), F.max("timestamp").alias("session_end"))
             .select("session_id", "user_id", F.col("w.start").alias("session_start"), "session_end",
                     F.col("w.end").alias("window_end"), "total_events", "unique_event_types", "session_revenue"))
    found = (sessions.session_metrics(skewed, gap).withColumn("window_end", F.col("session_window.end"))
             .select(*plain.columns))
    key = lambda rows: sorted(map(str, rows))
    assert key(found.collect()) == key(plain.collect())


def same_rows(left, right):
    key = lambda df: sorted(map(str, df.select(*right.columns).collect()))
    return key(left) == key(right)


@pytest.fixture(scope="module")
def gappy(skewed):
    """The skewed events with some types, users and revenues missing."""
    n = F.col("event_id").cast("int")
    return skewed.withColumns({
        "event_type": F.when(n % 11 != 0, F.col("event_type")), "user_id": F.when(n % 13 != 0, F.col("user_id")),
        "event_revenue": F.when(n % 5 != 0, F.col("event_revenue")),
        "customer_segment": F.when(n % 4 == 0, "B").when(n % 4 == 1, "A"), "event_value": n % 7, "price": F.col("event_revenue")})


@pytest.mark.parametrize("size, slide", [("1 hour", "10 minutes"), ("5 minutes", "1 minute"), ("1 hour", "1 hour")])
def test_sliding_windows_equal_plain_windows(gappy, size, slide):
    window = F.window("timestamp", size, slide)
    bounds = lambda df: df.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")
    behaviour = bounds(gappy.groupBy("user_id", window).agg(
        F.count("*").alias("events_count"), F.count_distinct("session_id").alias("session_count"),
        F.count_distinct("event_type").alias("unique_event_types"), F.sum("event_revenue").alias("hourly_revenue"),
        F.min(F.struct("timestamp", "customer_segment"))["customer_segment"].alias("customer_segment")))
    assert same_rows(windows.user_behavior(gappy, size, slide), behaviour)
    stage = lambda t: F.count_distinct(F.when(F.col("event_type") == t, F.col("session_id")))
    funnel = bounds(gappy.groupBy(window, "source", "customer_segment").agg(
        stage("page_view").alias("sessions_with_pageview"), stage("add_to_cart").alias("sessions_with_add_to_cart"),
        stage("purchase").alias("sessions_with_purchase"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("event_revenue"))).alias("total_revenue")))
    assert same_rows(windows.conversion_funnel(gappy, size, slide), funnel)
    demo = bounds(gappy.groupBy(window, "event_type", "source").agg(
        F.count("*").alias("event_count"), F.sum("event_value").alias("total_value"),
        F.count_distinct("user_id").alias("unique_users"), F.round(F.avg("price"), 2).alias("avg_price")))
    assert same_rows(windows.demo_event_metrics(gappy, size, slide), demo)
    simple = bounds(gappy.groupBy(window, "event_type").agg(
        F.count("*").alias("count"), F.sum("price").alias("total_value"), F.count_distinct("user_id").alias("unique_users")))
    assert same_rows(windows.simple_summary(gappy, "price", size, slide), simple)


def test_behavior_sequences(gappy):
    wanted = gappy.groupBy("user_id", F.window("timestamp", "1 hour", "10 minutes").alias("w")).agg(F.count("*").alias("n"))
    found = windows.behavior_sequences(gappy, chunk_size=5)
    assert found.agg(F.max("entries")).first()[0] <= 5
    sums = found.groupBy("user_id", "window_start").agg(F.sum("entries").alias("n"))
    assert same_rows(sums, wanted.select("user_id", F.col("w.start").alias("window_start"), "n"))


def test_gap_edges(make):
    exact = make([{"ts": "2024-01-01 00:00:00"}, {"ts": "2024-01-01 00:30:00"}])
    over = make([{"ts": "2024-01-01 00:00:00"}, {"ts": "2024-01-01 00:30:01"}])
    assert sessions.session_metrics(exact).count() == 1
    assert sessions.session_metrics(over).count() == 2


def test_session_flags(make):
    def one(*types):
        rows = [{"ts": f"2024-01-01 00:{i:02d}:00", "event_type": t} for i, t in enumerate(types)]
        return sessions.session_metrics(make(rows)).first()
    bought = one("page_view", "purchase")
    assert bought.conversion_rate is None and not bought.abandoned_cart and bought.has_purchase
    left = one("add_to_cart", "page_view")
    assert left.abandoned_cart and left.conversion_rate == 0.0 and left.session_duration_minutes == 1.0
    assert one("remove_from_cart", "purchase").conversion_rate == 1.0


def test_first_segment_and_source(make):
    found = sessions.session_metrics(make([
        {"ts": "2024-01-01 00:02:00", "source": "web", "customer_segment": "A"},
        {"ts": "2024-01-01 00:01:00", "source": "mobile", "customer_segment": None}])).first()
    assert (found.source, found.customer_segment) == ("mobile", None)


def test_fifths_share_of_rows(spark):
    df = spark.range(10000).select("id", (F.col("id") % 5000).alias("v"))
    both = insights.fifths(df, "id", {"up": ("v", True)})
    assert {r.up: r["count"] for r in both.groupBy("up").count().collect()} == {i: 2000 for i in range(1, 6)}
    down = insights.fifths(df, "id", {"down": ("v", False)}).where("id = 0").first()
    assert (down.v, down.down) == (0, 5)
    tied = spark.createDataFrame([(0, 1), (1, 1), (2, 1), (3, 1), (4, 9)], "id int, v long")
    assert sorted(r.s for r in insights.fifths(tied, "id", {"s": ("v", True)}).collect()) == [4, 4, 4, 4, 5]


def test_ip_lookup(spark):
    df = spark.createDataFrame([("a", "1.2.3.4"), ("b", "1.3.0.0"), ("c", "9.9.9.9"), ("d", None), ("e", "1.2.3"),
                                ("f", "1.2.3.256"), ("g", "1.2.2.255")], "event_id string, ip string")
    networks = spark.createDataFrame([("X", "1.2.3.0", "1.3.0.0"), ("Y", "1.3.0.1", "2.0.0.0")], "country string, a string, b string")
    networks = networks.select("country", insights.ip_number(F.col("a")).alias("first_ip"), insights.ip_number(F.col("b")).alias("last_ip"))
    found = {r.event_id: r.country for r in insights.locate_ip(df, networks, insights.ip_number(F.col("ip"))).collect()}
    assert found == {"a": "X", "b": "X", "c": None, "d": None, "e": None, "f": None, "g": None}


def test_no_range_holds_a_hot_group(spark, monkeypatch):
    """Half of all rows in ten minutes of one session, the other half without a session id."""
    n = F.col("id")
    rows = spark.range(0, 40000, numPartitions=8).select(
        F.format_string("%06d", n).alias("event_id"), F.when(n % 2 == 0, "hot").alias("session_id"), F.lit("u").alias("user_id"),
        F.timestamp_micros(1_704_067_200_000_000 + (n * 7919 % 40000) * 15_000).alias("timestamp"),
        F.when(n % 5 == 0, "purchase").otherwise("add_to_cart").alias("event_type"), F.create_map(F.lit("k"), F.lit("1")).alias("properties"))
    tables, keep = [], ordered.stored
    monkeypatch.setattr(ordered, "stored", lambda df, name: tables.append(keep(df, name)) or tables[-1])
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        plain = Window.partitionBy("session_id").orderBy(*ORDER)
        checked = rows.withColumn("plain", F.row_number().over(plain))
        assert ordered.number_rows(checked, ["session_id"]).where("plain <> session_sequence").count() == 0
        sessions.session_sequences(rows).count()
        insights.journey_transitions(rows).count()
        sessions.session_age(rows, "purchase").count()
        carts.cart_totals(rows, ["session_id"]).count()
        windows.behavior_sequences(rows).count()
    finally:
        spark.conf.set(name, "true")
    assert len(tables) == 8
    for table in tables:
        sizes = sorted(r["count"] for r in table.groupBy("_range").count().collect())
        assert len(sizes) > 4 and sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_carts_move_what_is_asked_for(spark, make, monkeypatch):
    """Tables between the steps hold no properties, and carried values, one for a range, are not joined by a shuffle."""
    rows = make([{"event_id": str(i), "ts": "2024-01-01 00:00:00", "event_type": "add_to_cart",
                  "properties": {"product_id": str(i % 2), "price": "2"}} for i in range(4)])
    tables, keep = [], ordered.stored
    monkeypatch.setattr(ordered, "stored", lambda df, name: tables.append(keep(df, name)) or tables[-1])
    found = carts.cart_totals(rows, columns=["event_id"])
    assert [tuple(r) for r in found.orderBy("event_id").collect()] == [("0", 2.0), ("1", 4.0), ("2", 6.0), ("3", 8.0)]
    assert len(tables) == 3 and not any("properties" in t.columns for t in tables)
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_carts_of_small_users_are_moved_once(spark, make, monkeypatch):
    """Users that are a small part of a task go through one shuffle and no table; only the rows of a large one lie in ranges."""
    rnd = random.Random(9)
    def event(i, user):
        kind = rnd.choice(["add_to_cart", "add_to_cart", "remove_from_cart", "purchase"])
        item = {"product_id": str(rnd.randrange(4)), "quantity": str(rnd.randrange(1, 4))}
        return {"event_id": str(i), "ts": f"2024-01-01 00:{rnd.randrange(60):02d}:{rnd.randrange(60):02d}", "user_id": user,
                "event_type": kind, "properties": item | ({"price": str(rnd.randrange(1, 50))} if kind == "add_to_cart" else {})}
    small = [event(i, f"u{i % 200}") for i in range(1000)]
    large = [event(1000 + i, None if i % 2 else "large") for i in range(600)]
    tables, keep = [], ordered.stored
    monkeypatch.setattr(ordered, "stored", lambda df, name: tables.append(keep(df, name)) or tables[-1])
    for rows, stored in ((small, 0), (small + large, 3)):
        events, before = make(rows), len(tables)
        found = carts.cart_totals(events, columns=["event_id"])
        if not stored:
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange ") == 1 and "hashpartitioning(user_id" in plan
        assert {r.event_id: r.cart_total for r in found.collect()} == plain_carts(events.collect())
        assert len(tables) - before == stored and all(t.count() == len(large) for t in tables)
    assert sorted(ordered.apart(make(small + large), ["user_id"])[0].select("event_id").collect()) == sorted(
        (str(1000 + i),) for i in range(600))


def test_unasked_columns_of_cart_events_are_not_read(spark, sf_dir):
    """Who counts the users of order lines reads no price, part or quantity."""
    plan = tables_source.cart_events(spark, sf_dir).select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in plan and not any(c in plan for c in ("l_partkey", "l_quantity", "l_extendedprice", "l_suppkey"))
