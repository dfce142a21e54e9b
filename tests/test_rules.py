"""Hand-computed cases of the business rules."""

import pytest
from pyspark.sql import functions as F

from clickloom.functions import business as rules
from clickloom.functions import numeric
from clickloom.operators import enrich, quality


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.fixture
def props(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(t, p, c) for t, p, c in rows], "event_type string, properties map<string,string>, price double")
    return build


def test_revenue(props):
    df = props(("purchase", {"total_amount": "12.5"}, None), ("add_to_cart", {}, 50.0),
               ("add_to_cart", {"quantity": "3"}, 50.0), ("add_to_cart", {"quantity": "x"}, None),
               ("purchase", {"total_amount": "x"}, 1.0), ("page_view", {"total_amount": "9"}, 1.0))
    args = (F.col("event_type"), F.col("properties"), F.col("price"))
    assert values(df.select(rules.event_revenue(*args).alias("r")), "r") == [
        12.5, 5.0, pytest.approx(15.0), 0.0, 0.0, 0.0]
    literal = values(df.select(rules.event_revenue(*args, literal_nulls=True).alias("r")), "r")
    assert literal[0] is None and literal[1] == 5.0 and literal[3] is None


def test_value_segment(spark):
    df = spark.createDataFrame([(1000.0, 11), (1000.5, 11), (501.0, 6), (500.0, 6), (101.0, 3), (100.0, 3),
                                (2000.0, 2), (None, None)], "s double, o long")
    found = values(df.select(rules.customer_value_segment(F.col("s"), F.col("o")).alias("x")), "x")
    assert found == ["Premium", "VIP", "Premium", "Regular", "Regular", "New", "New", "New"]
    literal = values(df.select(rules.customer_value_segment(F.col("s"), F.col("o"), True).alias("x")), "x")
    assert literal[-1] is None


def test_quality_score(spark):
    df = spark.createDataFrame(
        [("e", "u", {"a": "1"}, {"b": "1"}), ("", "u", {"a": "1"}, {"b": "1"}), ("e", "u", None, None),
         ("e", "u", None, {"b": "1"}), ("", "", {}, {})],
        "event_id string, user_id string, properties map<string,string>, metadata map<string,string>")
    scored = enrich.score(df)
    assert values(scored, "data_quality_score") == pytest.approx([1.0, 0.7, 0.6, 0.8, 0.0])
    assert values(scored, "is_valid_event") == [True, False, False, True, False]


def test_demo_rules(spark):
    df = spark.createDataFrame([("page_view", None), ("product_view", 51.0), ("add_to_cart", 50.0),
                                ("purchase", 200.5), ("search", 200.0)], "t string, p double")
    assert values(df.select(rules.event_value(F.col("t")).alias("v")), "v") == [1, 3, 10, 100, 0]
    assert values(df.select(rules.price_segment(F.col("p")).alias("v")), "v") == [
        "budget", "standard", "budget", "premium", "standard"]


def test_behavior_score(spark):
    df = spark.createDataFrame([(200, 5, 9, 5000.0), (10, 1, 1, 100.0), (10, 1, 1, None)],
                               "e long, s long, t long, r double")
    found = values(df.select(rules.behavior_score(F.col("e"), F.col("s"), F.col("t"), F.col("r")).alias("b")), "b")
    assert found == pytest.approx([10.0, (1 + 2 + 1 + 5) / 4, (1 + 2 + 0 + 5) / 4])


def test_alert_priority(spark):
    df = spark.createDataFrame([(True, 900.0, 90.0), (False, 900.0, 90.0), (False, 5.0, 90.0),
                                (False, None, 60.0), (False, None, 61.0)], "a boolean, r double, m double")
    args = (F.col("a"), F.col("r"), F.col("m"))
    found = df.where(rules.needs_alert(*args)).select(rules.alert_type(*args).alias("t"))
    assert values(found, "t") == ["CART_ABANDONMENT", "HIGH_VALUE_SESSION", "LONG_SESSION", "LONG_SESSION"]


def test_ratio_and_band(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 5)], "a long, b long")
    assert values(df.select(numeric.ratio(F.col("a"), F.col("b")).alias("r")), "r") == [0.5, None, 0.0]
    bands = spark.createDataFrame([(0.5,), (1.0,), (3.0,), (None,)], "v double").select(
        numeric.band(F.col("v"), [(1.0, "yellow"), (3.0, "green")], "red").alias("b"))
    assert values(bands, "b") == ["red", "yellow", "green", None]


def test_slot_edges(spark):
    df = spark.sql("SELECT timestamp'1969-12-31 23:59:59.999999' AS ts UNION ALL SELECT timestamp'2024-01-01 00:09:59.999999' "
                   "UNION ALL SELECT timestamp'2024-01-01 00:10:00'")
    found = values(df.select(numeric.slot_start(F.col("ts"), "10 minutes").cast("string").alias("s")), "s")
    assert found == ["1969-12-31 23:50:00", "2024-01-01 00:00:00", "2024-01-01 00:10:00"]


def test_expectation_kinds(spark):
    df = spark.createDataFrame([("a", 1, "x1"), ("a", 5, "y"), (None, None, "x2")], "k string, n int, t string")
    rows = {r["rule"]: (r["value"], r["passed"]) for r in quality.expect(df, [
        quality.not_null("k"), quality.in_set("k", ["b"]), quality.between("n", 1, 4),
        quality.matches("t", "^x"), quality.unique("k"), quality.row_count(4)]).collect()}
    assert rows == {"k_not_null": (1, False), "k_in_set": (2, False), "n_between": (1, False),
                    "t_matches": (1, False), "k_unique": (1, False), "row_count": (3, False)}


def test_health(spark):
    stats = spark.createDataFrame([(False, 0, 1, 0), (True, 10001, 1, 0), (True, 5001, 1, 0), (True, 0, 94, 6),
                                   (True, 0, 89, 11), (True, 0, 0, 0), (True, 5001, 94, 6)],
                                  "is_running boolean, current_lag long, processed long, failed long")
    assert [(r.health_score, r.status) for r in quality.consumer_health(stats).collect()] == [
        (0, "unhealthy"), (25, "unhealthy"), (50, "degraded"), (75, "degraded"), (25, "unhealthy"),
        (100, "healthy"), (50, "degraded")]
    sent = spark.createDataFrame([("OPEN", 0), ("HALF_OPEN", 5000), ("CLOSED", 1001), ("CLOSED", 5)],
                                 "circuit_state string, queue_size long")
    assert [r.health_score for r in quality.producer_health(sent).collect()] == [0, 50, 25, 100]


def test_expected_duration(spark):
    df = spark.createDataFrame([(0,), (9999,), (10000,), (25000,)], "event_count long")
    assert values(quality.expected_duration(df), "expected_duration") == [300, 300, 360, 420]
