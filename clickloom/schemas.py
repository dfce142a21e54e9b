"""Declared schemas of the records the flows read."""

from pyspark.sql import types as T

# Written times keep their microseconds; without a format JSON text stops at milliseconds.
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

_text_map = T.MapType(T.StringType(), T.StringType())

RAW_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("properties", _text_map),
    T.StructField("metadata", _text_map),
])

# What the session job reads back from the enriched topic.
SESSION_EVENT = T.StructType(RAW_EVENT.fields + [
    T.StructField("customer_segment", T.StringType()),
    T.StructField("event_revenue", T.DoubleType()),
])

# One message as a broker hands it over.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

USER_PROFILE = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("age_group", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("registration_date", T.TimestampType()),
    T.StructField("last_activity", T.TimestampType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_spent", T.DoubleType()),
])

PRODUCT = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("margin", T.DoubleType()),
    T.StructField("inventory_level", T.LongType()),
    T.StructField("last_updated", T.TimestampType()),
])

PURCHASE_ITEMS = T.ArrayType(T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
]))

WEB_ENVELOPE = T.StructType([
    T.StructField("records", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", RAW_EVENT),
    ]))),
])

# Both spellings: one mobile client sends snake_case, the other camelCase.
MOBILE_ENVELOPE = T.StructType([
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("event_name", T.StringType()),
        T.StructField("eventName", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("sessionId", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("properties", _text_map),
    ]))),
    T.StructField("api_key", T.StringType()),
    T.StructField("environment", T.StringType()),
])

METRIC_SAMPLE = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("metric", T.StringType()),
    T.StructField("labels", _text_map),
    T.StructField("value", T.DoubleType()),
])
