"""Client payloads: web and mobile batches, and the items inside a purchase."""

from pyspark.sql import DataFrame, functions as F

from clickloom import schemas
from clickloom.functions.business import mobile_event_type
from clickloom.sources.readers import parsed_once

# ---- Fixed values: common properties a mobile client adds to every event --------------------
MOBILE_COMMON = ["sdk_version", "platform", "app_version", "device_model", "os_version"]
WEB_METADATA = ["session_start_time", "sdk_version", "platform", "environment"]
# ---------------------------------------------------------------------------------------------


def web_events(payloads: DataFrame, value: str = "value") -> DataFrame:
    """``{records:[{key,value}]}`` -> one event per record, with the record key."""
    parsed = payloads.select(F.inline(parsed_once(F.col(value), schemas.WEB_ENVELOPE)))
    return (parsed.select(F.explode("records").alias("record"))
            .select(F.col("record.key").alias("record_key"), "record.value.*"))


def web_metadata(events: DataFrame) -> DataFrame:
    """The four metadata entries a web client sends, as columns."""
    named = {key: F.col("metadata")[key] for key in WEB_METADATA}
    named["session_start_time"] = named["session_start_time"].try_cast("timestamp")
    return events.withColumns(named)


def mobile_events(payloads: DataFrame, value: str = "value") -> DataFrame:
    """``{events:[...],environment}`` in either spelling -> canonical events.

    Times are epoch milliseconds. The client sends no event id, so one is derived from
    (user, session, time, name): the same event sent twice gets the same id.
    """
    parsed = payloads.select(F.inline(parsed_once(F.col(value), schemas.MOBILE_ENVELOPE)))
    sent = parsed.select("environment", F.explode("events").alias("e"))
    flat = sent.select(
        "environment",
        F.coalesce("e.event_name", "e.eventName").alias("name"),
        F.coalesce("e.session_id", "e.sessionId").alias("session_id"),
        F.coalesce("e.user_id", "e.userId").alias("user_id"),
        F.col("e.timestamp").cast("long").alias("millis"),
        F.coalesce("e.properties", F.create_map().cast("map<string,string>")).alias("all"))
    common = F.array(*[F.lit(k) for k in MOBILE_COMMON])
    return flat.select(
        F.sha2(F.concat_ws("|", "user_id", "session_id", F.col("millis").cast("string"), "name"),
               256).alias("event_id"),
        mobile_event_type(F.col("name")).alias("event_type"),
        F.timestamp_millis("millis").alias("timestamp"),
        "user_id", "session_id", F.lit("mobile").alias("source"),
        F.map_filter("all", lambda k, v: ~F.array_contains(common, k) & (k != "timestamp"))
        .alias("properties"),
        F.map_concat(F.map_filter("all", lambda k, v: F.array_contains(common, k)),
                     F.create_map(F.lit("environment"), F.col("environment")))
        .alias("metadata"))


def purchase_items(events: DataFrame) -> DataFrame:
    """One row per line item of a purchase; a purchase without items keeps one row of nulls."""
    items = F.from_json(F.col("properties")["items"], schemas.PURCHASE_ITEMS)
    return (events.where(F.col("event_type") == "purchase")
            .select("event_id", "user_id", "session_id", "timestamp",
                    F.col("properties")["order_id"].alias("order_id"),
                    F.explode_outer(items).alias("item"))
            .select("event_id", "user_id", "session_id", "timestamp", "order_id",
                    "item.product_id", "item.price", "item.quantity"))
