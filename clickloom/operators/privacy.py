"""Filters on whose data may be used: opt-out, erasure, region access, event types."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions.numeric import money_sum, slot_start
from clickloom.operators import snapshots

# ---- Fixed values: viewer region -> customer regions it may see ------------------------------
REGION_ACCESS = {"US": ["US", "CA"], "EU": ["EU", "UK"]}
# ---------------------------------------------------------------------------------------------


def without_users(events: DataFrame, opted_out: DataFrame) -> DataFrame:
    return events.join(opted_out.select("user_id"), "user_id", "left_anti")


def erase_from_table(spark: SparkSession, path: str, erased: DataFrame) -> None:
    """Remove all rows of the erased users from a snapshot table; only files that hold such rows are rewritten."""
    snapshots.erase(spark, path, erased, ["user_id"])


def visible_to(customers: DataFrame, viewer_region: str, region: Column,
               access: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows a viewer of this region may see; an unknown region sees none."""
    allowed = (REGION_ACCESS if access is None else access).get(viewer_region, [])
    return customers.where(region.isin(*allowed) if allowed else F.lit(False))


def without_types(events: DataFrame, disabled: list[str]) -> DataFrame:
    return events.where(~F.col("event_type").isin(*disabled))


def by_source_switch(events: DataFrame, switches: DataFrame) -> DataFrame:
    """Events of the sources whose switch (source, enabled) is on; no switch means on."""
    off = switches.where(~F.col("enabled")).select("source")
    return events.join(off, "source", "left_anti")


def _hourly(events: DataFrame) -> DataFrame:
    return (events.groupBy(slot_start(F.col("timestamp"), "1 hour").alias("hour_start"), "event_type")
            .agg(F.count("*").alias("event_count"), money_sum(F.col("event_revenue")).alias("revenue")))


def rolling_extract(events: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Hourly sums of the last days, the form a dashboard extract takes."""
    return _hourly(events.where(F.col("timestamp") >= F.date_sub(as_of, days).cast("timestamp")))


def extract_after(events: DataFrame, extract: DataFrame, as_of: Column) -> DataFrame:
    """Hours to append to an extract: complete hours after its last one."""
    mark = extract.agg(F.max("hour_start")).scalar()
    start = F.coalesce(mark + F.expr("interval 1 hour"), F.timestamp_seconds(F.lit(0)))
    return _hourly(events.where((F.col("timestamp") >= start)
                                & (F.col("timestamp") < F.date_trunc("hour", as_of))))
