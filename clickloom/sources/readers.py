"""Sources: message streams, lake tables and arrival-triggered reads."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from clickloom import schemas

# ---- Fixed values: the broker options of the two jobs ---------------------------------------
RAW_TOPIC = "ecommerce-events-raw"
ENRICHED_TOPIC = "ecommerce-events-enriched"
RAW_ROWS_PER_TRIGGER = 10_000
ENRICHED_ROWS_PER_TRIGGER = 5_000
# ---------------------------------------------------------------------------------------------


def message_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000,
                   file_format: str = "json") -> DataFrame:
    """Messages as files land in a folder (key, value, topic, partition, offset, timestamp)."""
    return (spark.readStream.format(file_format).schema(schemas.MESSAGE)
            .option("maxFilesPerTrigger", files_per_trigger).load(path))


def broker_stream(spark: SparkSession, servers: str, topic: str,
                  rows_per_trigger: int = RAW_ROWS_PER_TRIGGER, **options) -> DataFrame:
    """Messages straight from the broker; needs the Kafka connector on the class path."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", "latest")
              .option("maxOffsetsPerTrigger", rows_per_trigger)
              .option("failOnDataLoss", "false"))
    return reader.options(**options).load()


def table_stream(spark: SparkSession, path: str, schema: T.StructType | str, glob: str | None = None,
                 files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet objects under a folder, each read once: the raw-zone arrival trigger."""
    reader = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def parse_events(messages: DataFrame, schema: T.StructType = schemas.RAW_EVENT) -> DataFrame:
    """JSON messages as typed events, with the position they came from."""
    return messages.select(
        F.inline(parsed_once(F.col("value"), schema)),
        F.col("timestamp").alias("kafka_timestamp"), "offset", "partition")


def parsed_once(value: Column, schema: T.StructType, options: dict | None = None) -> Column:
    """The parsed record in an array of one, to be unpacked by a generator.

    A filter on plain parsed columns is pushed below the projection and takes a copy of the
    parser with it for every column it names; it does not pass a generator.
    """
    return F.array(F.from_json(value.cast("string"), schema, options or {}))


def lake_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One processing day of the lake table; only its folder is listed and read."""
    return spark.read.parquet(path).where(F.col("processing_date") == F.lit(day).cast("date"))


def with_hour_layout(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The year/month/day/hour partition columns of the hourly lake layout."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts),
                           "day": F.dayofmonth(ts), "hour": F.hour(ts)})


def hour_range(start: Column, end: Column) -> Column:
    """Rows of an hourly layout with start <= hour < end, as a filter on partition columns only."""
    folder = F.make_timestamp(F.col("year"), F.col("month"), F.col("day"), F.col("hour"),
                              F.lit(0), F.lit(0))
    return (folder >= start) & (folder < end)


def to_message_json(df: DataFrame) -> DataFrame:
    """Every column of a row as one JSON text named ``value``."""
    return df.select(F.to_json(F.struct(*df.columns), schemas.JSON_TIME).alias("value"))
