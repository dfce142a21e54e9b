"""Operators on metric samples (ts, metric, series, value): increases, rates, quantiles, alerts.

``series`` is the label map as JSON text in key order, so that it can be a grouping key.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.numeric import seconds, slot_start

SERIES = ["metric", "series"]
# Samples of one series are ordered within such slots; one row per slot joins them.
BUCKET = "10 minutes"

# ---- Fixed values ---------------------------------------------------------------------------
# Histogram bounds in seconds (the default bounds of the Prometheus client libraries).
LATENCY_BOUNDS = [.005, .01, .025, .05, .075, .1, .25, .5, .75, 1.0, 2.5, 5.0, 7.5, 10.0]
# (panel, steps from the lowest, name below the first step)
CONVERSION_BANDS = ([(1.0, "yellow"), (3.0, "green")], "red")
ERROR_RATE_BANDS = ([(0.01, "yellow"), (0.05, "red")], "green")
# alert -> (threshold, breach when below, how long)
ALERT_RULES = {
    "HighErrorRate": (0.1, False, "2 minutes"),
    "KafkaConsumerLag": (1000, False, "5 minutes"),
    "SparkJobFailure": (300, False, "2 minutes"),
    "HighCPUUsage": (80, False, "5 minutes"),
    "HighMemoryUsage": (85, False, "3 minutes"),
    "DiskSpaceLow": (10, True, "1 minute"),
}
# ---------------------------------------------------------------------------------------------


def series_key(labels: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def with_series(samples: DataFrame) -> DataFrame:
    return samples.withColumn("series", series_key(F.col("labels")))


def label(name: str) -> Column:
    return F.get_json_object("series", f"$.{name}")


def _gain(value: Column, before: Column) -> Column:
    """Growth between two samples; a smaller value means the counter began again at 0."""
    return F.when(before.isNull(), F.lit(0.0)).when(value < before, value).otherwise(value - before)


def counter_increase(samples: DataFrame, every: str, bucket: str = BUCKET) -> DataFrame:
    """Growth of each counter per window, resets included, without extrapolating to the edges.

    Growth inside a bucket needs only that bucket's samples; growth across buckets needs one
    row per bucket. ``bucket`` divides ``every``.
    """
    rows = samples.withColumn("_bucket", slot_start(F.col("ts"), bucket))
    inside = Window.partitionBy(*SERIES, "_bucket").orderBy("ts")
    gains = rows.withColumn("_gain", _gain(F.col("value"), F.lag("value").over(inside)))
    buckets = gains.groupBy(*SERIES, "_bucket").agg(
        F.sum("_gain").alias("_inner"),
        F.min_by("value", "ts").alias("_first"), F.max_by("value", "ts").alias("_last"))
    before = F.lag("_last").over(Window.partitionBy(*SERIES).orderBy("_bucket"))
    gained = buckets.withColumn("_total", F.col("_inner") + _gain(F.col("_first"), before))
    return (gained.groupBy(*SERIES, slot_start(F.col("_bucket"), every).alias("window_start"))
            .agg(F.sum("_total").alias("increase")))


def counter_rate(samples: DataFrame, every: str, bucket: str = BUCKET) -> DataFrame:
    return counter_increase(samples, every, bucket).withColumn(
        "per_second", F.col("increase") / F.lit(float(seconds(every))))


def sum_by(df: DataFrame, names: list[str], value: str, keep: list[str] | None = None) -> DataFrame:
    """Sum of a value over all series that share these labels."""
    keys = [label(n).alias(n) for n in names]
    return df.groupBy(*(keep or []), *keys).agg(F.sum(value).alias(value))


def gauge_last(samples: DataFrame) -> DataFrame:
    return (samples.where(F.col("value").isNotNull()).groupBy(*SERIES)
            .agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts")))


def series_stats(latest: DataFrame, scale: float = 1.0) -> DataFrame:
    """Mean over the series of a metric, and how many there are."""
    return latest.groupBy("metric").agg(
        (F.avg("value") * F.lit(scale)).alias("mean_value"), F.count("*").alias("series_count"))


def histogram(df: DataFrame, value: Column, keys: list[str], bounds: list[float]) -> DataFrame:
    """Cumulative bucket counts per key in one pass, one row per upper bound ``le``."""
    # count(when) is a plain count, so a row only updates counters in its own task
    counts = [F.count(F.when(value <= b, 1)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(*keys).agg(*counts, F.count(value).alias("_all"))
    entry = lambda bound, n: F.struct(F.lit(bound).cast("double").alias("le"), F.col(n).alias("cumulative"))
    cells = [entry(b, f"_b{i}") for i, b in enumerate(bounds)] + [entry(float("inf"), "_all")]
    return wide.select(*keys, F.explode(F.array(*cells)).alias("b")).select(*keys, "b.*")


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds it.

    Buckets are (le, cumulative); a quantile in the last, unbounded one is its lower bound.
    """
    order = Window.partitionBy(*keys).orderBy("le")
    whole = Window.partitionBy(*keys)
    marked = buckets.withColumns({
        "_lower": F.coalesce(F.lag("le").over(order), F.lit(0.0)),
        "_below": F.coalesce(F.lag("cumulative").over(order), F.lit(0)),
        "_rank": F.lit(q) * F.max("cumulative").over(whole)})
    holding = marked.where((F.col("cumulative") >= F.col("_rank")) & (F.col("_rank") > 0))
    hit = holding.groupBy(*keys).agg(F.min(F.struct("le", "cumulative", "_lower", "_below", "_rank")).alias("h"))
    inside = (F.col("h._lower") + (F.col("h.le") - F.col("h._lower"))
              * F.try_divide(F.col("h._rank") - F.col("h._below"),
                             (F.col("h.cumulative") - F.col("h._below")).cast("double")))
    value = F.when(F.col("h.le") == float("inf"), F.col("h._lower")).otherwise(
        F.coalesce(inside, F.col("h.le")))
    return hit.select(*keys, value.alias("quantile_value"))


def sustained(points: DataFrame, keys: list[str], breach: Column, step: str, lasting: str) -> DataFrame:
    """Alerts that fire once ``breach`` has held in consecutive windows for ``lasting``.

    ``points`` has one row per key and ``slot_start``, so a key has at most one row per step.
    """
    width, need = seconds(step), seconds(lasting)
    number = (F.unix_timestamp("slot_start") / F.lit(width)).cast("long")
    order = Window.partitionBy(*(keys or [F.lit(1)])).orderBy("slot_start")
    breaching = points.where(breach).withColumn("_run", number - F.row_number().over(order))
    runs = breaching.groupBy(*keys, "_run").agg(
        F.min("slot_start").alias("started_at"), F.max("slot_start").alias("last_breach"),
        F.count("*").alias("windows"))
    held = F.unix_timestamp("last_breach") - F.unix_timestamp("started_at")
    return (runs.where(held >= need)
            .withColumn("fired_at", F.timestamp_seconds(F.unix_timestamp("started_at") + need))
            .drop("_run"))


def rule_breach(rule: str, value: Column) -> Column:
    threshold, below, _ = ALERT_RULES[rule]
    return value < threshold if below else value > threshold
