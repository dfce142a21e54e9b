"""Batch flows: one enrichment pass, and the hourly run from raw messages to reports."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions import business as rules
from clickloom.operators import enrich, quality, sessions, snapshots, warehouse, windows
from clickloom.session import configure, shared_folder

DAY = ["event_date"]
# Of copies of an event the last one counts: by event time, then by place in the log.
LAST = ("timestamp", "offset", "partition")


@dataclass(frozen=True)
class Enrichment:
    """What one pass over raw messages yields."""
    events: DataFrame
    lake: DataFrame
    metrics: DataFrame
    issues: DataFrame
    dead_letters: DataFrame


def enrichment(messages: DataFrame, profiles: DataFrame, products: DataFrame,
               as_of: Column | None = None) -> Enrichment:
    parsed = quality.parsed_messages(messages)
    return derived(enrich.enrich(quality.events_of(parsed), profiles, products, as_of), parsed, as_of)


def derived(scored: DataFrame, parsed: DataFrame, as_of: Column | None = None) -> Enrichment:
    """The outputs of scored events and of the parsed messages they came from."""
    return Enrichment(
        events=scored, lake=enrich.valid_events(scored),
        metrics=windows.stamped(windows.realtime_metrics(scored), as_of),
        issues=enrich.quality_issues(scored, as_of), dead_letters=quality.dead_letters(parsed, as_of))


def _days(df: DataFrame) -> list:
    """The distinct days of a table, one value per calendar day, to prune partitions with."""
    return sorted(row[0] for row in df.select(*DAY).where("event_date IS NOT NULL").distinct().collect())


def _require(checks: DataFrame, what: str) -> None:
    failed = checks.where("NOT passed").agg(F.array_join(F.array_sort(F.collect_list(checks.columns[0])), ", ")).first()[0]
    if failed:
        raise ValueError(f"{what}: {failed}")


def hourly_run(spark: SparkSession, messages: DataFrame, profiles: DataFrame, products: DataFrame,
               root: str, as_of: Column, within: str = quality.FRESH_WITHIN) -> DataFrame:
    """Freshness, enrichment, gate, upsert, sessions, gate, reports; returns the run's checks.

    Tables under ``root``: events and user_sessions by day, daily_summary, daily_metrics, user_segments, and by run
    dead_letters, quality_issues and realtime_metrics. A run repeated with the same messages leaves the same tables; a
    failed check leaves no report. Of the stored events only days are read that the run's events, or stored sessions
    with their ids, lie in; the upsert opens the files that hold its keys, by the key index. Both tables are snapshots: a
    run that stops leaves the last published version.
    """
    configure(spark)
    shared_folder(spark)
    # Parsed once, for freshness, for the events and for the dead letters.
    parsed = quality.parsed_messages(messages).checkpoint()
    raw = quality.events_of(parsed)
    fresh = quality.freshness(enrich.require_fields(raw), as_of, within)
    _require(fresh.select(F.lit("no new events").alias("what"), "passed"), "freshness")

    # Read by several steps below, so it is computed once and survives lost executors.
    scored = enrich.enrich(raw, profiles, products, as_of).checkpoint()
    made = derived(scored, parsed, as_of)
    staging = (made.lake.withColumns({
        "event_date": F.to_date("timestamp"), "updated_at": F.lit(None).cast("timestamp")})
        .drop("enriched_timestamp", "processing_date"))
    _require(quality.expect(staging, [
        quality.not_null("event_id"), quality.not_null("user_id"), quality.not_null("event_type"),
        quality.between("data_quality_score", 0.0, 1.0), quality.row_count(1)]).select("rule", "passed"),
        "enriched events")
    # These are kept per run: the folder is named by the time of the run.
    for name, rows in (("dead_letters", made.dead_letters), ("quality_issues", made.issues),
                       ("realtime_metrics", made.metrics)):
        warehouse.write_days(rows.withColumn("run", F.date_format(as_of, "yyyyMMddHHmmss")), f"{root}/{name}", ["run"])

    events_path, sessions_path = f"{root}/events", f"{root}/user_sessions"
    if snapshots.exists(spark, events_path):
        snapshots.upsert(spark, events_path, staging, as_of, order=LAST)
    else:
        snapshots.create(spark, events_path, warehouse.latest_per_key(staging, ["event_id"], list(LAST)), DAY, ["event_id"])
    events = snapshots.read(spark, events_path)

    # A new event can lengthen a session or join two: all sessions of its session id are redone.
    ids = staging.select("session_id", "user_id").distinct()
    days = _days(staging)
    stored = snapshots.exists(spark, sessions_path)
    if stored:
        earlier = snapshots.read(spark, sessions_path).join(ids, ["session_id", "user_id"], "left_semi").select(F.explode(
            F.sequence(F.to_date("session_start"), F.to_date("session_end"))).alias("event_date"))
        days = sorted({*days, *_days(earlier)})
    redone = sessions.session_metrics(events.where(F.col("event_date").isin(days)).join(
        ids, ["session_id", "user_id"], "left_semi"))
    redone = redone.withColumn("event_date", F.to_date("session_start"))
    if stored:
        snapshots.replace_rows(spark, sessions_path, redone, ["session_id", "user_id"])
    else:
        snapshots.create(spark, sessions_path, redone, DAY, ["session_id", "user_id"])

    today = events.where(F.col("event_date").isin(_days(staging)))
    checks = quality.expect(today, [
        quality.row_count(1), quality.not_null("event_id"), quality.unique("event_id"),
        quality.fits_money("event_revenue")])
    _require(checks.select("rule", "passed"), "stored events")
    all_sessions = snapshots.read(spark, sessions_path)
    of_today = all_sessions.join(today.select("session_id").distinct(), "session_id", "left_semi")
    warehouse.write_days(warehouse.daily_summary(today, of_today).withColumn("created_at", as_of),
                         f"{root}/daily_summary", ["report_date"])
    warehouse.write_days(warehouse.daily_metrics(today), f"{root}/daily_metrics", ["metric_date"])
    (warehouse.user_segments(profiles, rules.customer_value_segment(
        F.col("total_spent"), F.col("total_orders")))
     .write.mode("overwrite").parquet(f"{root}/user_segments"))
    return checks
