"""The two streaming jobs."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom import schemas
from clickloom.operators import enrich, quality, sessions, windows
from clickloom.sources.readers import parse_events
from clickloom.streaming import metrics, sinks


ENRICHMENT_OUTPUTS = ("enriched_events", "data_lake", "realtime_metrics", "quality_issues")
SESSION_OUTPUTS = ("session_metrics", "conversion_funnel", "user_behavior", "session_alerts")


def enrichment_job(messages: DataFrame, profiles: DataFrame, products: DataFrame, target: str,
                   checkpoints: str, once: bool = False, servers: str | None = None,
                   outputs: tuple[str, ...] = ENRICHMENT_OUTPUTS) -> list[StreamingQuery]:
    """Raw messages -> enriched messages, lake table, realtime metrics, quality issues.

    Position in the session needs the whole session in order; ``operators.ordered.number_rows``
    computes it from the lake table.
    """
    scored = enrich.enrich(parse_events(messages), profiles, products)

    def send(df, name):
        return sinks.write_messages(df, name, target, checkpoints, once, servers)
    start = {
        "enriched_events": lambda name: send(scored, name),
        "data_lake": lambda name: sinks.write_table(enrich.valid_events(scored), name, target, checkpoints,
                                                    ["processing_date", "hour_of_day"], once),
        "realtime_metrics": lambda name: send(windows.stamped(metrics.realtime_metrics(scored))
                                              .withColumn("metric_type", F.lit(name)), name),
        "quality_issues": lambda name: send(enrich.quality_issues(scored), name),
    }
    return [start[name](name) for name in outputs]


def enrichment_job_shared(messages: DataFrame, profiles: DataFrame, products: DataFrame, target: str,
                          checkpoints: str, once: bool = False) -> StreamingQuery:
    """The stateless outputs of the enrichment job, and its dead letters, from one read and one
    enrichment of each batch."""
    def outputs(batch: DataFrame, stamp: sinks.Stamp) -> None:
        parsed = quality.parsed_messages(batch).persist()
        scored = enrich.enrich(quality.events_of(parsed), profiles, products).persist()
        try:
            sinks.replace_batch(scored, f"{target}/enriched_events", stamp)
            sinks.replace_batch(enrich.valid_events(scored), f"{target}/data_lake", stamp,
                                ("processing_date", "hour_of_day"))
            sinks.replace_batch(enrich.quality_issues(scored), f"{target}/quality_issues", stamp)
            sinks.replace_batch(quality.dead_letters(parsed), f"{target}/dead_letters", stamp)
        finally:
            scored.unpersist()
            parsed.unpersist()
    return sinks.write_each(messages, "enriched_events", checkpoints, outputs, once)


def session_job(messages: DataFrame, target: str, checkpoints: str, once: bool = False,
                servers: str | None = None, outputs: tuple[str, ...] = SESSION_OUTPUTS) -> list[StreamingQuery]:
    """Enriched messages -> session metrics, funnel, behaviour table, alerts.

    An alert needs the finished session: it comes at the earliest a gap and a watermark delay
    of event time after the session's last event.
    """
    events = enrich.require_fields(parse_events(messages, schemas.SESSION_EVENT), ("timestamp",))

    def send(df, name):
        return sinks.write_messages(df, name, target, checkpoints, once, servers)
    start = {
        "session_metrics": lambda name: send(metrics.session_metrics(events), name),
        "conversion_funnel": lambda name: send(windows.stamped(metrics.conversion_funnel(events))
                                               .withColumn("metric_type", F.lit(name)), name),
        "user_behavior": lambda name: sinks.write_table(metrics.user_behavior(events), name, target, checkpoints,
                                                        ["customer_segment"], once),
        "session_alerts": lambda name: send(sessions.session_alerts(metrics.session_metrics(events)), name),
    }
    return [start[name](name) for name in outputs]


def sessions_and_alerts(messages: DataFrame, target: str, checkpoints: str, once: bool = False) -> StreamingQuery:
    """Sessions and their alerts from one session state instead of two."""
    events = enrich.require_fields(parse_events(messages, schemas.SESSION_EVENT), ("timestamp",))

    def outputs(batch: DataFrame, stamp: sinks.Stamp) -> None:
        sinks.replace_batch(batch, f"{target}/session_metrics", stamp)
        sinks.replace_batch(sessions.session_alerts(batch), f"{target}/session_alerts", stamp)
    return sinks.write_each(metrics.session_metrics(events), "session_metrics", checkpoints, outputs, once)


def wait_all(queries: list[StreamingQuery]) -> None:
    """Wait for any query to end, so that a failure of a later one is seen at once."""
    if queries:
        manager = queries[0]._jsq.sparkSession().streams()
        while any(q.isActive for q in queries):
            manager.awaitAnyTermination(1000)
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
