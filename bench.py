"""Seconds per headline query on ``$BENCH_SF_DIR``; prints one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from clickloom.plans.registered import QUERIES
from clickloom.session import configure

HEADLINES = [
    "parse_events", "enrich_events", "realtime_metrics", "session_sequence", "session_metrics",
    "session_sequences", "session_alerts", "conversion_funnel", "user_behavior", "cart_totals",
    "demo_event_metrics", "event_revenue_by_type", "user_activity", "daily_summary", "warehouse_upsert",
    "top_products", "kpi_totals", "cart_abandonment", "latency_quantiles", "counter_increase",
    "journey_transitions", "retention_cohorts", "rfm_segments", "product_performance", "expectations",
    "stream_session_metrics",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    names = sys.argv[1:] or HEADLINES
    QUERIES["group_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the workers
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
