"""Time the headline queries; prints one JSON line.

Each query runs to a sink that discards its rows, so every row and column is computed. The first
run of a query warms the JVM and is not counted; the median of the next three is.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from viewstats.registry.queries import QUERIES

HEADLINE = [
    "dedup_by_id", "dq_report_content", "dq_rule_profile", "contract_stats", "daily_summary",
    "most_watch", "taste", "type_quantiles", "contract_type", "activeness_as_of",
    "activeness_carried", "clinginess_as_of", "search_keyword_counts", "category_map",
    "search_trending", "gold_kpi_metrics", "dash_top_keywords", "write_bronze_roundtrip",
]
RUNS = 3


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("viewstats-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC")
             # Recording the call site of every Column costs more than planning at this size.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))[2:]}))
    spark.stop()


if __name__ == "__main__":
    main()
