"""The library's formulations beside the textbook ones, on stored input; prints one JSON line.

Input is the content and search logs derived from ``$BENCH_SF_DIR``, written once as day
partitions. Median of three runs after a warm-up.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession, Window, functions as F

from viewstats.operators import content, quality, search
from viewstats.registry import adapters
from viewstats.registry.scratch import scratch_path
from viewstats.schemas import BRONZE_CONTENT, LOAD_DATE
from viewstats.sources.layers import read_table
from viewstats.sources.paths import table_path
from viewstats.sources.sinks import write_days

KEYS = content.KEYS


def two_aggregates_joined(bronze):
    """contract_stats from its two library aggregates."""
    enriched = content.enrich(bronze)
    return content.duration_by_category(enriched).join(content.devices_per_contract(enriched), KEYS)


def rank_of_unpivoted(stats):
    best = Window.partitionBy(*KEYS).orderBy(F.desc("total_duration"))
    return content.unpivot_categories(stats).withColumn("r", F.rank().over(best)).where("r = 1")


def percentile_disc(stats):
    totals = content.viewing_totals(stats)
    limits = totals.groupBy(LOAD_DATE).agg(*[
        F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY total_duration)").alias(n)
        for n, p in (("q1", 0.25), ("q3", 0.75))])
    return content.contract_type(stats, limits)


def count_per_rule(bronze):
    rules = quality.content_rules()
    counts = [(r.name, bronze.where(r.predicate).count(), bronze.count()) for r in rules]
    return bronze.sparkSession.createDataFrame(counts, "rule string, passed long, total long")


def rank_window(searches):
    by_user = Window.partitionBy("user_id").orderBy(F.desc("times"))
    return search.keyword_counts(searches).withColumn("r", F.rank().over(by_user)).where("r = 1")


def join_segments(stats):
    return content.clinginess(content.contract_type(stats), content.activeness(stats, "as_of"))


def hot_user(spark, tied):
    """Three million searches, a third of them by one user for a million keywords, all as often or not."""
    keyword = F.col("id") if tied else F.floor(F.col("id") / (1 + F.col("id") % 2))
    hot = spark.range(1_000_000).select(
        F.lit("hot").alias("user_id"), F.concat(F.lit("k"), keyword).alias("keyword"))
    return hot.unionByName(spark.range(2_000_000).select(
        F.concat(F.lit("u"), F.col("id") % 50_000).alias("user_id"),
        F.concat(F.lit("k"), F.col("id") % 997).alias("keyword")))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("viewstats-forms")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "forms")
    write_days(adapters.bronze_content(spark, sf_dir), table_path(root, "content"))
    write_days(adapters.bronze_search(spark, sf_dir), table_path(root, "search"))
    bronze = read_table(spark, root, "content", schema=BRONZE_CONTENT)
    write_days(content.contract_stats(content.enrich(bronze)), table_path(root, "content_stats"))
    stats = read_table(spark, root, "content_stats")
    june = search.in_month(read_table(spark, root, "search"), "2022-06")
    forms = {
        "contract_stats": lambda: content.contract_stats(content.enrich(bronze)),
        "contract_stats/two_aggregates_joined": lambda: two_aggregates_joined(bronze),
        "most_watch": lambda: content.most_watch(stats),
        "most_watch/rank_of_unpivoted": lambda: rank_of_unpivoted(stats),
        "contract_type": lambda: content.contract_type(stats),
        "contract_type/percentile_disc": lambda: percentile_disc(stats),
        "clinginess": lambda: content.clinginess_as_of(content.contract_type(stats)),
        "clinginess/join": lambda: join_segments(stats),
        "dq_rule_profile": lambda: quality.rule_profile(bronze, quality.content_rules()),
        "dq_rule_profile/count_per_rule": lambda: count_per_rule(bronze),
        "top_keyword": lambda: search.top_keyword(june, "june"),
        "top_keyword/rank_window": lambda: rank_window(june),
        "top_keyword/mixed_hot": lambda: search.top_keyword(hot_user(spark, False), "june"),
        "top_keyword/mixed_hot/rank_window": lambda: rank_window(hot_user(spark, False)),
        "top_keyword/tied_hot": lambda: search.top_keyword(hot_user(spark, True), "june"),
        "top_keyword/tied_hot/rank_window": lambda: rank_window(hot_user(spark, True)),
    }
    seconds = {}
    for name, build in forms.items():
        taken = []
        for _ in range(4):
            started = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({"sf": os.path.basename(sf_dir.rstrip("/")), "unit": "sec", "forms": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
