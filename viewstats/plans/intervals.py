"""Stored activeness intervals, kept up to date from contract_stats."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.functions import run_date
from viewstats.operators.intervals import activeness_intervals, open_before
from viewstats.schemas import CONTRACT_STATS
from viewstats.sources.layers import or_missing, read_table
from viewstats.sources.paths import delete_path, staging_path, stored_days, table_path
from viewstats.sources.sinks import clear_days, write_days

TABLE = "contract_activeness_intervals"
SCHEMA = "contract string, activeness long, valid_from date, valid_to date, closed_on string"
CLOSED_ON, OPEN = "closed_on", "open"  # the partition of an interval: its last day, or that it holds


def read_intervals(spark: SparkSession, silver_root: str, day=None) -> DataFrame | None:
    """The stored intervals, or those that hold on ``day``; None if there are none. Partitions of
    intervals that ended before that day are not read (``open`` sorts after every day)."""
    stored = or_missing(lambda: spark.read.schema(SCHEMA).parquet(table_path(silver_root, "content", TABLE)))
    if stored is None:
        return None
    if day is not None:
        held = F.lit(run_date(day))
        stored = stored.where((F.col(CLOSED_ON) >= held) & (F.col("valid_from") <= held.cast("date")))
    return stored.drop(CLOSED_ON)


def run(spark: SparkSession, silver_root: str, start=None) -> str | None:
    """Make the intervals from ``start`` on again out of contract_stats; None without any.

    What held before ``start`` is read from the stored intervals, so a run reads contract_stats from that
    day on only, and writes the intervals that it changes: those that hold, and those that ended from the
    day before ``start`` on. Without a start, or without stored intervals, all are made. After a run that
    died while it wrote, run without a start.
    """
    path = table_path(silver_root, "content", TABLE)
    stored = None if start is None else read_intervals(spark, silver_root)
    first = None if stored is None else run_date(start)
    stats = or_missing(lambda: read_table(
        spark, silver_root, "content", "contract_stats", start=first, schema=CONTRACT_STATS))
    if stats is None:
        return None
    earlier = None if first is None else open_before(stored, first)
    made = activeness_intervals(stats, earlier).withColumn(
        CLOSED_ON, F.coalesce(F.col("valid_to").cast("string"), F.lit(OPEN)))
    staged = staging_path(silver_root)
    made.write.parquet(staged)  # the table it replaces is among what it reads
    try:
        rows = spark.read.parquet(staged)
        write_days(rows, path, CLOSED_ON, whole_table=first is None)
        if first is not None:
            # One row per day of the range.
            kept = {row[0] for row in rows.select(CLOSED_ON).distinct().collect()}
            before = (date.fromisoformat(first) - timedelta(days=1)).isoformat()
            clear_days(spark, path, [d for d in stored_days(spark, path, CLOSED_ON)
                                     if d >= before and d not in kept], CLOSED_ON)
    finally:
        delete_path(spark, staged)
    return path
