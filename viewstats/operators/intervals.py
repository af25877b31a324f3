"""Activeness as intervals: one row per change of a contract's count, not one per contract and day."""

from pyspark.sql import DataFrame, Window, functions as F

from viewstats.functions import run_date
from viewstats.schemas import LOAD_DATE

OPEN_END = "9999-12-31"


def activeness_intervals(stats: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """contract, activeness, valid_from, valid_to (the last day the count holds, NULL while it does).

    ``stats`` has one row per contract and active day. ``earlier`` has the intervals that hold before the
    first of those days (see ``open_before``); they are in the result too, closed where the contract
    was active again. A window partition has at most one row per active day of a contract.
    """
    active = stats.select(
        "contract", F.col(LOAD_DATE).cast("date").alias("valid_from"), F.lit(1).cast("long").alias("_days"))
    if earlier is not None:
        active = active.unionByName(
            earlier.select("contract", "valid_from", F.col("activeness").alias("_days")))
    by_day = Window.partitionBy("contract").orderBy("valid_from")
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return active.select(
        "contract", F.sum("_days").over(upto).alias("activeness"), "valid_from",
        F.date_sub(F.lead("valid_from").over(by_day), 1).alias("valid_to"))


def open_before(intervals: DataFrame, day) -> DataFrame:
    """The intervals that hold on the day before ``day``: what a run from ``day`` on starts from."""
    first = F.lit(run_date(day)).cast("date")
    holds = (F.col("valid_from") < first) & (
        F.col("valid_to").isNull() | (F.col("valid_to") >= F.date_sub(first, 1)))
    return intervals.where(holds).select("contract", "activeness", "valid_from")


def expanded(intervals: DataFrame, days: DataFrame) -> DataFrame:
    """The count of every contract seen so far on each of ``days`` (their ``_load_date``), as
    ``content.activeness_carried`` has it."""
    present = days.select(F.col(LOAD_DATE).cast("string").alias(LOAD_DATE)).distinct()
    last_day = present.agg(F.max(LOAD_DATE)).scalar().cast("date")
    spans = intervals.withColumn("_to", F.least(F.coalesce("valid_to", last_day), last_day))
    daily = spans.where(F.col("valid_from") <= F.col("_to")).select(
        "contract", "activeness",
        F.explode(F.sequence("valid_from", "_to").cast("array<string>")).alias(LOAD_DATE))
    # The days present: bounded by the calendar.
    return daily.join(F.broadcast(present), LOAD_DATE, "left_semi").select("contract", "activeness", LOAD_DATE)


def as_of(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """``rows`` (contract, ``_load_date``, more columns) with the contract's activeness on that day, NULL
    before its first active day. An equal join by contract, whose large partitions AQE splits."""
    held = intervals.select(F.col("contract").alias("_of"), "activeness", "valid_from",
                            F.coalesce("valid_to", F.lit(OPEN_END).cast("date")).alias("_to"))
    day = F.col(LOAD_DATE).cast("date")
    meets = (F.col("contract") == F.col("_of")) & (day >= F.col("valid_from")) & (day <= F.col("_to"))
    return rows.join(held, meets, "left").drop("_of", "valid_from", "_to")
