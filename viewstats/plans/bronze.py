"""Raw -> bronze: de-duplicate, check, gate, write valid and quarantined rows."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.operators import quality
from viewstats.schemas import LOAD_DATE, REJECTION_LIMITS
from viewstats.sources.layers import or_missing
from viewstats.sources.paths import delete_path, quarantine_path, staging_path, table_path
from viewstats.sources.raw import read_raw
from viewstats.sources.sinks import clear_range, write_bronze, write_table


def prepare(raw: DataFrame, data_type: str) -> DataFrame:
    """Rows as they go to the checks: content is de-duplicated, search is not."""
    return quality.dedup_by_id(raw) if data_type == "content" else raw


def run(spark: SparkSession, raw_root: str, bronze_root: str, data_type: str = "content",
        start=None, end=None, on_exceeded: str = "raise") -> list | None:
    """Fill bronze for a range of days and return the per-day report; None without raw data.

    The gate looks at each day on its own, before anything of that day is published. With ``raise``
    nothing is published when any day is over its limit. With ``hold`` the other days are published
    and the report says which were not (``held``). Days of the range that raw does not have lose their
    partitions; without a start and an end the tables are replaced whole, held days included.
    """
    if on_exceeded not in ("raise", "hold"):
        raise ValueError(f"Unknown on_exceeded: {on_exceeded}")
    rules = quality.rules_for(data_type)
    raw = or_missing(lambda: read_raw(spark, raw_root, data_type, start, end))
    if raw is None:
        return None
    tagged = quality.tag(prepare(raw, data_type), rules)
    staged = None
    if data_type == "content":
        # Parsing and de-duplication run once; report and both sinks read columns of this table.
        staged = staging_path(bronze_root)
        write_table(tagged, staged)
        tagged = spark.read.schema(tagged.schema).parquet(staged)
    try:
        report = quality.report(tagged, REJECTION_LIMITS[data_type])
        rows = report.collect() if on_exceeded == "hold" else quality.gate(report)  # one row per day
        _publish(spark, tagged, bronze_root, data_type, rows, start, end)
    finally:
        if staged is not None:
            delete_path(spark, staged)
    return rows


def held(report: list) -> list:
    """The days of a report that were over their limit and so not published."""
    return [r for r in report if r["exceeded"]]


def _publish(spark, tagged: DataFrame, root: str, data_type: str, report: list, start, end) -> None:
    good = [r for r in report if not r["exceeded"]]
    whole = start is None and end is None
    # The day list of one run, bounded by the calendar.
    publishable = tagged.where(F.col(LOAD_DATE).isin([r[LOAD_DATE] for r in good]))
    passed = F.col(quality.PASSED)
    if good:
        write_bronze(publishable.where(passed).drop(quality.PASSED),
                     publishable.where(~passed).drop(quality.PASSED), root, data_type)
    # A held day keeps what an earlier run published, unless everything is replaced.
    untouched = set() if whole else {r[LOAD_DATE] for r in held(report)}
    for path, count in ((table_path(root, data_type), "valid"), (quarantine_path(root, data_type), "invalid")):
        clear_range(spark, path, untouched | {r[LOAD_DATE] for r in good if r[count]}, start, end)
