"""Dropped day files -> raw layer, one job for all days."""

from pyspark.sql import SparkSession

from viewstats.sources import ledger
from viewstats.sources.layers import or_missing
from viewstats.sources.paths import table_path
from viewstats.sources.raw import read_drop
from viewstats.sources.sinks import write_days


def land(spark: SparkSession, drop: str, raw_root: str, data_type: str = "content",
         start=None, end=None) -> str | None:
    """Write dropped files under their load date; None when there is nothing to land."""
    rows = or_missing(lambda: read_drop(spark, drop, data_type, start, end))
    if rows is None:
        return None
    target = table_path(raw_root, data_type)
    _write(rows, target, data_type)
    return target


def _write(rows, target: str, data_type: str) -> None:
    write_days(rows, target, file_format="text" if data_type == "content" else "parquet")


def land_new(spark: SparkSession, drop: str, raw_root: str, data_type: str = "content",
             start=None, end=None) -> list[str] | None:
    """Land the days that have a file which is new or changed since it was landed, and enter their files
    in the ledger; the days, or None when there is nothing to land.

    Such a day is landed whole, from all files the drop has for it, as ``land`` does; files of other days
    are listed and not opened. The ledger is written after the rows, with sizes and times from before
    they were read: a run that dies in between, or a file that changes meanwhile, lands its day again.
    """
    files = ledger.dropped_files(spark, drop, data_type, start, end)
    if files is None:
        return None
    days = ledger.pending_days(files, ledger.read_ledger(spark, raw_root, data_type),
                               ledger.landed_days(spark, raw_root, data_type))
    if not days:
        return None
    _write(read_drop(spark, ledger.paths_of(files, days), data_type), table_path(raw_root, data_type), data_type)
    ledger.record(files, raw_root, data_type, days)
    return days
