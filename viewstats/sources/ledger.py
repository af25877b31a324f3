"""Ledger of landed files: which dropped files, by path, size and time, make up each raw day."""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.functions.dates import load_date_range
from viewstats.schemas import LOAD_DATE
from viewstats.sources.layers import or_missing
from viewstats.sources.paths import delete_path, stored_days, table_path
from viewstats.sources.raw import day_from_path
from viewstats.sources.sinks import write_days

LEDGER = "_landed_files"
SCHEMA = f"path string, size long, modified timestamp, {LOAD_DATE} string"
_FILE = ["path", "size", "modified", LOAD_DATE]
_PATTERN = {"content": "*", "search": "*.parquet"}


def ledger_path(raw_root: str, data_type: str) -> str:
    return table_path(raw_root, LEDGER, data_type)


def read_ledger(spark: SparkSession, raw_root: str, data_type: str) -> DataFrame:
    """The files that each landed day was made from; empty before the first landing."""
    landed = or_missing(lambda: spark.read.schema(SCHEMA).parquet(ledger_path(raw_root, data_type)))
    if landed is None:
        return spark.createDataFrame([], SCHEMA)
    return landed.withColumn(LOAD_DATE, F.col(LOAD_DATE).cast("string"))


def dropped_files(spark: SparkSession, drop: str, data_type: str, start=None, end=None) -> DataFrame | None:
    """Path, size, time and load date of dropped files, from one listing: no file is opened. Files that
    name no day are left out. None without a drop folder."""
    reader = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", _PATTERN[data_type]))
    files = or_missing(lambda: reader.load(drop))
    if files is None:
        return None
    dated = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
                         day_from_path(F.col("path")).alias(LOAD_DATE))
    return (dated.where(F.col(LOAD_DATE).isNotNull() & load_date_range(F.col(LOAD_DATE), start, end))
                 .withColumn(LOAD_DATE, F.col(LOAD_DATE).cast("string")))


def pending_days(files: DataFrame, ledger: DataFrame, landed: list[str]) -> list[str]:
    """Days with a file that is new or changed, or whose raw partition (``landed`` lists them) is gone.

    A file that left the drop asks for nothing: drops are cleared once they are landed.
    """
    known = ledger.where(F.col(LOAD_DATE).isin(landed)).select(*_FILE)
    days = files.join(known, _FILE, "left_anti").select(LOAD_DATE).distinct()
    return sorted(row[0] for row in days.collect())  # bounded by the calendar


def paths_of(files: DataFrame, days: list[str]) -> list[str]:
    """Paths of the files of these days, quoted, as readers take paths for patterns. Readers list their
    files on the driver anyway."""
    rows = files.where(F.col(LOAD_DATE).isin(days)).select("path").collect()
    return sorted(re.sub(r"([\\{}\[\]*?])", r"\\\1", row[0]) for row in rows)


def record(files: DataFrame, raw_root: str, data_type: str, days: list[str]) -> None:
    """Enter the files of landed days in place of what was entered for those days before."""
    write_days(files.where(F.col(LOAD_DATE).isin(days)).select(*_FILE), ledger_path(raw_root, data_type))


def forget(spark: SparkSession, raw_root: str, data_type: str) -> None:
    """Drop the ledger, so that the next landing takes every dropped file."""
    delete_path(spark, ledger_path(raw_root, data_type))


def landed_days(spark: SparkSession, raw_root: str, data_type: str) -> list[str]:
    return stored_days(spark, table_path(raw_root, data_type))
