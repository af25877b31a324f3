"""Days that fail alone: isolated, written to a ledger, tried again later.

A range stays one job. Only when it fails is it halved, so one bad day among n costs about 2 log2(n) more
jobs, and all other days go through in the largest ranges that hold no bad day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from py4j.protocol import Py4JError

from viewstats.functions import run_date
from viewstats.sources.layers import or_missing

LEDGER = "data_type string, layer string, day string, outcome string, error string, at timestamp"
FAILED, DONE = "failed", "done"
MOST = 10  # failing days after which a run gives up: then it is not the days


@dataclass(frozen=True)
class Failure:
    layer: str
    day: str
    error: Exception


class DaysFailed(RuntimeError):
    """Some days of a run failed; all others went through."""

    def __init__(self, failures: list[Failure]):
        super().__init__("; ".join(f"{f.layer} {f.day}: {_line(f.error)}" for f in failures))
        self.failures = failures


def _line(error: Exception) -> str:
    return (str(error).strip().splitlines() or [""])[0][:300]


def next_day(day: str) -> str:
    return (date.fromisoformat(day) + timedelta(days=1)).isoformat()


def by_range(job: Callable, layer: str, days: list[str], start=None, end=None, most: int = MOST):
    """Runs `job(start, end)` and, where it fails, its halves, down to single days. `days` are those the
    range has data for, in order. Returns the results that are not None, in order of days, and the
    failures. An open end of the range stays open, so a job still clears what lies beyond the data.

    Errors of the data are Spark's or Python's I/O errors; any other error, and more than `most` failing
    days, ends the run at once.
    """
    results, failures = [], []

    def attempt(days, start, end):
        try:
            result = job(start, end)
            results.extend([] if result is None else [result])
        except (PySparkException, Py4JError, OSError) as error:
            if len(days) < 2:
                failures.extend(Failure(layer, day, error) for day in days or [str(start)])
                if len(failures) > most:
                    raise DaysFailed(failures) from error
                if days:  # what lies around the day is still to be done
                    around(days[0], start, end)
                return
            middle = len(days) // 2
            attempt(days[:middle], start, days[middle - 1])
            attempt(days[middle:], next_day(days[middle - 1]), end)

    def around(day, start, end):
        """The parts of a range without data on both sides of a failed day, cleared by the job."""
        before = (date.fromisoformat(day) - timedelta(days=1)).isoformat()
        if start is None or run_date(start) < day:
            job(start, before)
        if end is None or run_date(end) > day:
            job(next_day(day), end)

    attempt(days, start, end)
    return results, failures


def record(spark: SparkSession, ledger: str, data_type: str, layer: str, outcomes: list[tuple]) -> None:
    """Adds (day, outcome, error) rows to a ledger."""
    at = datetime.now(timezone.utc)
    rows = [(data_type, layer, day, outcome, error, at) for day, outcome, error in outcomes]
    if rows:
        spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(ledger)


def open_days(spark: SparkSession, ledger: str, data_type: str) -> DataFrame:
    """(layer, day, error, at) of the days whose last entry is a failure."""
    rows = or_missing(lambda: spark.read.schema(LEDGER).parquet(ledger))
    if rows is None:
        rows = spark.createDataFrame([], LEDGER)
    last = F.row_number().over(Window.partitionBy("data_type", "layer", "day").orderBy(F.desc("at"), "outcome"))
    return (rows.where(F.col("data_type") == data_type).withColumn("last", last)
            .where((F.col("last") == 1) & (F.col("outcome") == FAILED)).select("layer", "day", "error", "at"))
