"""All layers of one data type, one after the other."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.functions import run_date
from viewstats.operators import quality
from viewstats.operators.search import MONTH_LABELS, MONTHS
from viewstats.plans import bronze, catalog, failures, gold, landing, silver
from viewstats.plans.ranges import day_range
from viewstats.schemas import LOAD_DATE
from viewstats.sources import published
from viewstats.sources.paths import stored_days, table_path
from viewstats.sources.raw import dropped_days


@dataclass(frozen=True)
class Roots:
    raw: str
    bronze: str
    silver: str
    gold: str
    drop: str | None = None
    ledger: str | None = None  # of failed days; beside the bronze tables by default

    @property
    def failures(self) -> str:
        return self.ledger or f"{self.bronze.rstrip('/')}/_failures"


def run(spark: SparkSession, roots: Roots, data_type: str = "content", mode: str = "incremental",
        start=None, end=None, today=None, on_exceeded: str = "raise", activeness: str = "as_of",
        months: tuple[str, str] = MONTHS, labels: tuple[str, str] = MONTH_LABELS,
        on_failure: str = "raise", database: str | None = None, new_only: bool = False) -> DataFrame | None:
    """Land, check, aggregate and publish a range of days; None when no layer has data for it.

    With ``on_exceeded="hold"`` the days over their limit stay out, all others go through every layer,
    and the error for the held days is raised at the end. With ``on_failure="hold"`` so do days that fail
    for any other reason of their data, in whichever layer: they keep what an earlier run stored for them
    and are written to the ledger, from which ``retry`` takes them. With a ``database`` the stored gold
    models are published there as views. ``new_only`` lands only days with new or changed dropped files.
    """
    if on_failure not in ("raise", "hold"):
        raise ValueError(f"Unknown on_failure: {on_failure}")
    start, end = day_range(mode, start, end, today)
    failed: list[failures.Failure] = []

    def layer(name: str, days, job):
        """The results of one layer's job over the range, or over the parts of it that do not fail."""
        if on_failure == "raise":
            result = job(start, end)
            return [] if result is None else [result]
        low, high = start and run_date(start), end and run_date(end)
        wanted = [d for d in days() if (low is None or d >= low) and (high is None or d <= high)]
        results, bad = failures.by_range(job, name, wanted, start, end)
        _write_ledger(spark, roots, data_type, name, wanted, bad)
        failed.extend(bad)
        return results

    content = data_type == "content"
    if roots.drop is not None:
        land = landing.land_new if new_only else landing.land
        layer("landing", lambda: dropped_days(spark, roots.drop),
              lambda s, e: land(spark, roots.drop, roots.raw, data_type, s, e))
    reports = layer("bronze", lambda: stored_days(spark, table_path(roots.raw, data_type)),
                    lambda s, e: bronze.run(spark, roots.raw, roots.bronze, data_type, s, e, on_exceeded))
    # Search covers its two months whatever the range, so there it is the whole table that fails or not.
    filled = layer("silver", lambda: stored_days(spark, table_path(roots.bronze, data_type)) if content else [],
                   lambda s, e: silver.run(spark, roots.bronze, roots.silver, data_type, s, e, activeness, months, labels))
    stored = layer("gold", lambda: _silver_days(spark, roots.silver) if content else [],
                   lambda s, e: gold.run(spark, roots.silver, roots.gold, data_type, s, e, labels))
    if database is not None:
        catalog.publish(spark, roots.gold, database)
    held = [day for report in reports for day in bronze.held(report)]
    if failed:
        raise failures.DaysFailed(failed + [
            failures.Failure("bronze", d[LOAD_DATE], quality.QualityGateError("over the rejection limit")) for d in held])
    quality.refuse(held)
    return stored[-1] if filled and stored else None


def _silver_days(spark: SparkSession, root: str) -> list[str]:
    folder = table_path(root, "content")
    days = published.days_of(spark, folder, "daily_summary")
    return stored_days(spark, f"{folder}/daily_summary") if days is None else days


def _write_ledger(spark, roots: Roots, data_type: str, layer: str, days: list[str], bad: list) -> None:
    outcomes = [(f.day, failures.FAILED, str(f.error)) for f in bad]
    lost = {f.day for f in bad}
    before = failures.open_days(spark, roots.failures, data_type).where(F.col("layer") == layer)
    mended = {r["day"] for r in before.collect()} & set(days) - lost  # one row per failed day
    failures.record(spark, roots.failures, data_type, layer,
                    outcomes + [(day, failures.DONE, None) for day in sorted(mended)])


def retry(spark: SparkSession, roots: Roots, data_type: str = "content", **kwargs) -> DataFrame | None:
    """Runs the days that the ledger has as failed, and the days after them, whose activeness counts
    them. None when no day is open. Arguments are those of ``run``."""
    first = failures.open_days(spark, roots.failures, data_type).agg(F.min("day"), F.max("day")).first()
    if first[0] is None:
        return None
    stored = stored_days(spark, table_path(roots.raw, data_type))
    return run(spark, roots, data_type, "date_range", first[0], max([first[1], *stored[-1:]]),
               **{"on_failure": "hold"} | kwargs)
