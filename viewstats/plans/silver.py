"""Bronze -> silver, for content (seven day-partitioned tables) and search (one table)."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.functions import run_date
from viewstats.operators import content, search
from viewstats.schemas import BRONZE_CONTENT, CONTRACT_STATS, LOAD_DATE
from viewstats.sources.layers import or_missing, read_history, read_last_day, read_table
from viewstats.sources.paths import table_path
from viewstats.sources.published import Publication
from viewstats.sources.sinks import write_search_trending

CONTENT_TABLES = [
    "contract_stats", "daily_summary", "contract_most_watch", "contract_taste", "contract_type",
    "contract_activeness", "contract_clinginess"]


def content_tables(bronze: DataFrame) -> dict[str, DataFrame]:
    """All seven tables as lazy frames over one bronze frame, counting its days as the history."""
    stats = content.contract_stats(content.enrich(bronze))
    types = content.contract_type(stats)
    return {
        "contract_stats": stats,
        "daily_summary": content.daily_summary(stats, content.platform_devices(bronze)),
        "contract_most_watch": content.most_watch(stats),
        "contract_taste": content.taste(stats),
        "contract_type": types,
        "contract_activeness": content.activeness_carried(stats, days=bronze),
        "contract_clinginess": content.clinginess_as_of(types),
    }


def _before(day) -> str:
    return (date.fromisoformat(run_date(day)) - timedelta(days=1)).isoformat()


def run_content(spark: SparkSession, bronze_root: str, silver_root: str,
                start=None, end=None, mode: str = "as_of") -> dict[str, str] | None:
    """Fill the content tables for a range of days; None without bronze data.

    contract_stats is written once and the other tables are derived from the stored days. Active
    days of earlier history come from the last stored day of contract_activeness, which has every
    contract seen up to it, so after a day in the middle is changed, the days that follow it have to
    be run again as well. Days of the range that bronze does not have lose their partitions in all
    seven tables; without a start and an end the tables are replaced whole.

    ``mode`` is how contract_activeness and contract_clinginess count: ``as_of`` each day (the stored
    table then carries every contract on every day, so it grows with contracts times days), ``prior``
    days only, or the whole stored ``snapshot``.
    """
    bronze = or_missing(lambda: read_table(
        spark, bronze_root, "content", start=start, end=end, schema=BRONZE_CONTENT))
    paths = {name: table_path(silver_root, "content", name) for name in CONTENT_TABLES}
    empty = bronze is None or bronze.isEmpty()
    with Publication(spark, table_path(silver_root, "content"), CONTENT_TABLES) as run_tables:
        if not empty:
            _write_content(spark, run_tables, bronze, silver_root, start, mode)
        run_tables.publish(start, end)
    return None if empty else paths


def _write_content(spark: SparkSession, tables: Publication, bronze: DataFrame, silver_root: str,
                   start, mode: str) -> None:
    tables.write("contract_stats", content.contract_stats(content.enrich(bronze)))
    stats = tables.read("contract_stats", CONTRACT_STATS)
    earlier = _earlier(spark, silver_root, start, mode)
    # Projections of stored day partitions: no shuffle before the write.
    tables.write("contract_most_watch", content.most_watch(stats), rebalance=False)
    tables.write("contract_taste", content.taste(stats), rebalance=False)
    tables.write("contract_type", content.contract_type(stats), rebalance=False)
    tables.write("daily_summary", content.daily_summary(stats, content.platform_devices(bronze)))
    for name, rows in _activeness_tables(stats, tables.read("contract_type"), earlier, mode).items():
        tables.write(name, rows)


def _earlier(spark: SparkSession, silver_root: str, start, mode: str) -> DataFrame | None:
    """What was active before ``start``: one stored day of counts where they are as-of counts, else
    the days of contract_stats."""
    if start is None:
        return None
    if mode == "as_of":
        last = read_last_day(spark, silver_root, "contract_activeness", start)
        if last is not None:
            return last.select("contract", F.col("activeness").alias(content.ACTIVE_DAYS))
    return read_history(spark, silver_root, "contract_stats", CONTRACT_STATS, _before(start))


def _activeness_tables(stats: DataFrame, types: DataFrame, earlier, mode: str) -> dict[str, DataFrame]:
    if mode == "as_of":
        return {"contract_activeness": content.activeness_carried(stats, earlier),
                "contract_clinginess": content.clinginess_as_of(types, earlier)}
    active = content.activeness(stats, mode, earlier)
    return {"contract_activeness": active, "contract_clinginess": content.clinginess(types, active)}


def run_search(spark: SparkSession, bronze_root: str, silver_root: str,
               months: tuple[str, str] = search.MONTHS,
               labels: tuple[str, str] = search.MONTH_LABELS) -> str | None:
    """Rebuild search_trending from the two months; None without bronze data."""
    bronze = or_missing(lambda: read_table(spark, bronze_root, "search"))
    if bronze is None:
        return None
    write_search_trending(search.trending(bronze, months, labels), silver_root)
    return table_path(silver_root, "search", "search_trending")


def run(spark: SparkSession, bronze_root: str, silver_root: str, data_type: str = "content",
        start=None, end=None, mode: str = "as_of", months: tuple[str, str] = search.MONTHS,
        labels: tuple[str, str] = search.MONTH_LABELS):
    """Search always covers its two months, so a day range applies to content only."""
    if data_type == "content":
        return run_content(spark, bronze_root, silver_root, start, end, mode)
    if data_type == "search":
        return run_search(spark, bronze_root, silver_root, months, labels)
    raise ValueError(f"Unknown data_type: {data_type}")


def backfill_most_watch_taste(spark: SparkSession, silver_root: str, start=None, end=None):
    """Derive both tables again from stored contract_stats; returns contracts per refilled day."""
    stats = or_missing(lambda: read_table(
        spark, silver_root, "content", "contract_stats", start, end, CONTRACT_STATS))
    if stats is None:
        return None
    with Publication(spark, table_path(silver_root, "content"), ["contract_most_watch", "contract_taste"]) as tables:
        tables.write("contract_most_watch", content.most_watch(stats), rebalance=False)
        tables.write("contract_taste", content.taste(stats), rebalance=False)
        tables.publish_written()
    return stats.groupBy("_load_date").count()
