"""Per-contract and per-day viewing tables."""

from pyspark.sql import DataFrame, Window, functions as F

from viewstats.functions import clinginess_level, content_category, taste_profile, usage_level
from viewstats.operators.quantiles import discrete_quantiles
from viewstats.schemas import CATEGORY_LABELS, LOAD_DATE, STATS_CATEGORIES, SUMMARY_CATEGORIES

KEYS = ["contract", LOAD_DATE]
ACTIVE_DAYS = "_days"


def _earlier_days(earlier: DataFrame) -> DataFrame:
    """contract and its active days, from counts already made or from one row per active day."""
    if ACTIVE_DAYS in earlier.columns:
        return earlier.select("contract", ACTIVE_DAYS)
    return earlier.groupBy("contract").agg(F.count(LOAD_DATE).alias(ACTIVE_DAYS))


def enrich(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("type", content_category(F.col("app_name")))


def duration_by_category(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy(*KEYS, "type").agg(
        F.sum("total_duration").alias("duration_by_category"))


def devices_per_contract(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy(*KEYS).agg(F.count_distinct("mac").alias("total_devices"))


def platform_devices(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(LOAD_DATE).agg(F.count_distinct("mac").alias("unique_devices"))


def contract_stats(enriched: DataFrame) -> DataFrame:
    """Viewing time per category and distinct devices, one row per contract and day.

    One aggregate does the pivot and the device count together: no pivot-value job and no join.
    Spark combines by (contract, day, mac) before it combines by (contract, day), so a contract
    with very many rows is spread by device first. The columns are the same on every day.
    """
    per_category = [
        F.coalesce(F.sum(F.when(F.col("type") == c, F.col("total_duration"))), F.lit(0)).alias(c)
        for c in STATS_CATEGORIES]
    return (enriched.where(F.col("contract").isNotNull()).groupBy(*KEYS)
            .agg(*per_category, F.count_distinct("mac").alias("total_devices"))
            .select("contract", *STATS_CATEGORIES, "total_devices", LOAD_DATE))


def daily_summary(stats: DataFrame, devices: DataFrame) -> DataFrame:
    """Platform totals per day, from contract_stats and platform_devices.

    contract_stats has one row per contract and day, so counting rows counts contracts. The rest
    category is not part of the total.
    """
    totals = stats.groupBy(LOAD_DATE).agg(
        *[F.sum(c).alias(c) for c in SUMMARY_CATEGORIES],
        F.count("contract").alias("active_contracts"))
    total = sum((F.col(c) for c in SUMMARY_CATEGORIES[1:]), F.col(SUMMARY_CATEGORIES[0]))
    return (totals.join(devices, LOAD_DATE, "left")
            .withColumn("total_duration", total)
            .withColumn("avg_session_duration", F.col("total_duration") / F.col("active_contracts")))


def unpivot_categories(stats: DataFrame) -> DataFrame:
    """One row per contract, day and category label, from a single scan."""
    labelled = stats.select(
        *KEYS, *[F.coalesce(F.col(c), F.lit(0)).alias(label)
                 for c, label in CATEGORY_LABELS.items()])
    return labelled.unpivot(KEYS, list(CATEGORY_LABELS.values()), "category", "total_duration")


def most_watch(stats: DataFrame) -> DataFrame:
    """The categories with the longest viewing time; ties give one row each.

    The five durations of a contract sit in one row, so the best rank is a comparison with their
    maximum. That needs neither a window nor a shuffle.
    """
    durations = [F.coalesce(F.col(c), F.lit(0)) for c in CATEGORY_LABELS]
    longest = F.greatest(*durations)
    winners = F.array_compact(F.array(*[
        F.when(d == longest, label) for d, label in zip(durations, CATEGORY_LABELS.values())]))
    return stats.select("contract", F.explode(winners).alias("most_watch"), LOAD_DATE)


def taste(stats: DataFrame) -> DataFrame:
    return stats.select("contract", taste_profile().alias("taste"), LOAD_DATE)


def viewing_totals(stats: DataFrame) -> DataFrame:
    """Total viewing time per contract and day, the rest category included."""
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in STATS_CATEGORIES]
    return stats.select(*KEYS, sum(parts[1:], parts[0]).alias("total_duration"))


def usage_quartiles(totals: DataFrame) -> DataFrame:
    return discrete_quantiles(totals, LOAD_DATE, "total_duration", {"q1": 0.25, "q3": 0.75})


def contract_type(stats: DataFrame, quartiles: DataFrame | None = None) -> DataFrame:
    """Low below the day's first quartile, High above the third, else Medium."""
    totals = viewing_totals(stats)
    limits = quartiles
    if limits is None:  # one row per day: bounded by the calendar, so it is safe to broadcast
        limits = F.broadcast(usage_quartiles(totals))
    level = usage_level(F.col("total_duration"), F.col("q1"), F.col("q3"))
    return (totals.join(limits, LOAD_DATE)
            .select(*KEYS, "total_duration", level.alias("type")))


def with_activeness(rows: DataFrame, earlier: DataFrame | None = None,
                    count_own_day: bool = True) -> DataFrame:
    """Add how many days each contract was active up to that day.

    ``rows`` has one row per contract and day. ``earlier``, the history before the first of those
    days, has the same or one row per contract with its number of active days (``ACTIVE_DAYS``); it is
    one row per contract before it is shuffled with the rest, and no window partition outgrows the
    calendar.
    """
    counted = rows.withColumn("_days", F.lit(1).cast("long"))
    if earlier is not None:
        counted = counted.unionByName(_earlier_days(earlier), allowMissingColumns=True)
    upto = (Window.partitionBy("contract").orderBy(F.col(LOAD_DATE).asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    activeness = F.sum("_days").over(upto)
    if not count_own_day:
        activeness = activeness - F.col("_days")
    return (counted.withColumn("activeness", activeness).drop("_days")
            .where(F.col(LOAD_DATE).isNotNull()))


def activeness_snapshot(stats: DataFrame, as_of=None) -> DataFrame:
    """Active days per contract over everything stored, stamped with one day or the last one."""
    counts = stats.groupBy("contract").agg(F.count_distinct(LOAD_DATE).alias("activeness"))
    if as_of is not None:
        return counts.withColumn(LOAD_DATE, F.lit(as_of))
    return counts.withColumn(LOAD_DATE, stats.agg(F.max(LOAD_DATE)).scalar())


def activeness(stats: DataFrame, mode: str = "as_of", earlier: DataFrame | None = None) -> DataFrame:
    """Active days of each contract on each day it was active.

    ``as_of`` counts days up to and including the day, ``prior`` only earlier days (contracts seen
    for the first time have no row), ``snapshot`` all stored days whatever the day.
    """
    keys = stats.select(*KEYS)
    if mode == "as_of":
        return with_activeness(keys, earlier).select("contract", "activeness", LOAD_DATE)
    if mode == "prior":
        return (with_activeness(keys, earlier, count_own_day=False)
                .where(F.col("activeness") > 0).select("contract", "activeness", LOAD_DATE))
    if mode == "snapshot":
        if earlier is not None and ACTIVE_DAYS in earlier.columns:
            raise ValueError("a snapshot counts days; it cannot start from counts")
        stored = keys if earlier is None else keys.unionByName(earlier.select(*KEYS))
        counts = stored.groupBy("contract").agg(F.count_distinct(LOAD_DATE).alias("activeness"))
        return keys.join(counts, "contract").select("contract", "activeness", LOAD_DATE)
    raise ValueError(f"Unknown activeness mode: {mode}")


def activeness_carried(stats: DataFrame, earlier: DataFrame | None = None,
                       days: DataFrame | None = None) -> DataFrame:
    """Active days of every contract seen so far, on each day present in the data.

    A count holds from the contract's active day until its next one, so each active day is
    expanded over the days in between. Days without any data get no rows. ``days`` may be any
    cheaper frame with the same load dates, such as the bronze rows.
    """
    present = (days if days is not None else stats).select(LOAD_DATE).distinct()
    first_day = present.agg(F.min(LOAD_DATE)).scalar().cast("date")
    last_day = present.agg(F.max(LOAD_DATE)).scalar().cast("date")
    counted = stats.select(*KEYS).withColumn("_days", F.lit(1).cast("long"))
    if earlier is not None:
        counted = counted.unionByName(_earlier_days(earlier), allowMissingColumns=True)
    by_day = Window.partitionBy("contract").orderBy(F.col(LOAD_DATE).asc_nulls_first())
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = counted.select(
        "contract", F.sum("_days").over(upto).alias("activeness"),
        F.col(LOAD_DATE).cast("date").alias("_from"),
        F.lead(F.col(LOAD_DATE).cast("date")).over(by_day).alias("_next"))
    spans = held.select(
        "contract", "activeness",
        F.coalesce(F.col("_from"), first_day).alias("_from"),
        F.coalesce(F.date_sub("_next", 1), last_day).alias("_to"))
    daily = (spans.where(F.col("_from") <= F.col("_to"))
             .select("contract", "activeness", F.explode(F.sequence("_from", "_to")).alias("_day"))
             .select("contract", "activeness", F.col("_day").cast("string").alias(LOAD_DATE)))
    # The days present: bounded by the calendar.
    return daily.join(F.broadcast(present), LOAD_DATE, "left_semi").select(
        "contract", "activeness", LOAD_DATE)


def clinginess(types: DataFrame, active: DataFrame) -> DataFrame:
    """Engagement segment from usage level and active days, for contracts that have both."""
    joined = types.select(*KEYS, "type").join(active.select(*KEYS, "activeness"), KEYS)
    return _segment(joined)


def clinginess_as_of(types: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """The as-of segment in one shuffle: the running day count is added to the usage rows."""
    return _segment(with_activeness(types.select(*KEYS, "type"), earlier))


def _segment(df: DataFrame) -> DataFrame:
    level = clinginess_level(F.col("type"), F.col("activeness"))
    return df.select(*KEYS, "type", "activeness", level.alias("clinginess"))
