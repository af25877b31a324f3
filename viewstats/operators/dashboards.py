"""Aggregates behind the two dashboards."""

from pyspark.sql import DataFrame, Window, functions as F

from viewstats.operators.search import MONTH_LABELS
from viewstats.schemas import CATEGORY_LABELS, LOAD_DATE, SUMMARY_CATEGORIES


def kpi_cards(kpis: DataFrame) -> DataFrame:
    return kpis.withColumn("total_viewing_hours", F.col("total_duration") / 3600)


def type_distribution(summary: DataFrame) -> DataFrame:
    """Viewing time per content type over all days, and its share of the whole."""
    sums = summary.agg(*[F.sum(c).alias(CATEGORY_LABELS[c]) for c in SUMMARY_CATEGORIES])
    labels = [CATEGORY_LABELS[c] for c in SUMMARY_CATEGORIES]
    whole = sums.withColumn("_all", sum((F.col(x) for x in labels[1:]), F.col(labels[0])))
    long = whole.unpivot(["_all"], labels, "content_type", "total_duration")
    share = F.when(F.col("_all") == 0, F.lit(0.0)).otherwise(F.col("total_duration") / F.col("_all"))
    return long.select("content_type", "total_duration", share.alias("share"))


def daily_trend(summary: DataFrame) -> DataFrame:
    return summary.select(F.col(LOAD_DATE).cast("date").alias("date"), "total_duration")


def clinginess_segments(segments: DataFrame) -> DataFrame:
    return segments.groupBy(LOAD_DATE, "clinginess").agg(F.count("*").alias("contracts"))


def taste_matrix(tastes: DataFrame) -> DataFrame:
    return tastes.groupBy(LOAD_DATE, "taste").agg(F.count("*").alias("contracts"))


def category_transitions(trending: DataFrame, labels: tuple[str, str] = MONTH_LABELS) -> DataFrame:
    return trending.groupBy(*[f"category_{x}" for x in labels]).agg(F.count("*").alias("n"))


def changed_split(trending: DataFrame) -> DataFrame:
    return trending.groupBy("trending_type").agg(F.count_distinct("user_id").alias("users"))


def top_keywords(searches: DataFrame, k: int = 10) -> DataFrame:
    """The k most searched keywords of each month by rank, ties at the end included.

    Ranking the keywords themselves would sort a whole month in one task. The rank of a keyword
    depends only on how many keywords have a higher count, so the distinct counts are ranked: N
    searches have at most sqrt(2 * N) of them. At most k counts per month survive, and those
    select the keywords.
    """
    totals = (searches.where(F.col("keyword").isNotNull())
              .groupBy(F.substring(LOAD_DATE, 1, 7).alias("month"), "keyword")
              .agg(F.count("*").alias("times")))
    above = (Window.partitionBy("month").orderBy(F.col("times").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    ranks = (totals.groupBy("month", "times").agg(F.count("*").alias("_keywords"))
             .withColumn("rank", F.coalesce(F.sum("_keywords").over(above), F.lit(0)) + 1)
             .where(F.col("rank") <= k).select("month", "times", "rank"))
    # At most k rows per month.
    return totals.join(F.broadcast(ranks), ["month", "times"]).select(
        "month", "keyword", "times", "rank")
