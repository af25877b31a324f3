"""Top keywords per user and month, and the shift of interest between two months."""

from pyspark.sql import DataFrame, Window, functions as F

from viewstats.functions import keyword_category, month_bounds
from viewstats.schemas import LOAD_DATE

MONTHS = ("2022-06", "2022-07")
MONTH_LABELS = ("june", "july")


def in_month(df: DataFrame, month: str) -> DataFrame:
    """Rows of one month (``yyyy-MM``), as a half-open date range that prunes day partitions."""
    first, following = month_bounds(month)
    return df.where((F.col(LOAD_DATE) >= first) & (F.col(LOAD_DATE) < following))


def keyword_counts(df: DataFrame) -> DataFrame:
    return (df.where(F.col("user_id").isNotNull() & F.col("keyword").isNotNull())
              .groupBy("user_id", "keyword").agg(F.count("*").alias("times")))


def _winners(counts: DataFrame) -> DataFrame:
    """Each user's most frequent keywords by rank. Spark limits every task to its own winners before
    the shuffle, so what meets per user is the ties and each task's best."""
    by_user = Window.partitionBy("user_id").orderBy(F.col("times").desc())
    return counts.withColumn("_rank", F.rank().over(by_user)).where("_rank = 1").drop("_rank")


def _split_winners(counts: DataFrame) -> DataFrame:
    """The same rows without bringing a user's ties into one task: the counts are joined with the user's
    highest count. That one is combined before it is shuffled; AQE sends it to the counts where it is
    measured to be small, and else splits the large partitions of the join."""
    highest = counts.groupBy("user_id").agg(F.max("times").alias("times"))
    return counts.join(highest, ["user_id", "times"])


def top_keyword(df: DataFrame, label: str, split_ties: bool = True) -> DataFrame:
    """Each user's most frequent keywords, all ties kept.

    ``split_ties`` spreads a user whose keywords all tie over many tasks. It bounds what a task holds;
    the rank has fewer stages where the ties are joined by user anyway.
    """
    counts = keyword_counts(df)
    winners = _split_winners(counts) if split_ties else _winners(counts)
    return winners.select("user_id", F.col("keyword").alias(f"most_search_{label}"))


def trending(df: DataFrame, months: tuple[str, str] = MONTHS,
             labels: tuple[str, str] = MONTH_LABELS) -> DataFrame:
    """Top keywords of both months side by side, their categories and whether these differ.

    Keywords are classified before the join, once per top keyword and not once per joined pair. The
    ranks leave both months partitioned by user, so the join needs no shuffle of its own; it pairs
    every tie of one month with every tie of the other, by definition.
    """
    first, second = [
        top_keyword(in_month(df, month), label, split_ties=False).withColumn(
            f"category_{label}", keyword_category(F.col(f"most_search_{label}")))
        for month, label in zip(months, labels)]
    before, after = [F.col(f"category_{label}") for label in labels]
    joined = first.join(second, "user_id")
    shift = F.when(before == after, "Unchanged").otherwise("Changed")
    previous = F.when(before == after, "Unchanged").otherwise(F.concat_ws("; ", before, after))
    return joined.select(
        "user_id", *[f"most_search_{label}" for label in labels],
        *[f"category_{label}" for label in labels],
        shift.alias("trending_type"), previous.alias("previous"))
