"""Gold models over the silver tables."""

from pyspark.sql import DataFrame, functions as F

from viewstats.functions import run_date
from viewstats.functions.dates import load_date_range
from viewstats.operators.search import MONTH_LABELS
from viewstats.schemas import LOAD_DATE, SUMMARY_CATEGORIES

# Gold model -> silver columns it passes on, besides contract and date.
CONTRACT_MODELS = {
    "contract_most_watch": ["most_watch"],
    "contract_taste": ["taste"],
    "contract_type": ["total_duration", "type"],
    "contract_activeness": ["activeness"],
    "contract_clinginess": ["type", "activeness", "clinginess"],
}

KPI_COLUMNS = ["date", "total_duration", "active_contracts", "unique_devices", "avg_session_duration"]


def trending_columns(labels: tuple[str, str] = MONTH_LABELS) -> list[str]:
    months = [f"{column}_{label}" for label in labels for column in ("most_search", "category")]
    return ["user_id", *months, "trending_type", "previous"]


TRENDING_COLUMNS = trending_columns()


def in_days(df: DataFrame, start=None, end=None) -> DataFrame:
    return df.where(load_date_range(F.col(LOAD_DATE), start, end))


def on_day(df: DataFrame, target_date=None) -> DataFrame:
    if target_date is None:
        return df
    return df.where(F.col(LOAD_DATE) == F.lit(run_date(target_date)).cast("date"))


def kpi_metrics(summary: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in SUMMARY_CATEGORIES]
    per_day = summary.groupBy(F.col(LOAD_DATE).cast("date").alias("date")).agg(
        F.sum(sum(parts[1:], parts[0])).alias("total_duration"),
        F.max("active_contracts").alias("active_contracts"),
        F.max(F.coalesce(F.col("unique_devices"), F.lit(0))).alias("unique_devices"))
    average = F.when(F.col("active_contracts") == 0, F.lit(0.0)).otherwise(
        F.col("total_duration").cast("double") / F.col("active_contracts"))
    return per_day.withColumn("avg_session_duration", average)


def contract_model(name: str, silver: DataFrame, target_date=None) -> DataFrame:
    """One of CONTRACT_MODELS, for all days or for one."""
    return on_day(silver, target_date).select(
        "contract", F.col(LOAD_DATE).cast("date").alias("date"), *CONTRACT_MODELS[name])


def search_trending(silver: DataFrame, labels: tuple[str, str] = MONTH_LABELS) -> DataFrame:
    return silver.select(
        F.left(F.col("user_id").cast("string"), F.lit(50)).alias("user_id"),
        *trending_columns(labels)[1:])
