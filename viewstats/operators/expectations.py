"""Assertions on finished tables; each check is one row with its number of failures."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from viewstats.operators.gold import KPI_COLUMNS, on_day
from viewstats.schemas import LOAD_DATE

TRENDING_VALUES = ["Changed", "Unchanged"]


class ExpectationError(RuntimeError):
    """A gold model broke one of its declared expectations."""


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """All columns in one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (counts.unpivot([], columns, "column_name", "failures")
                  .select(F.lit("not_null").alias("check"), "column_name", "failures"))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    repeated = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
                  .where(F.col("n") > 1))
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit("unique").alias("check"), F.lit(column).alias("column_name"), "failures")


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is outside the domain; NULL is the business of ``not_null``."""
    return df.agg(F.count_if(~F.col(column).isin(values)).alias("failures")).select(
        F.lit("accepted_values").alias("check"), F.lit(column).alias("column_name"), "failures")


def contracts_reconcile(stats: DataFrame, summary: DataFrame, target_date=None) -> DataFrame:
    """Per day: do the distinct contracts of contract_stats equal the summary's active contracts?
    A day that only one of the two has does not match."""
    seen = (on_day(stats, target_date).where(F.col("contract").isNotNull())
            .groupBy(LOAD_DATE).agg(F.count_distinct(F.trim("contract")).alias("total_dau")))
    reported = on_day(summary, target_date).select(LOAD_DATE, "active_contracts")
    matches = F.coalesce(F.col("total_dau") == F.col("active_contracts"), F.lit(False)).cast("int")
    return seen.join(reported, LOAD_DATE, "full_outer").withColumn("matches", matches)


def reconcile_checks(stats: DataFrame, summary: DataFrame, target_date=None) -> DataFrame:
    """Days on which ``contracts_reconcile`` finds a difference, as a check."""
    days = contracts_reconcile(stats, summary, target_date)
    return days.agg(F.count_if(F.col("matches") == 0).alias("failures")).select(
        F.lit("contracts_reconcile").alias("check"), F.lit("active_contracts").alias("column_name"),
        "failures")


def kpi_checks(kpis: DataFrame) -> DataFrame:
    return not_null(kpis, KPI_COLUMNS).unionByName(unique(kpis, "date"))


def contract_checks(model: DataFrame) -> DataFrame:
    return not_null(model, ["contract", "date"])


def trending_checks(trending: DataFrame) -> DataFrame:
    return not_null(trending, trending.columns).unionByName(
        accepted_values(trending, "trending_type", TRENDING_VALUES))


def require(*checks: DataFrame) -> None:
    """Raise when a check has failures. A check is a handful of rows, one per declaration."""
    failed = reduce(DataFrame.unionByName, checks).where(F.col("failures") > 0).collect()
    if failed:
        raise ExpectationError(", ".join(
            f"{r['check']}({r['column_name']}): {r['failures']}" for r in failed))
