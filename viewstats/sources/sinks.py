"""Day-partitioned and whole-table Parquet sinks; a re-run replaces, it never adds."""

from pyspark.sql import DataFrame, SparkSession

from viewstats.functions.dates import run_date
from viewstats.schemas import LOAD_DATE
from viewstats.sources.paths import delete_path, quarantine_path, stored_days, table_path


def write_days(df: DataFrame, path: str, day_column: str = LOAD_DATE, rebalance: bool = True,
               file_format: str = "parquet", whole_table: bool = False, append: bool = False) -> None:
    """Overwrite exactly the days present in ``df``, or with ``whole_table`` every stored day; with
    ``append`` only add files (see ``published``).

    Shuffled frames hold every day in every task, so rows are first rebalanced by day: AQE then
    packs small days together and splits a day that is larger than the advisory partition size.
    Frames that were only projected from a day-partitioned table skip that shuffle.
    """
    rows = df.hint("rebalance", day_column) if rebalance else df
    overwrite = "static" if whole_table else "dynamic"
    (rows.write.mode("append" if append else "overwrite").option("partitionOverwriteMode", overwrite)
         .partitionBy(day_column).format(file_format).save(path))


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite a table that has no day partitions."""
    df.write.mode("overwrite").parquet(path)


def clear_days(spark: SparkSession, path: str, days: list[str], day_column: str = LOAD_DATE) -> None:
    """Drop day partitions that a re-run left without rows; overwriting alone would keep them."""
    for day in days:
        delete_path(spark, f"{path}/{day_column}={day}")


def clear_range(spark: SparkSession, path: str, kept, start=None, end=None,
                day_column: str = LOAD_DATE) -> None:
    """Drop the stored days from ``start`` to ``end`` that a run over that range gave no rows."""
    low, high = start and run_date(start), end and run_date(end)
    gone = [d for d in stored_days(spark, path, day_column)
            if d not in kept and (low is None or d >= low) and (high is None or d <= high)]
    clear_days(spark, path, gone, day_column)


def write_bronze(valid: DataFrame, invalid: DataFrame, root: str, data_type: str = "content") -> None:
    write_days(valid, table_path(root, data_type))
    write_days(invalid, quarantine_path(root, data_type))


def write_silver(tables: dict[str, DataFrame], root: str, rebalance: bool = True,
                 whole_table: bool = False) -> None:
    for name, df in tables.items():
        write_days(df, table_path(root, "content", name), rebalance=rebalance,
                   whole_table=whole_table)


def write_search_trending(trending: DataFrame, root: str) -> None:
    write_table(trending, table_path(root, "search", "search_trending"))
