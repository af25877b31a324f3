"""Readers for bronze and silver tables; a day or range prunes partitions."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from viewstats.functions.dates import load_date_range, run_date
from viewstats.schemas import LOAD_DATE
from viewstats.sources import published
from viewstats.sources.paths import stored_days, table_path

_MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def or_missing(read):
    """Run a reader; a path that does not exist gives None, any other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if (error.getCondition() or "").split(".")[0] in _MISSING:
            return None
        raise


def read_table(spark: SparkSession, root: str, data_type: str, table: str | None = None,
               start=None, end=None, schema: T.StructType | None = None) -> DataFrame:
    """A day-partitioned table, or only the days from ``start`` to ``end``.

    Search bronze passes on whatever columns a day's files had, so its days are merged. While a run
    is publishing tables, or after it died, they are read as the last finished run left them.
    """
    df = None if table is None else published.read(
        spark, table_path(root, data_type), table, start, end, schema)
    if df is None:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        if schema is None and table is None and data_type.startswith("search"):
            reader = reader.option("mergeSchema", "true")
        df = reader.parquet(table_path(root, data_type, table))
    if LOAD_DATE not in df.columns:
        return df
    return (df.where(load_date_range(F.col(LOAD_DATE), start, end))
              .withColumn(LOAD_DATE, F.col(LOAD_DATE).cast("string")))


def read_day(spark: SparkSession, root: str, data_type: str, day, **kwargs) -> DataFrame:
    return read_table(spark, root, data_type, start=day, end=day, **kwargs)


def read_last_day(spark: SparkSession, root: str, table: str, before, **kwargs) -> DataFrame | None:
    """The last stored day of a silver content table before a day; None if there is none."""
    days = published.days_of(spark, table_path(root, "content"), table)
    if days is None:
        days = stored_days(spark, table_path(root, "content", table))
    earlier = [d for d in days if d < run_date(before)]
    return read_day(spark, root, "content", earlier[-1], table=table, **kwargs) if earlier else None


def read_history(spark: SparkSession, root: str, table: str, schema: T.StructType,
                 end=None) -> DataFrame:
    """A silver content table up to ``end``; an absent table is an empty frame of that schema."""
    df = or_missing(lambda: read_table(spark, root, "content", table, end=end, schema=schema))
    return df if df is not None else spark.createDataFrame([], schema)
