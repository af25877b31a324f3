"""Raw scans: content JSON lines and search Parquet, one or many days at once."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.functions.dates import load_date_range
from viewstats.schemas import LOAD_DATE, RAW_CONTENT
from viewstats.sources.layers import or_missing
from viewstats.sources.paths import table_path

# A landed file is ``<day>.json`` or sits in a folder named after its day.
_DAY_IN_PATH = r"/(?:[^/=]+=)?(\d{8})(?:\.json)?(?:/[^/]+)?$"


def flatten_content(lines: DataFrame) -> DataFrame:
    """``value`` (one JSON object) and ``_load_date`` -> bronze content columns.

    A line that cannot be parsed keeps its row, with every parsed field NULL.
    """
    parsed = lines.select(F.from_json("value", RAW_CONTENT).alias("doc"), LOAD_DATE)
    return parsed.select(
        F.col("doc._id").alias("_id"),
        F.col("doc._source.Contract").alias("contract"),
        F.col("doc._source.Mac").alias("mac"),
        F.col("doc._source.TotalDuration").alias("total_duration"),
        F.col("doc._source.AppName").alias("app_name"),
        LOAD_DATE,
    )


def _in_range(df: DataFrame, start, end) -> DataFrame:
    """Prune day folders, then give the partition column its string type."""
    return (df.where(load_date_range(F.col(LOAD_DATE), start, end))
              .withColumn(LOAD_DATE, F.col(LOAD_DATE).cast("string")))


def read_content(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    lines = spark.read.text(table_path(root, "content"))
    return flatten_content(_in_range(lines, start, end))


def read_search(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """Search rows with whatever columns the files carry, plus the load date."""
    reader = spark.read.option("mergeSchema", "true")
    return _in_range(reader.parquet(table_path(root, "search")), start, end)


_READERS = {"content": read_content, "search": read_search}


def read_raw(spark: SparkSession, root: str, data_type: str = "content",
             start=None, end=None) -> DataFrame:
    if data_type not in _READERS:
        raise ValueError(f"Unknown data_type: {data_type}")
    return _READERS[data_type](spark, root, start, end)


def day_from_path(path: F.Column | None = None) -> F.Column:
    """The day a file is named after, NULL for none; by default that of the file a row was read from."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.try_to_date(F.regexp_extract(path, _DAY_IN_PATH, 1), "yyyyMMdd")


def _landed(df: DataFrame, start, end) -> DataFrame:
    dated = df.withColumn(LOAD_DATE, day_from_path())
    return (dated.where(F.col(LOAD_DATE).isNotNull() & load_date_range(F.col(LOAD_DATE), start, end))
                 .withColumn(LOAD_DATE, F.col(LOAD_DATE).cast("string")))


def dropped_days(spark: SparkSession, drop: str) -> list[str]:
    """The days that dropped files are named after, from one listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    days = or_missing(lambda: files.load(drop).select(day_from_path().cast("string").alias("day")).distinct())
    return [] if days is None else sorted(r[0] for r in days.where("day IS NOT NULL").collect())


def undated_files(spark: SparkSession, drop: str) -> DataFrame:
    """Paths of dropped files that name no valid day and are therefore never landed."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(drop)
             .select(F.col("path").alias("_path")))
    return files.where(day_from_path(F.col("_path")).isNull()).select(F.col("_path").alias("path"))


def read_drop_content(spark: SparkSession, drop: str | list[str], start=None, end=None) -> DataFrame:
    """Lines of all dropped day files (of a folder, or of a list of files), dated by file name. Undated files are left
    alone; ``undated_files`` lists them."""
    return _landed(spark.read.option("recursiveFileLookup", "true").text(drop), start, end)


def read_drop_search(spark: SparkSession, drop: str | list[str], start=None, end=None) -> DataFrame:
    """Rows of all Parquet files in dropped day folders, dated by folder name."""
    reader = (spark.read.option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").option("mergeSchema", "true"))
    return _landed(reader.format("parquet").load(drop), start, end)


_DROP_READERS = {"content": read_drop_content, "search": read_drop_search}


def read_drop(spark: SparkSession, drop: str | list[str], data_type: str = "content",
              start=None, end=None) -> DataFrame:
    if data_type not in _DROP_READERS:
        raise ValueError(f"Unknown data_type: {data_type}")
    return _DROP_READERS[data_type](spark, drop, start, end)
