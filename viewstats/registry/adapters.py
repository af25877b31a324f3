"""Viewing and search logs derived row by row from the whole ``events`` table."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.operators.quality import content_rules, search_rules, split
from viewstats.schemas import LOAD_DATE

APPS = ["CHANNEL", "DSHD", "KPLUS", "KPlus", "VOD", "FIMS", "FIMS_RES", "BHD", "BHD_RES",
        "VOD_RES", "DANET", "RELAX", "CHILD", "SPORT", "UNKNOWN", None]
KEYWORDS = ["VTV3 trực tiếp", "Bóng đá", "tiếng anh lớp 5", "Doraemon", "NARUTO",
            "đấu la đại lục", "hoa thiên cốt", "Squid Game", "annabelle", "hài tết", "minions",
            "avengers", "yêu", "abcxyz", "kênh bóng đá", "Conan tình yêu", None]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # props is always {"k": <number>}; cutting it out is far cheaper than a JSON parse per use.
    k = F.substring_index(F.substring_index("props", ":", -1), "}", 1).cast("int")
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", k)


def _pick(values: list, index: F.Column) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content log rows."""
    k, user = F.col("k"), F.col("user_id")
    seconds = F.floor("value").cast("bigint")
    return _events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("_id"),
        F.when(k != 98, F.concat(F.lit("C"), user.cast("string"))).alias("contract"),
        F.when(k != 97, F.concat(F.lit("M"), (user * 2 + k % 3).cast("string"))).alias("mac"),
        F.when(k == 99, -1 - seconds).when(k != 96, seconds).alias("total_duration"),
        _pick(APPS, k % 16).alias("app_name"),
        F.col("ts").cast("date").cast("string").alias(LOAD_DATE),
    )


def session_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions; those of an even number of seconds again, once as they are and once a second
    longer; and for every tenth a line that could not be parsed."""
    rows = sessions(spark, sf_dir)
    even = rows.where(F.col("total_duration") % 2 == 0)
    longer = even.withColumn("total_duration", F.col("total_duration") + 1)
    broken = rows.where(F.col("_id").cast("bigint") % 10 == 0).select(
        *[F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes if c != LOAD_DATE], LOAD_DATE)
    return rows.unionByName(even).unionByName(longer).unionByName(broken)


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search log rows; the January days are spread over June and July 2022."""
    day = F.date_add(F.lit("2022-06-01").cast("date"), 2 * (F.dayofmonth("ts") - 1))
    return _events(spark, sf_dir).select(
        F.col("user_id"), _pick(KEYWORDS, F.col("k") % 17).alias("keyword"),
        day.cast("string").alias(LOAD_DATE))


def bronze_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(sessions(spark, sf_dir), content_rules())[0]


def bronze_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(searches(spark, sf_dir), search_rules())[0]


def content_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions as raw JSON lines (``value``) with their load date."""
    source = F.struct(
        F.col("contract").alias("Contract"), F.col("mac").alias("Mac"),
        F.col("total_duration").alias("TotalDuration"), F.col("app_name").alias("AppName"))
    return sessions(spark, sf_dir).select(
        F.to_json(F.struct("_id", source.alias("_source"))).alias("value"), LOAD_DATE)
