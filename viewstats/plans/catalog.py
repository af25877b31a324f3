"""Gold models as views of the session's catalog, which outlive the session that made them."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from viewstats.operators import gold
from viewstats.plans.gold import DATE, model_path
from viewstats.sources import published
from viewstats.sources.layers import or_missing

MODELS = ["gold_kpi_metrics", *gold.CONTRACT_MODELS, "gold_search_trending"]


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _query(spark: SparkSession, gold_root: str, name: str) -> str | None:
    """SQL over the stored files of a model; None without them.

    A model of days is read as it was published: only the files of the writes that each day had then,
    which Spark tells from the file names, so a run that is adding files is not seen halfway.
    """
    path = model_path(gold_root, name)
    stored = or_missing(lambda: published.read(spark, gold_root, name) or spark.read.parquet(path))
    if stored is None:
        return None
    columns = ", ".join(_quoted(c) for c in stored.columns)
    query = f"SELECT {columns} FROM parquet.{_quoted(path)}"
    if DATE not in stored.columns:
        return query
    state = published.marked(spark, gold_root)
    days = state["tables"][name] if state and name in state["tables"] else published.writes(spark, path, DATE)
    file = "element_at(split(_metadata.file_name, '/'), -1)"
    write = f"coalesce(nullif(regexp_extract({file}, {_literal(published._WRITE)}, 1), ''), {file})"
    live = ", ".join(_literal(f"{day}/{i}") for day, ids in days.items() for i in ids)
    return f"{query} WHERE concat(CAST({DATE} AS STRING), '/', {write}) IN ({live or 'NULL'})"


def publish(spark: SparkSession, gold_root: str, database: str = "gold", models=MODELS) -> list[str]:
    """Creates or replaces one view for each stored model in a database of the session's catalog and
    returns their names. A view of a model that is no longer stored is dropped.

    The views read files, so every session with the same catalog can query them, and they show what was
    stored when they were made: call this after each gold run (the chain does, given a database).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    made = []
    for name in models:
        view = f"{_quoted(database)}.{_quoted(name)}"
        query = _query(spark, gold_root.rstrip("/"), name)
        if query is None:
            spark.sql(f"DROP VIEW IF EXISTS {view}")
            continue
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
        made.append(name)
    return made


def days(spark: SparkSession, name: str, database: str = "gold") -> DataFrame:
    """Rows per day of a published model."""
    return spark.table(f"{_quoted(database)}.{_quoted(name)}").groupBy(DATE).agg(F.count("*").alias("n"))
