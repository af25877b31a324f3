"""Where tables live, which days they hold, and the few file operations Spark has no writer for."""

import uuid

from pyspark.sql import SparkSession

from viewstats.functions.dates import run_date
from viewstats.schemas import LOAD_DATE


def table_path(root: str, data_type: str, table: str | None = None, day=None) -> str:
    """``root/data_type[/table][/_load_date=day]``."""
    parts = [root.rstrip("/"), data_type]
    if table:
        parts.append(table)
    if day is not None:
        parts.append(f"{LOAD_DATE}={run_date(day)}")
    return "/".join(parts)


def quarantine_path(root: str, data_type: str) -> str:
    return table_path(root, f"{data_type}_quarantine")


def staging_path(root: str) -> str:
    """A fresh path beside the tables of a root, and so reachable by every executor that they are."""
    return f"{root.rstrip('/')}/.staging-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a table or day this library wrote itself."""
    files, hadoop_path = _file_system(spark, path)
    files.delete(hadoop_path, True)


def stored_days(spark: SparkSession, path: str, day_column: str = LOAD_DATE) -> list[str]:
    """The days a table has partitions for, from one folder listing; none without the table."""
    files, hadoop_path = _file_system(spark, path)
    if not files.exists(hadoop_path):
        return []
    names = (status.getPath().getName() for status in files.listStatus(hadoop_path))
    prefix = f"{day_column}="
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))
