"""Helpers the operators share: text conventions, scratch space in the shared folder, size checks."""

from __future__ import annotations

import contextlib
import gc
import sys
import time
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstats.sources.paths import delete_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def quoted(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with signs before them that make them differ from every column of `df`."""
    taken = {c.lower() for c in df.columns}
    before = "__"
    while any(f"{before}{name}".lower() in taken for name in wanted):
        before += "_"
    return [before + name for name in wanted]


def numbered_columns(df: DataFrame) -> DataFrame:
    """The same columns under plain names, for `mapInArrow`, which takes a dot for a field's."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. `lower` knows all of Unicode but is much faster, and the two
    agree on texts of one byte per character."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_LOWER))


def text_bytes(text: str) -> Column:
    return F.octet_length(whole(text)).cast("long")


def word_count(text: str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where it is set, as on every cluster, else
    a folder in the session's warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Lets go of the shuffle files of steps whose results have been cut. Spark removes them once the
    driver's collector has seen that nothing refers to them any more, which may otherwise be long after
    the job: call it where no variable holds such a step."""
    for _ in range(2):  # the first finds what the second can let go of
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, so that later steps neither recompute nor lose them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """DataFrames made inside lose their shuffle files as soon as an action on them ends. An action that
    is repeated makes them again."""
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before)


class Scratchpad:
    """Tables of a job of many steps, in the shared folder. Each step's rows are written, so that later
    steps neither recompute nor lose them; a table goes when nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.tables = spark, scratch(spark, name), []

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.tables)}"
        with shuffles_dropped(self.spark):
            df.select("*").write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((kept, path))
        return kept

    def drop(self, *gone: DataFrame) -> None:
        """Removes tables that `keep` returned."""
        for kept, path in self.tables:
            if any(kept is df for df in gone):
                delete_path(self.spark, path)

    def clear(self) -> None:
        delete_path(self.spark, self.root)


class Memo(dict):
    """Remembers what `make` gives for the latest keys, between `most` and twice as many of them, none
    longer than `longest`."""

    def __init__(self, make: Callable, most: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def kept(name: str, make: Callable):
    """What `make` gives, made once per Python process. Every task unpickles this package anew, so what
    is to outlive a task lies in a module of its own."""
    home = sys.modules.setdefault("viewstats_kept", types.ModuleType("viewstats_kept"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)
