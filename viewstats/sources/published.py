"""Tables of one folder that change together.

A run adds its files beside the published ones and only then replaces them, all tables at once. A marker
beside the tables names, for every table of the run and every day, which writes readers may see: first the
published ones, so that a run that fails or dies between two tables has changed nothing. The run is
published by putting the second marker there, one rename, which names the new writes; superseded files
and the markers are removed after it. Without a marker a table is what its folder holds.

A run that died is settled by the next one: without the second marker its files are removed, with it the
superseded ones are. So one run at a time may write to a folder.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from viewstats.functions.dates import load_date_range, run_date
from viewstats.schemas import LOAD_DATE
from viewstats.sources.paths import _file_system, delete_path
from viewstats.sources.sinks import write_days

BEFORE, AFTER = "_publishing-before", "_publishing-after"
# Spark gives all files of one write the same id.
_WRITE = r"part-\d+-([0-9a-f]{8}-[0-9a-f-]{27})"

State = dict[str, dict[str, list[str]]]  # table -> day -> ids of the writes that readers see


def _text(spark: SparkSession, path: str) -> str | None:
    files, hadoop_path = _file_system(spark, path)
    if not files.exists(hadoop_path):
        return None
    stream = files.open(hadoop_path)  # Spark's readers pass hidden files by
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, state: dict) -> None:
    """Writes a marker; it appears whole or not at all."""
    files, hadoop_path = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if not files.rename(draft, hadoop_path):
        raise RuntimeError(f"another run is writing here: {path}")


def marked(spark: SparkSession, folder: str) -> dict | None:
    """What the marker of a folder says, None without one."""
    for name in (AFTER, BEFORE):
        text = _text(spark, f"{folder}/{name}")
        if text is not None:
            return json.loads(text) | {"after": name == AFTER}
    return None


def writes(spark: SparkSession, path: str, day_column: str) -> dict[str, list[str]]:
    """The writes that have files in each day of a table, from one listing."""
    files, pattern = _file_system(spark, f"{path}/{day_column}=*/[!._]*")
    found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.globStatus(pattern))
    # All paths in one call: one call for each is slow for large tables.
    listed = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found).mkString("\n")
    days: dict[str, set[str]] = {}
    for day, name in re.findall(rf"/{day_column}=([^/]+)/([^/]+)$", listed, re.M):
        found = re.match(_WRITE, name)
        days.setdefault(unquote(day), set()).add(found[1] if found else name)
    return {day: sorted(ids) for day, ids in sorted(days.items())}


def _read(spark: SparkSession, path: str, days: dict[str, list[str]], day_column: str,
          start=None, end=None, schema: T.StructType | None = None) -> DataFrame | None:
    """The files of the given writes; None if there are none at all."""
    if not days:
        return None
    low, high = start and run_date(start), end and run_date(end)
    wanted = [d for d in days if (low is None or d >= low) and (high is None or d <= high)]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    # An empty range still has the columns of the table.
    globs = [f"{path}/{day_column}={d}/*{write}*" for d in wanted or list(days)[:1] for write in days[d]]
    df = reader.option("basePath", path).parquet(*globs)
    return df.where(load_date_range(F.col(day_column), start, end))


def read(spark: SparkSession, folder: str, table: str, start=None, end=None,
         schema: T.StructType | None = None) -> DataFrame | None:
    """A table as its folder's marker has it, with its day column as stored; None where no marker speaks
    of the table, so that the folder is to be read as it is."""
    state = marked(spark, folder)
    if state is None or table not in state["tables"]:
        return None
    df = _read(spark, f"{folder}/{table}", state["tables"][table], state["day"], start, end, schema)
    if df is None:  # the run that is under way, or died, is the table's first
        df = spark.read.parquet(f"{folder}/{table}/{BEFORE}")  # raises as for a missing table
    return df


def days_of(spark: SparkSession, folder: str, table: str) -> list[str] | None:
    """The days of a table that the marker speaks of; None as in `read`."""
    state = marked(spark, folder)
    return None if state is None or table not in state["tables"] else sorted(state["tables"][table])


def _clear(spark: SparkSession, folder: str, state: dict, present: State) -> None:
    """Removes the files of `present` writes that the state does not keep, then the markers."""
    for table, kept in state["tables"].items():
        path = f"{folder}/{table}"
        for day, ids in present[table].items():
            if day not in kept:
                delete_path(spark, f"{path}/{state['day']}={day}")
                continue
            for write in set(ids) - set(kept[day]):
                files, pattern = _file_system(spark, f"{path}/{state['day']}={day}/*{write}*")
                for status in files.globStatus(pattern):
                    files.delete(status.getPath(), False)
        if not kept:
            delete_path(spark, path)
    for name in (BEFORE, AFTER):  # in this order: without the first, the second still says what is kept
        delete_path(spark, f"{folder}/{name}")


def settle(spark: SparkSession, folder: str) -> None:
    """Finishes a run that was published but not cleared up, takes back one that was not published."""
    state = marked(spark, folder)
    if state is not None:
        _clear(spark, folder, state, {
            table: writes(spark, f"{folder}/{table}", state["day"]) for table in state["tables"]})


class Publication:
    """One run's tables. Leave the `with` block by an error, and nothing has changed."""

    def __init__(self, spark: SparkSession, folder: str, tables: list[str], day_column: str = LOAD_DATE):
        self.spark, self.folder, self.day_column = spark, folder.rstrip("/"), day_column
        settle(spark, self.folder)
        self.before: State = {t: writes(spark, self.path(t), day_column) for t in tables}
        self.written: State = {t: {} for t in tables}
        self.published = False

    def __enter__(self) -> Publication:
        self._mark(BEFORE, self.before)
        return self

    def __exit__(self, kind, error, trace) -> None:
        if not self.published:
            self.abandon()
            if kind is None:
                raise RuntimeError("the run ended without publish()")

    def abandon(self) -> None:
        settle(self.spark, self.folder)

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def _mark(self, name: str, tables: State) -> None:
        _put(self.spark, f"{self.folder}/{name}", {"day": self.day_column, "tables": tables})

    def write(self, table: str, df: DataFrame, rebalance: bool = True) -> None:
        """Adds rows that nobody sees before `publish`."""
        write_days(df, self.path(table), self.day_column, rebalance=rebalance, append=True)
        old = self.before[table]
        self.written[table] = {
            day: new for day, present in writes(self.spark, self.path(table), self.day_column).items()
            if (new := [w for w in present if w not in old.get(day, [])])}

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The rows this run has written to a table, days as strings."""
        df = _read(self.spark, self.path(table), self.written[table], self.day_column, schema=schema)
        return None if df is None else df.withColumn(self.day_column, F.col(self.day_column).cast("string"))

    def publish(self, start=None, end=None) -> State:
        """Replaces the days from `start` to `end`, all days without either, in every table by what was
        written to it; days that were not written go."""
        low, high = start and run_date(start), end and run_date(end)
        return self._publish({
            table: {d for d in days if (low is None or d >= low) and (high is None or d <= high)}
            for table, days in self.before.items()})

    def publish_written(self) -> State:
        """Replaces the days that were written to a table, and no others."""
        return self._publish({table: set(self.written[table]) for table in self.before})

    def _publish(self, replaced: dict[str, set[str]]) -> State:
        after = {table: {d: w for d, w in sorted((days | self.written[table]).items())
                         if d in self.written[table] or d not in replaced[table]}
                 for table, days in self.before.items()}
        self._mark(AFTER, after)
        self.published = True
        present = {table: {d: [*days.get(d, []), *self.written[table].get(d, [])] for d in {*days, *self.written[table]}}
                   for table, days in self.before.items()}
        _clear(self.spark, self.folder, {"day": self.day_column, "tables": after}, present)
        return after
