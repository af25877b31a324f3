"""Compare a Spark result with the DuckDB result of its SQL form, as multisets of rows."""

import glob
import os
from collections import Counter
from datetime import date, datetime

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, (date, datetime)):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(r[i]).__name__, _plain(r[i])) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, row count and values agree."""
    result = con.execute(sql)
    expected_names = [d[0] for d in result.description]
    if sorted(spark_df.columns) != sorted(expected_names):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(expected_names)}"]
    expected = _rows(expected_names, result.fetchall())
    actual = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if sum(expected.values()) != sum(actual.values()):
        found.append(f"rows {sum(actual.values())} vs {sum(expected.values())}")
    found += [f"only spark: {r}" for r in list((actual - expected))[:3]]
    found += [f"only duckdb: {r}" for r in list((expected - actual))[:3]]
    return found
