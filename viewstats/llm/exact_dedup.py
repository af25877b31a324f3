"""Exact duplicates by skew-safe combining.

Copies are combined three times: inside each task (Spark's partial aggregation), then per (digest,
salt), then over the at most `salts` winners of a text. Rows meet by digest but are told apart by
their full normalised text each time, so a digest that collides costs time and never a wrong group.
A text that a third of all rows share is spread over `salts` keys before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewstats.llm.common import cut, free_names, lower_ascii, whole

SALTS = 32


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of `docs`: key, digest, keep_key (largest key of its text), group_size, kept.

    Texts are equal when identical after lower-casing A-Z; null is the empty text, which is a text
    like any other. A null key is smaller than every key and stays only where all keys of its text
    are null. Rows that repeat key and text count in group_size and are all marked alike. Other
    columns are not read, whatever their names. An empty table gives an empty table.
    """
    rows = docs.select(F.col(key).alias("key"), lower_ascii(whole(text)).alias("norm"))
    rows = rows.select("key", "norm", digest(F.col("norm")).alias("digest"),
                       F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int").alias("salt"))
    salted = rows.groupBy("digest", "salt", "norm").agg(
        F.max("key").alias("top"), F.count(F.lit(1)).alias("n"))
    same_digest, same_text = Window.partitionBy("digest"), Window.partitionBy("digest", "norm")
    winners = salted.select(
        "digest", "salt",
        F.max("top").over(same_text).alias("keep_key"),
        F.sum("n").over(same_text).alias("group_size"),
        (F.min("norm").over(same_digest) == F.max("norm").over(same_digest)).alias("alone"))
    winners = cut(winners)
    light = rows.select("key", "digest", "salt")
    marked = light.join(winners.where("alone").drop("alone"), ["digest", "salt"])
    collided = winners.where(~F.col("alone")).select("digest").distinct()
    if not collided.isEmpty():
        again = rows.join(collided, "digest", "left_semi").select("key", "norm")
        exact = exact_groups(again, "key", "norm", salts, digest=lambda full: full)
        marked = marked.unionByName(exact.select(
            "key", digest(F.col("digest")).alias("digest"), F.lit(0).alias("salt"), "keep_key",
            "group_size"))
    return marked.select("key", "digest", "keep_key", "group_size",
                         F.col("key").eqNullSafe(F.col("keep_key")).alias("kept"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Of rows that repeat key and text all stay."""
    groups = exact_groups(docs, key, text)
    of, what = free_names(docs, "key", "digest")
    gone = groups.where(~F.col("kept")).select(F.col("key").alias(of), F.col("digest").alias(what))
    alike = F.col(key).eqNullSafe(F.col(of)) & (sha256(lower_ascii(whole(text))) == F.col(what))
    return docs.join(gone.distinct(), alike, "left_anti")
