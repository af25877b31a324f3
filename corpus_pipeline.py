"""A training corpus from raw documents: quality, near duplicates, benchmark, mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet in
the shared folder and reads it again for the next stage. All stages but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstats.llm import decontamination, jaccard_join, mixing, quality, sharding
from viewstats.llm.common import scratch, table

LEAST_QUALITY = 0.5  # rejected: label 0 is likelier


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labels, does not reject."""
    machine = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, machine, column="__score")
    return scored.where(F.col("__score") >= LEAST_QUALITY).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that shares 80 % of its five-word shingles."""
    return jaccard_join.one_of_each(docs, words=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the proportions 5, 2, 1 of their sources, repeated up to twice."""
    return mixing.mixed_documents(docs, mixing.cycled_weights([5, 2, 1]), share=1.5, most=2.0)


def write_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in random order in eight shards, with `shard` and `slot`."""
    return sharding.external_shuffle(docs, scratch(spark, "corpus"), shards=8)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("sharding", write_shards),
]

# No SQL: the classifier is fitted by gradient steps and the shards are a random order.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
