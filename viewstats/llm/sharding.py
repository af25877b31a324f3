"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records into buckets by a seeded hash, each bucket small enough for one task's
memory. Pass 2 runs Spark's `shuffle`, a seeded Fisher-Yates shuffle, over each bucket and writes the
records to their shards. Where a record goes follows from the seed and its content alone, so a lost
task gives the same rows when it runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewstats.llm.common import free_names, quoted, text_bytes, whole

BUCKET_BYTES = 16 << 20
MOST_BROADCAST = 1 << 20  # buckets; a row of two longs each


def _records(docs: DataFrame, key: str, text: str, seed: int, repeats: bool) -> DataFrame:
    """row (all columns of `docs`), key, copy, hash: what a record's place follows from. Where rows repeat
    a key and text, the hash looks at every column, and rows alike in all of them are numbered."""
    columns = [quoted(c) for c in docs.columns]
    row = F.struct(*columns).alias("row")
    if not repeats:
        return docs.select(row, F.col(key).alias("key"), F.lit(1).cast("long").alias("copy"),
                           F.xxhash64(F.lit(seed), F.col(key), whole(text)).alias("hash"))
    [n] = free_names(docs, "n")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias("copy")
    return docs.groupBy(*columns).agg(F.count(F.lit(1)).alias(n)).select(
        row, F.col(key).alias("key"), F.xxhash64(F.lit(seed), *columns).alias("same"), copy).select(
        "row", "key", "copy", F.xxhash64(F.lit(seed), "same", "copy").alias("hash"))


def external_shuffle(docs: DataFrame, path: str, shards: int, seed: int = 17,
                     bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Writes `docs` to `path` as shard=0..shards-1 and returns the written table: every column of
    `docs`, `shard`, and `slot`, gapless from 0 in each shard. Row counts differ by one at most.

    The records are in seeded random order over all shards. Null keys and texts are records like
    others; rows that repeat in every column are numbered first and spread over the buckets too. A
    record larger than `bucket_bytes` makes its bucket that much larger. An empty table gives an empty
    table. Columns of `docs` named `shard` or `slot` are an error, as they would be overwritten.
    """
    clash = {"shard", "slot"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    identity = F.xxhash64(F.lit(seed), F.col(key), whole(text))
    light = docs.groupBy(F.col(key).alias("key"), identity.alias("hash")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(text_bytes(text) + 1).alias("size"))
    rows, size, repeats = light.agg(F.sum("n"), F.sum("size"), F.max("n")).first()
    rows, buckets = rows or 0, max(1, -(-(size or 0) // bucket_bytes))
    records = _records(docs, key, text, seed, (repeats or 0) > 1)
    records = records.withColumn("bucket", F.pmod(F.col("hash"), F.lit(buckets)).cast("int"))

    first_of = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = records.groupBy("bucket").count().select(
        "bucket", F.coalesce(F.sum("count").over(first_of), F.lit(0)).alias("start"))
    if buckets <= MOST_BROADCAST:
        starts = F.broadcast(starts)

    # One bucket per partition: the partition's number seeds its shuffle, the sort fixes its input.
    shuffled = (records.repartitionById(buckets, "bucket")
                .groupBy("bucket").agg(F.collect_list(F.struct("hash", "key", "copy", "row")).alias("records"))
                .withColumn("records", F.shuffle(F.array_sort("records"), F.lit(seed)))
                .select("bucket", F.posexplode("records").alias("at", "record")))
    placed = shuffled.join(starts, "bucket").select("record.row", (F.col("start") + F.col("at")).alias("position"))
    shard = F.expr(f"cast(position * {shards} div {max(1, rows)} as int)")
    first = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("position") - first).select("row.*", "slot", "shard")
    placed.write.partitionBy("shard").parquet(path)
    schema = T.StructType([*docs.schema.fields, T.StructField("slot", T.LongType()),
                           T.StructField("shard", T.IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path)
