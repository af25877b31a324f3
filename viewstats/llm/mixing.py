"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

The documents of a source, in a seeded order, form one stream of tokens that is cut into blocks of
`block_tokens`. Each output shard has a fixed number of blocks; the seats of all shards are dealt to
the sources by highest quotients target / (2k + 1), which gives every shard integer quotas. A source
then takes its quota of blocks in a seeded order, each block once before any block twice.

The seats come from Webster's rounding, which deals the same seats as listing every quotient: each
source gets target x seats / total, rounded, and the few seats too many or too few (half the number
of sources at most) go by their quotients. So no quotient per block is listed or ranked.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewstats.llm.common import cut, free_names, quoted, whole, word_count

BLOCK_TOKENS = 256  # at most
BLOCKS_OF_LEAST = 32  # blocks of the smallest target, at least
MOST_BLOCKS = 1 << 30  # of all sources, at most
STRIDE = 2_147_483_647  # prime and above any number of blocks, hence coprime with it
MOST_BROADCAST = 100_000  # sources, a row of a few numbers each


def cycled_weights(pattern: list[float]) -> Callable[[DataFrame], DataFrame]:
    """Weights for the sources in code point order, null last, repeating `pattern`."""
    def of(sources: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        cycle = F.array(*[F.lit(float(x)) for x in pattern])
        at = (F.pmod(place, F.lit(len(pattern))) + 1).cast("int")
        return sources.select("source", F.element_at(cycle, at).alias("weight"))
    return of


def target_sizes(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds target to (source, source_size, weight): `share` of all tokens split by weight, no source
    above `most` times its size, what lies above shared again by weight until nothing does.

    Sources fill up in the order of cap / weight; the first that does not sets the level at which all
    after it stand. A source without a positive weight, or without tokens, gets 0.
    """
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy(F.col("full_at").asc_nulls_last(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    weight = F.when(F.col("weight") > 0, F.col("weight"))
    caps = sources.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(most))).withColumn("full_at", F.col("cap") / F.col("weight"))
    asked = F.sum("source_size").over(every) * F.lit(float(share))
    filled = F.coalesce(F.sum(F.when(F.col("weight").isNotNull(), F.col("cap"))).over(before), F.lit(0.0))
    levels = caps.withColumn("level", F.when(
        F.col("weight").isNotNull(), (asked - filled) / F.sum("weight").over(rest)))
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every)
    # Without a level every source is full; `least` passes over it.
    target = F.when(F.col("weight").isNotNull(), F.least(F.col("cap"), level * F.col("weight")))
    return levels.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def apportion(weights: DataFrame, houses: list[int]) -> DataFrame:
    """source, house, seats: Sainte-Lague seats by (source, weight) in houses of so many seats.

    Equal quotients go to the smaller source, null last. Sources without a positive weight get none.
    """
    house = Window.partitionBy("house")
    share = F.col("weight") * (F.col("house") / F.sum("weight").over(house))
    rounded = (weights.where(F.col("weight") > 0).select("source", F.col("weight").cast("double").alias("weight"))
               .withColumn("house", F.explode(F.array(*[F.lit(h).cast("long") for h in houses])))
               .withColumn("seats", F.floor(share + 0.5))
               .withColumn("over", F.sum("seats").over(house) - F.col("house")))
    wanted = rounded.withColumn("k", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.abs("over") - 1, F.lit(0)))))
    seats, k, short = F.col("seats"), F.col("k"), F.col("over") < 0
    wanted = wanted.withColumn("able", (F.col("over") != 0) & (short | (k < seats))).withColumn(
        "quotient", F.when(short, F.col("weight") / (2 * (seats + k) + 1)).when(
            F.col("able"), -F.col("weight") / (2 * (seats - k) - 1)))
    source = F.when(short, F.col("place")).otherwise(-F.col("place"))
    rank = F.row_number().over(house.orderBy(F.col("able").desc(), F.col("quotient").desc(), source, k))
    step = F.when(F.col("able") & (rank <= F.abs("over")), F.when(short, 1).otherwise(-1)).otherwise(0)
    place = F.dense_rank().over(house.orderBy(F.col("source").asc_nulls_last()))
    return wanted.withColumn("place", place).withColumn("step", step).groupBy("house", "source").agg(
        (F.first("seats") + F.sum("step")).cast("long").alias("seats"))


def block_size(total: float, least: float | None, size: float, most: int = BLOCK_TOKENS) -> int:
    """Tokens of a block: so few that the smallest positive target has a good number of blocks, unless
    all targets (`total`) or sources (`size`) would then have more blocks than can be numbered."""
    fine = most if least is None else min(most, int(least / BLOCKS_OF_LEAST))
    return max(1, fine, math.ceil(max(total, size) / MOST_BLOCKS))


def quotas(sources: DataFrame, share: float, most: float, shards: int, block_tokens: int = BLOCK_TOKENS
           ) -> tuple[DataFrame, int]:
    """Adds to (source, source_size, weight): target, blocks (that its tokens fill), until (seats up
    to each shard, so shard s takes until[s] - until[s-1] blocks) and quota (all of them). Also the
    tokens of a block, at most `block_tokens` if targets are not too many."""
    targets = cut(target_sizes(sources, share, most))
    total, least, size = targets.agg(F.sum("target"), F.min(F.when(F.col("target") > 0, F.col("target"))),
                                     F.sum("source_size")).first()
    total = total or 0.0
    block_tokens = block_size(total, least, size or 0, block_tokens)
    seats = round(total / block_tokens)
    seated = apportion(targets.select("source", F.col("target").alias("weight")),
                       [seats * (s + 1) // shards for s in range(shards)])
    until = seated.groupBy(F.col("source").alias("seated")).agg(F.transform(F.array_sort(
        F.collect_list(F.struct("house", "seats"))), lambda x: x["seats"]).alias("until"))
    blocks = F.ceil(F.col("source_size") / F.lit(block_tokens))
    return (targets.join(until, F.col("source").eqNullSafe(F.col("seated")), "left").drop("seated")
            .withColumn("blocks", blocks)
            .withColumn("quota", F.least(F.coalesce(F.element_at("until", -1), F.lit(0)),
                                         F.floor(blocks * F.lit(float(most)))))), block_tokens


def mix(docs: DataFrame, weights: Callable[[DataFrame], DataFrame], share: float, most: float,
        shards: int = 8, seed: int = 23, block_tokens: int = BLOCK_TOKENS, key: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of `docs`: key, source, fingerprint (of the text), size (words), source_size,
    target, taken (words in taken blocks, repeats counted), copies (times it is in a mix of whole
    documents), shards (that then take it).

    Whole documents fill the words of their source's quota in the seeded order, all as often as the quota
    holds the whole source, the rest to the document that the quota ends in, which counts if its first
    half is inside. So a source's words differ from its quota by half a document at most.

    `weights` maps (source, source_size) rows to (source, weight). A null source is a source of its
    own; a null or empty text has no words and is never taken. Rows that repeat in key, source and text
    are numbered and treated as different documents of the stream. Other columns are not read. An empty
    table gives an empty table. The result depends on the rows and the seed only.
    """
    rows = cut(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"),
        F.xxhash64(whole(text)).alias("fingerprint"))
        .groupBy("key", "source", "size", "fingerprint").agg(F.count(F.lit(1)).alias("n")))
    sources = cut(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    weighted = sources.join(weights(sources).select(F.col("source").alias("weighed"), "weight"),
                            F.col("source").eqNullSafe(F.col("weighed")), "left").drop("weighed")
    plan, block_tokens = quotas(weighted, share, most, shards, block_tokens)
    plan = cut(plan).withColumnRenamed("source", "planned")
    if sources.count() <= MOST_BROADCAST:
        plan = F.broadcast(plan)

    # Where each document starts in its source's stream: sums over about sqrt(rows) ranges of the
    # source, then sums inside a range, so that no source has to pass through one task.
    ranges = max(1, math.isqrt(rows.agg(F.sum("n")).first()[0] or 1))
    rows = (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
            .withColumn("hash", F.xxhash64(F.lit(seed), "key", "fingerprint", "copy"))
            .withColumn("range", F.pmod(F.col("hash"), F.lit(ranges))))
    earlier = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(F.col("source").alias("of"), F.col("range").alias("at"))
              .agg(F.sum("size").alias("filled"))
              .withColumn("before", F.coalesce(F.sum("filled").over(earlier), F.lit(0))).drop("filled"))
    inside = (Window.partitionBy("source", "range").orderBy("hash", "key", "fingerprint", "copy")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")))
              .join(plan, F.col("source").eqNullSafe(F.col("planned")))
              .withColumn("start", F.col("before") + F.col("inside"))
              .withColumn("blocks", F.greatest("blocks", F.lit(1)))
              .withColumn("shift", F.pmod(F.xxhash64(F.lit(seed), "source"), F.col("blocks"))))
    end = F.col("start") + F.col("size")

    def turn(block):
        """The block's place in the seeded order of its source."""
        return (block * F.lit(STRIDE) + F.col("shift")) % F.col("blocks")

    def times(block):
        return F.expr("quota div blocks") + F.when(
            turn(block) < F.col("quota") % F.col("blocks"), 1).otherwise(0)

    def overlap(block):
        return F.least(end, (block + 1) * block_tokens) - F.greatest(F.col("start"), block * block_tokens)

    first, last = F.expr(f"start div {block_tokens}"), F.expr(f"(start + size - 1) div {block_tokens}")
    taken = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"),
                        lambda total, block: total + overlap(block) * times(block))
    words = F.least(F.col("quota") * block_tokens, F.col("source_size") * F.lit(float(most))).cast("long")
    size = F.greatest("source_size", F.lit(1))
    placed = placed.withColumn("words", words).withColumn("copies", F.when(F.col("size") > 0, F.floor(
        F.col("words") / size) + (2 * F.col("start") + F.col("size") <= 2 * (F.col("words") % size)).cast("long")
    ).otherwise(F.lit(0)).cast("long"))
    def shard(again):
        """Shards take seats in proportion, so a seeded place among all seats gives the shard."""
        place = F.pmod(turn(first) + again * F.ceil(F.col("blocks") / 2), F.col("blocks"))
        seat = F.floor(place * F.element_at("until", -1) / F.col("blocks"))
        return F.least(F.size(F.filter("until", lambda seats: seats <= seat)), F.lit(shards - 1))

    draws = F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), shard)
    return (placed.withColumn("taken", F.when(F.col("size") > 0, taken).otherwise(F.lit(0)).cast("long"))
            .withColumn("shards", F.when(F.col("copies") > 0, draws).otherwise(F.array().cast("array<int>")))
            .select("key", "source", "fingerprint", "size", "source_size", "target", "taken", "copies",
                    "shards"))


def mixed_documents(docs: DataFrame, weights: Callable[[DataFrame], DataFrame], share: float,
                    most: float, key: str = "doc_id", text: str = "text", source: str = "source",
                    **options) -> DataFrame:
    """The documents of the mix, whole and with all their columns, each as often as `mix` counts it (`copies`).
    Rows that repeat in key, source and text are put together before they are counted out."""
    of, by, what, times, again = free_names(docs, "of", "by", "what", "times", "again")
    drawn = cut(mix(docs, weights, share, most, key=key, text=text, source=source, **options)
                .groupBy(F.col("key").alias(of), F.col("source").alias(by), F.col("fingerprint").alias(what))
                .agg(F.sum("copies").alias(times), F.count(F.lit(1)).alias("rows")))
    if not drawn.where(F.col("rows") > 1).isEmpty():
        docs = docs.dropDuplicates([key, source, text])
    drawn = drawn.where(F.col(times) > 0).drop("rows")
    alike = (F.col(key).eqNullSafe(F.col(of)) & F.col(source).eqNullSafe(F.col(by))
             & (F.xxhash64(whole(text)) == F.col(what)))
    columns = [quoted(c) for c in docs.columns]
    return docs.join(drawn.select(*[F.col(c) for c in (of, by, what, times)]), alike).withColumn(
        again, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*columns)

