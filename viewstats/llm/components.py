"""Connected components of a graph given as pairs, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstats.llm.common import Scratchpad, shuffles_dropped


def _star(pairs: DataFrame, both_ways: bool) -> DataFrame:
    """Links the neighbours of each node to the smallest of them and the node: the larger neighbours
    (large star, over pairs both ways) or the smaller ones and the node itself (small star)."""
    if both_ways:
        pairs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = pairs.join(least, "a")
    if both_ways:
        moved = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(pairs: DataFrame, pad: Scratchpad | None = None) -> DataFrame:
    """node, label (smallest node that its pairs lead to) for every node of the (a, b) pairs but the
    labels themselves. Pairs may repeat, go either way or join a node to itself; a null end is ignored.

    No step holds the neighbours of a node together: minima are combined before they are shuffled and
    joined back. Each round's pairs replace those of the round before in `pad`; the last ones stay there
    for the result.
    """
    pad = pad or Scratchpad(pairs.sparkSession, "components")
    pairs = pad.keep(pairs.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        with shuffles_dropped(pairs.sparkSession):
            state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen, last = tuple(state), pairs
        pairs = pad.keep(_star(_star(last, both_ways=True), both_ways=False))
        pad.drop(last)
