"""Jaccard join of word n-grams: a size-aware join with a light and a heavy side.

Sets that link share so many elements that each side may lack only a fixed share of its own. So

1. equal sets are joined by digest, and one of them stands for all;
2. a set can only link if enough of its elements occur in other sets. That is tested on the elements
   with the smallest hashes of every set first (an l-prefix), then on all elements of what is left;
3. light sets, up to a size where it is the cheaper way, list all their subsets of the sizes that a
   common part can have; sets that meet at a subset are linked to the smallest set there;
4. heavy sets enter the inverted lists of their rarest elements. Lists are scanned in rounds: a few
   members of a list are compared with the others that are not in their component yet, then more, until
   every member has been. Pairs inside a component need no comparison, so a group of near copies costs
   about its size, while no link between different components is missed;
5. links are joined to components.

Hashes have 64 bits: n-grams that share one count as equal. Components are exact otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstats.llm.common import Scratchpad, free_names, shuffles_dropped, whole
from viewstats.llm.components import components

LIGHT_MOST = 40  # sizes considered for the light side
SUBSET_COST = 2.0  # of a listed subset, in scanned list entries
FIRST_HUBS, MORE_HUBS = 8, 16
SKETCH = 128  # counts of elements by part of the hash range
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Shingler:
    """Sets of distinct n-grams of a text's words as sorted hashes."""

    def __init__(self, n: int):
        self.n = n

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # of bytes: A-Z and the six ASCII space characters alone
        if not words:
            return np.zeros(0, np.uint64)
        values = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        width = min(self.n, len(words))
        grams = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            grams = (grams ^ values[i:i + len(grams)]) * MIX[0]
            grams ^= grams >> np.uint64(31)
        return np.unique(grams * MIX[1])


def least_common(size: int | Column, percent: int) -> int | Column:
    """Elements that a set of this size shares with every set it links to, at least."""
    if isinstance(size, Column):
        return F.expr(f"({percent}L * size + 99) div 100")
    return -(-percent * size // 100)


def sample_size(size: int, percent: int) -> tuple[int, int]:
    """How many smallest hashes of a set to look at, and how many of them others must have."""
    def spare(n: int) -> int:
        return min(least_common(n, percent), n // 16 + 2)
    common = least_common(size, percent)
    return size - common + spare(size), spare(common)


def _batches(batches, shingler: Shingler) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield keys[i].as_py(), shingler(texts[i].as_py())


def _packed(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), whole(text).cast("binary").alias("text"))


def _signed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """key, size, digest and smallest hashes of the set of every row, and how many of those others must
    have (see `sample_size`)."""
    def run(batches):
        held, count = [], 0
        for key, hashes in _batches(batches, Shingler(words)):
            looked_at, needed = sample_size(len(hashes), percent)
            held.append((key, len(hashes), _digest(hashes), hashes[:looked_at].view(np.int64), needed))
            count += looked_at
            if count > 1 << 19 or len(held) >= 4096:
                yield _packed(held, NAMES, KINDS)
                held, count = [], 0
        if held:
            yield _packed(held, NAMES, KINDS)

    NAMES = ["key", "size", "digest", "sample", "needed"]
    KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
    return docs.mapInArrow(run, "key long, size long, digest binary, sample array<long>, needed long")


def _shared(rows: DataFrame) -> DataFrame:
    """The (id, hash) rows whose hash other sets have too, with the number of sets. Counting and joining
    read one shuffle: the count names every column, so that both sides are the same exchange."""
    moved = rows.repartition("hash")
    named = F.count(F.coalesce(*[c for c in rows.columns if c != "hash"]))
    counts = moved.groupBy("hash").agg(named.alias("sets")).where("sets > 1")
    return moved.join(counts.hint("merge"), "hash")


def _whole_sets(docs: DataFrame, wanted: DataFrame, words: int, once: bool) -> DataFrame:
    """id, size, hashes and sketch of the sets of `wanted` (id, key, digest), made again from their texts. `once`:
    no key is on two rows of `docs`."""
    asked = wanted.select("id", F.col("key").alias("wanted"), F.col("digest").alias("asked"))
    # What is asked for grows with the texts, so it is shuffled with them at every size.
    found = docs.join(asked.hint("merge"), F.col("key").eqNullSafe(F.col("wanted"))).select("id", "text", "asked")

    def run(batches):
        shingler, held, count = Shingler(words), [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                of, text, asked = (batch.column(j)[i].as_py() for j in range(3))
                hashes = shingler(text)
                if _digest(hashes) == asked:  # keys may repeat
                    sketch = np.bincount((hashes % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
                    held.append((of, len(hashes), hashes.view(np.int64), np.minimum(sketch, 32767).astype(np.int16)))
                    count += len(hashes)
                if count > 1 << 19 or len(held) >= 4096:
                    yield _packed(held, NAMES, KINDS)
                    held, count = [], 0
        if held:
            yield _packed(held, NAMES, KINDS)

    NAMES = ["id", "size", "hashes", "sketch"]
    KINDS = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int16())]
    sets = found.mapInArrow(run, "id long, size long, hashes array<long>, sketch array<short>")
    return sets if once else sets.dropDuplicates(["id"])


def _candidates(some: DataFrame, first: DataFrame) -> DataFrame:
    """id, key, digest of the sets of which enough of the smallest hashes occur in other sets."""
    standing = some.join(first.select(F.col("id").alias("row")).hint("merge"), "row").withColumnRenamed("row", "id")
    shared = _shared(standing.select("id", F.explode("sample").alias("hash")))
    enough = shared.groupBy("id").agg(F.count(F.lit(1)).alias("others"))
    wanted = standing.select("id", "key", "digest", "needed").join(enough, "id")
    return wanted.where("others >= needed").select("id", "key", "digest")


def _rare_lists(sets: DataFrame, percent: int) -> DataFrame:
    """Inverted lists over the rarest elements of every set of which enough occur in others, as many
    elements as it takes to meet each set it links to: hash, id, size, place (of the element among the
    set's, rarest first), members, turn (see `_heavy_links`)."""
    elements = _shared(sets.select("id", "size", F.explode("hashes").alias("hash")))
    ordered = elements.groupBy("id", "size").agg(
        F.array_sort(F.collect_list(F.struct("sets", "hash"))).alias("rare"), F.count(F.lit(1)).alias("others"))
    ordered = ordered.where(F.col("others") >= least_common(F.col("size"), percent))
    alone = F.col("size") - F.col("others")  # these come first and are in no other set
    prefix = F.greatest(F.lit(0), F.col("size") - least_common(F.col("size"), percent) + 1 - alone)
    lists = (ordered.select("id", "size", alone.alias("alone"),
                            F.posexplode(F.slice("rare", F.lit(1), prefix.cast("int"))).alias("at", "one"))
             .select(F.col("one.hash").alias("hash"), "id", "size", (F.col("alone") + F.col("at")).alias("place")))
    members = lists.groupBy("hash").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    turn = (F.xxhash64(F.lit(5), "id") / F.lit(2.0 ** 64) + 0.5) * F.col("members")
    return lists.join(members, "hash").withColumn("turn", turn)


def subsets(hashes: np.ndarray, percent: int) -> list[tuple[int, int, int]]:
    """(size, key, second key) of all subsets of the sizes a common part can have. A key is a sum over
    the elements, so a subset's is the whole sum less what it leaves out."""
    parts = [hashes * MIX[0] ^ hashes >> np.uint64(7), hashes * MIX[1] ^ hashes >> np.uint64(11)]
    out, n = [], len(hashes)
    for left_out in range(n - least_common(n, percent) + 1):
        chosen = np.array([*combinations(range(n), left_out)], np.int64).reshape(comb(n, left_out), left_out)
        keys = [part.sum() - part[chosen].sum(axis=1) for part in parts]
        out += zip([n - left_out] * len(chosen), *(k.astype(np.uint64).view(np.int64).tolist() for k in keys))
    return out


def _light_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links of light sets. At a subset of size s, sets of sizes a and b link if that is enough for
    their sizes; then both link to the smallest set there too, so links to it give the components."""
    def run(batches):
        for batch in batches:
            for of, size, hashes in zip(*batch.columns):
                values = np.array(hashes.as_py(), np.int64).view(np.uint64)
                rows = [(of.as_py(), size.as_py(), *subset) for subset in subsets(values, percent)]
                yield _packed(rows, NAMES, [pa.int64()] * 5)

    NAMES = ["id", "size", "common", "first", "second"]
    listed = sets.mapInArrow(run, ", ".join(f"{name} long" for name in NAMES))
    met = ["common", "first", "second"]
    smallest = listed.groupBy(*met).agg(F.min(F.struct("size", "id")).alias("to"), F.count(F.lit(1)).alias("n"))
    linked = listed.join(smallest.where("n > 1"), met).where(
        (F.col("id") != F.col("to.id"))
        & (100 * F.col("common") >= percent * (F.col("size") + F.col("to.size") - F.col("common"))))
    return linked.select(F.col("id").alias("a"), F.col("to.id").alias("b")).distinct()


def light_boundary(costs: list[tuple[int, int, int]], percent: int) -> int:
    """The size up to which sets are light. `costs`: (size, sets, entries scanned in their lists)."""
    def listed(size: int) -> int:
        return sum(comb(size, k) for k in range(size - least_common(size, percent) + 1))
    best, at = 0.0, 0
    total = 0.0
    for size, sets, scanned in sorted(costs):
        total += SUBSET_COST * sets * listed(size) - scanned
        if total <= best:
            best, at = total, size
    return at


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave it open that they link. Two sets differ in at least as many
    elements as their counts differ over the parts of the hash range, so no link is lost, and most pairs
    that don't link go before any whole set is moved."""
    left = sets.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("sketch").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("sketch").alias("right"))
    apart = F.aggregate(F.zip_with("left", "right", lambda x, y: F.abs(x.cast("long") - y)), F.lit(0).cast("long"),
                        lambda total, x: total + x)
    both = F.col("size_a") + F.col("size_b")  # less twice the common part is how many they differ in
    return pairs.hint("merge").join(left, "a").hint("merge").join(right, "b").where(
        (100 + percent) * apart <= (100 - percent) * both).select("a", "b")


def _heavy_links(lists: DataFrame, sets: DataFrame, percent: int, links: DataFrame, longest: int,
                 pad: Scratchpad) -> DataFrame:
    """All links found, `links` (a table of `pad`) included, scanning `lists` in rounds.

    A member's turn to be compared with the rest of its lists comes by a hash of its id, so about
    FIRST_HUBS members have theirs in the first round, MORE_HUBS times as many in the next, and so on.
    """
    done, until = 0.0, float(FIRST_HUBS)
    while done < longest:
        labelled, rounds = lists.withColumn("label", F.col("id")), Scratchpad(lists.sparkSession, "labels")
        if done:
            labels = components(links, rounds).select(F.col("node").alias("id"), "label")
            labelled = lists.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        hubs = labelled.where((F.col("turn") >= done) & (F.col("turn") < until)).select(
            "hash", *[F.col(c).alias(f"hub_{c}") for c in ("id", "size", "place", "turn", "label")])
        small, large = F.least("size", "hub_size"), F.greatest("size", "hub_size")
        # What the two can still share from this element on, if it is the first they share.
        bound = F.least(F.col("size") - F.col("place"), F.col("hub_size") - F.col("hub_place"))
        pairs = (labelled.join(hubs, "hash").where(
            (F.col("label") != F.col("hub_label")) & (100 * small >= percent * large)
            & (F.struct("turn", "id") > F.struct("hub_turn", "hub_id"))
            & ((100 + percent) * bound >= percent * (F.col("size") + F.col("hub_size"))))
            .select(F.col("hub_id").alias("a"), F.col("id").alias("b")).distinct())
        pairs = pad.keep(_close(pairs, sets, percent))
        rounds.clear()
        left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("left"))
        right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("right"))
        common = F.size(F.array_intersect("left", "right"))
        found = (pairs.hint("merge").join(right, "b").hint("merge").join(left, "a").where(
            (100 + percent) * common >= percent * (F.size("left") + F.size("right"))).select("a", "b"))
        last, links = links, pad.keep(links.unionByName(found))
        pad.drop(last, pairs)
        done, until = until, until * MORE_HUBS
    return links


def link_sets(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, size (of its set of word n-grams), component (smallest key that
    links lead to, its own included).

    Words are what ASCII space characters separate, A-Z lower-cased. A text with fewer than `words`
    words is one n-gram as a whole; one without words, or null, has size 0 and no link. Two sets link
    when 100 x common >= percent x union. Null keys are members like others and are named only where
    the component has no other key; rows that repeat a key are told apart by their texts. Other columns
    are not read. An empty table gives an empty table.
    """
    spark, texts, pad = docs.sparkSession, _texts(docs, key, text), Scratchpad(docs.sparkSession, "jaccard")
    signed = pad.keep(_signed(texts, words, percent).withColumn("row", F.monotonically_increasing_id()))
    sized = pad.keep(signed.drop("sample", "needed"))
    some = sized.where("size > 0")
    # One row stands for all rows with its set.
    first = pad.keep(some.groupBy("digest").agg(F.min("row").alias("id"), F.min("key").alias("key")))
    wanted = pad.keep(_candidates(signed.where("size > 0"), first))
    pad.drop(signed)
    with shuffles_dropped(spark):
        once = sized.groupBy("key").count().where("count > 1").isEmpty()
    sets = pad.keep(_whole_sets(texts, wanted, words, once))
    pad.drop(wanted)
    lists = pad.keep(_rare_lists(sets, percent))

    with shuffles_dropped(spark):
        costs = lists.where(F.col("size") <= LIGHT_MOST).groupBy("size").agg(
            F.countDistinct("id"), F.sum("members")).collect()  # LIGHT_MOST rows at most
    boundary = light_boundary([tuple(row) for row in costs], percent)
    light = sets.where(F.col("size") <= boundary).drop("sketch").join(lists.select("id").distinct(), "id")
    links = pad.keep(_light_links(light, percent))
    heavy = lists.where(F.col("size") >= least_common(boundary + 1, percent))
    longest = heavy.agg(F.max("members")).first()[0] or 0
    links = _heavy_links(heavy, sets, percent, links, longest, pad)
    pad.drop(sets, lists)

    labels = components(links).select(F.col("node").alias("id"), "label")
    named = first.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = named.groupBy("label").agg(F.min("key").alias("component"))
    named = named.join(least, "label").select("digest", "component")
    linked = some.select("key", "size", "digest").join(named, "digest").drop("digest")
    return linked.unionByName(sized.where("size = 0").select("key", "size", F.col("key").alias("component")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose key is the smallest of their component, with all columns. A row without
    words stays. Rows that repeat a key stay if one of them does."""
    stays = F.max(F.col("key").eqNullSafe(F.col("component")))
    [of] = free_names(docs, "key")
    groups = link_sets(docs, key=key, text=text, **options).groupBy(F.col("key").alias(of)).agg(stays.alias("stays"))
    gone = groups.where(~F.col("stays")).select(of)
    return docs.join(gone, F.col(key).eqNullSafe(F.col(of)), "left_anti")
