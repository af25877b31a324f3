"""Exact de-duplication, sharding and mixing against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_cases import clashing, documents, odd_rows, prose, values
from viewstats.llm import exact_dedup, mixing, sharding
from viewstats.llm.common import ASCII_LOWER, ASCII_UPPER, scratch

LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def hot_rows():
    """A text that a third of all rows share, in two spellings."""
    rng = random.Random(2)
    rows = [(i, "Hot Text" if i % 2 else "hot text") for i in range(0, 300)]
    return rows + [(1000 + i, prose(rng, rng.randrange(1, 12), 20)) for i in range(600)] + odd_rows()


def groups_of(rows):
    found = defaultdict(list)
    for k, t in rows:
        found[(t or "").translate(LOWER)].append(k)
    out = []
    for text, keys in found.items():
        known = [k for k in keys if k is not None]
        top = max(known) if known else None
        out += [(k, hashlib.sha256(text.encode()).hexdigest(), top, len(keys), k == top) for k in keys]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [hot_rows(), odd_rows(), []])
def test_exact_groups(spark, rows):
    docs = clashing(documents(spark, rows))
    assert values(exact_dedup.exact_groups(docs)) == groups_of(rows)


def test_digests_that_collide_join_no_texts(spark):
    rows = hot_rows()
    got = exact_dedup.exact_groups(documents(spark, rows), digest=lambda t: F.length(t).cast("string"))
    assert values(got.drop("digest")) == sorted(((k, a, b, c) for k, _, a, b, c in groups_of(rows)), key=str)


def test_drop_copies(spark):
    docs = documents(spark, hot_rows())
    stay = sorted(((k, kept) for k, _, top, _, kept in groups_of(hot_rows())), key=str)
    assert values(exact_dedup.drop_copies(docs), "doc_id") == [(k,) for k, kept in stay if kept]
    assert exact_dedup.drop_copies(docs).columns == docs.columns


@pytest.mark.parametrize("rows,bucket", [(hot_rows(), 1 << 12), (hot_rows(), 1 << 24), (odd_rows(), 50), ([], 9)])
def test_shards_hold_every_row_once(spark, rows, bucket):
    docs = documents(spark, rows)
    got = sharding.external_shuffle(docs, scratch(spark, "t"), shards=8, bucket_bytes=bucket)
    assert values(got, *docs.columns) == values(docs)
    slots = defaultdict(list)
    for shard, slot in got.select("shard", "slot").collect():
        slots[shard].append(slot)
    assert all(sorted(s) == [*range(len(s))] for s in slots.values())
    if len(rows) >= 8:
        assert set(slots) == set(range(8))
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_depend_on_rows_and_seed_only(spark):
    rows = [(i, prose(random.Random(i), 5)) for i in range(500)]
    placed = [values(sharding.external_shuffle(documents(spark, rows, n), scratch(spark, "t"), 8, seed, 4000),
                     "doc_id", "shard", "slot") for n, seed in ((3, 1), (7, 1), (3, 2))]
    assert placed[0] == placed[1] != placed[2]


def test_rows_alike_in_every_column_spread_over_buckets(spark):
    docs = documents(spark, [(1, "again")] * 300 + [(i, "x") for i in range(600)]).withColumn("source", F.lit("s"))
    got = sharding.external_shuffle(docs, scratch(spark, "t"), shards=8, bucket_bytes=200)
    held = Counter(r[0] for r in got.where("text = 'again'").select("shard").collect())
    assert sum(held.values()) == 300 and len(held) == 8 and max(held.values()) < 80


def test_shuffle_is_uniform_enough(spark):
    """Where records end up is no function of where they began."""
    rows = [(i, f"t{i}") for i in range(2000)]
    got = sharding.external_shuffle(documents(spark, rows), scratch(spark, "t"), 8, bucket_bytes=1000)
    mean = got.groupBy("shard").agg(F.avg("doc_id")).collect()
    assert all(abs(m - 1000) < 160 for _, m in mean)


def test_shard_columns_must_not_clash(spark):
    with pytest.raises(ValueError):
        sharding.external_shuffle(documents(spark, []).withColumn("Slot", F.lit(1)), "/nowhere", 8)


# Mixing


def filled(sizes, weights, share, most):
    """Shares again until no source is above its cap."""
    total, capped, targets = share * sum(sizes), {}, {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in capped and weights[i] > 0]
        left, weight = total - sum(capped.values()), sum(weights[i] for i in rest)
        targets = {i: left * weights[i] / weight for i in rest} if rest else {}
        over = [i for i in rest if targets[i] > most * sizes[i]]
        if not over:
            return [capped.get(i, targets.get(i, 0.0)) for i in range(len(sizes))]
        capped |= {i: most * sizes[i] for i in over}


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 1000, 50_000]) for _ in range(9)]
    weights = [rng.choice([0, 1, 2, 5]) for _ in range(9)]
    df = spark.createDataFrame([(f"s{i}", s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))],
                               "source string, source_size long, weight double")
    got = {r["source"]: r["target"] for r in mixing.target_sizes(df, 1.5, 2.0).collect()}
    assert [got[f"s{i}"] for i in range(9)] == pytest.approx(filled(sizes, weights, 1.5, 2.0))


def highest_quotients(weights, seats):
    dealt = [0] * len(weights)
    for _ in range(seats):
        quotients = [(w / (2 * n + 1), -i) for i, (w, n) in enumerate(zip(weights, dealt))]
        dealt[-max(quotients)[1]] += 1
    return dealt


@pytest.mark.parametrize("weights", [[5, 2, 1, 5, 2], [1.0] * 7, [1000, 1, 1, 1, 1, 1, 1], [3], [0.3, 0.31, 7]])
def test_seats_are_those_of_the_highest_quotients(spark, weights):
    df = spark.createDataFrame([(f"s{i}", float(w)) for i, w in enumerate(weights)], "source string, weight double")
    houses = [0, 1, 2, 3, 5, 8, 40, 101]
    got = {(r["house"], r["source"]): r["seats"] for r in mixing.apportion(df, houses).collect()}
    for house in houses:
        assert [got[house, f"s{i}"] for i in range(len(weights))] == highest_quotients(weights, house), house


def mixed(spark, rows, partitions=5, **options):
    return mixing.mix(documents(spark, rows, partitions), mixing.cycled_weights([5, 2, 1]), 1.5, 2.0, **options)


def long_rows():
    rng = random.Random(4)
    return [(i, prose(rng, rng.randrange(0, 60))) for i in range(900)] + odd_rows()


def test_mix_meets_its_targets(spark):
    rows = mixed(spark, long_rows(), block_tokens=16).collect()
    assert len(rows) == len(long_rows())
    taken, targets = Counter(), {}
    for r in rows:
        assert r["size"] == 0 and r["taken"] == 0 or r["taken"] <= 2 * r["size"]
        assert len(r["shards"]) == r["copies"] <= 2
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - targets[s]) <= 2 * 16 for s in sizes)


def test_shards_have_the_same_mix(spark):
    rows = mixed(spark, long_rows(), block_tokens=16, shards=4)
    per = Counter((s, r["source"]) for r in rows.select("source", "shards", "size").collect() for s in r["shards"])
    for source in {s for _, s in per}:
        counts = [per[i, source] for i in range(4)]
        assert max(counts) < 2.5 * min(counts) + 8, source


def test_reruns_agree(spark):
    assert values(mixed(spark, long_rows(), 3)) == values(mixed(spark, long_rows(), 6))


def test_empty_mix(spark):
    assert mixed(spark, []).count() == 0
    assert values(mixed(spark, [(1, None), (2, "")]), "taken", "copies") == [(0, 0), (0, 0)]


def test_mixed_documents_are_whole(spark):
    docs = documents(spark, long_rows())
    got = mixing.mixed_documents(clashing(docs), mixing.cycled_weights([5, 2, 1]), 1.5, 2.0, block_tokens=16)
    copies = Counter({(r["key"], r["fingerprint"]): 0 for r in mixed(spark, long_rows(), block_tokens=16).collect()})
    for r in mixed(spark, long_rows(), block_tokens=16).collect():
        copies[r["key"], r["fingerprint"]] += r["copies"]
    out = Counter(map(tuple, got.select("doc_id", F.xxhash64("text")).collect()))
    assert out == +copies and got.columns == clashing(docs).columns


def kept_and_quotas(rows):
    """Words of whole documents per source, and the words that its quota of blocks stands for."""
    kept, targets, longest = Counter(), {}, Counter()
    for r in rows:
        kept[r["source"]] += r["size"] * r["copies"]
        targets[r["source"]] = r["target"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    return kept, targets, longest


@pytest.mark.parametrize("seed", [23, 1, 2, 3])
def test_whole_documents_keep_to_their_target(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "w " * 50_000 if i == 1 else prose(rng, rng.randrange(5, 40))) for i in range(300)]
    kept, targets, longest = kept_and_quotas(mixed(spark, rows, seed=seed).collect())
    for source, target in targets.items():  # half a document, and a block by which the quota is rounded
        assert abs(kept[source] - target) <= longest[source] / 2 + 256, source


def test_small_sources_take_part(spark):
    """Ten words a document, a target of 100 words; and a source of 100 words beside one of 100,000."""
    small = [(i, "one two three four five six seven eight nine ten") for i in range(5)]
    rows = mixing.mix(documents(spark, small).withColumn("source", F.lit("a")), mixing.cycled_weights([1]), 2.0, 2.0).collect()
    assert abs(sum(r["taken"] for r in rows) - 100) <= 6 and sum(r["size"] * r["copies"] for r in rows) == 100
    large = [(i, "w " * 1000) for i in range(100)] + [(100 + i, "w " * 10) for i in range(10)]
    docs = spark.createDataFrame([(k, t, "a" if k < 100 else "b") for k, t in large], "doc_id long, text string, source string")
    rows = mixing.mix(docs, mixing.cycled_weights([1, 1]), 1.5, 2.0).collect()
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
    assert abs(taken["b"] - 200) <= 12 and abs(taken["a"] - rows[0]["target"]) <= 300 or rows[0]["source"] == "b"
    assert mixing.block_size(0.0, None, 0) == 256 and mixing.block_size(2.0 ** 40, 10.0, 2.0 ** 41) == 2048


def test_rows_alike_in_key_and_text_spread(spark, tmp_path):
    """A third of all rows have a null key and an empty text and differ in another column only."""
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, "some text").alias("text"),
        F.col("id").cast("string").alias("url"))
    records = sharding._records(docs, "doc_id", "text", 17, True).withColumn("bucket", F.pmod("hash", F.lit(40)))
    sizes = [r["count"] for r in records.groupBy("bucket").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 2 * 6000 / 40
    written = sharding.external_shuffle(docs, str(tmp_path / "shards"), shards=4, bucket_bytes=400)
    assert values(written, "doc_id", "text", "url") == values(docs)
