"""The registered queries over the given tables: against their SQL, or against plain Python."""

import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from compare import connect, differences
from test_jaccard_join import brute_force
from viewstats.llm import decontamination, quality
from viewstats.llm.common import scratch, table
from viewstats.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


def rows_of(sql, sf_dir=SF_DIR):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con.execute(sql).fetchall()


def texts(sf_dir=SF_DIR):
    return rows_of("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id", sf_dir)


def test_all_are_registered():
    names = {f"op{n}" for n in range(1, 14)}
    assert {q.split("_")[0] for q in QUERIES} == names
    assert {*QUERIES, "pipeline"} <= set(registry.queries())
    assert set(ORACLE) <= set(registry.oracle_sql()) and "pipeline" not in registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_op1(spark):
    import public_tokenizers
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op1_token_ids"](spark, SF_DIR).collect()}
    for doc_id, text in texts():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert got[doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op2(spark):
    got = QUERIES["op2_sharding"](spark, SF_DIR).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {
        (k, len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts()}
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert set(shards) == set(range(8)) and all(sorted(s) == [*range(len(s))] for s in shards.values())
    assert len(got) == len(texts()) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_op5(spark):
    items = rows_of("SELECT item_id, text FROM benchmark")
    expected = set()
    for key, item in items:  # every document that has ten tokens of an item in a row has the passage
        runs = {tuple(t[i:i + 10]) for t in [decontamination.tokens(item)] for i in range(len(t) - 9)}
        for doc_id, text in texts():
            words = decontamination.tokens(text)
            if any(tuple(words[i:i + 10]) in runs for i in range(len(words) - 9)):
                expected.add((doc_id, key))
    got = QUERIES["op5_decontamination"](spark, SF_DIR).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected and len(got) == len(expected)


def test_op7(spark):
    first = QUERIES["op7_mixing"](spark, SF_DIR).collect()
    assert sorted(first) == sorted(QUERIES["op7_mixing"](spark, SF_DIR).collect())
    source = dict(rows_of("SELECT doc_id, source FROM documents"))
    words = {k: len(t.encode().split()) for k, t in texts()}
    sizes, taken = Counter(), Counter()
    for r in first:
        assert r["size"] == words[r["doc_id"]] and r["taken"] <= 2 * r["size"]
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(r["source_size"] == sizes[source[r["doc_id"]]] for r in first)
    targets = {source[r["doc_id"]]: r["target"] for r in first}
    order = sorted(sizes)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    level = max(targets[s] / weights[s] for s in order if targets[s] < 2 * sizes[s])
    assert all(targets[s] == pytest.approx(min(2 * sizes[s], level * weights[s])) for s in order)
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - targets[s]) <= 512 + 0.02 * targets[s] for s in order)


def test_op8_and_op9(spark):
    scored = QUERIES["op8_quality"](spark, SF_DIR).join(table(spark, SF_DIR, "labels"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in scored)
    held = [r for r in scored if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95
    got = QUERIES["op9_hmm"](spark, SF_DIR).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_pipeline_stage_by_stage(spark):
    """Each stage against plain Python on its own input."""
    docs, columns = table(spark, SMALL, "documents"), table(spark, SMALL, "documents").columns
    labels, kept = table(spark, SMALL, "labels"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, "stage")
        stage(spark, docs, SMALL).write.parquet(path)
        kept.append((docs, spark.read.parquet(path)))
        docs = kept[-1][1]
    ids = [(Counter(r[0] for r in a.select("doc_id").collect()), Counter(r[0] for r in b.select("doc_id").collect()))
           for a, b in kept]
    assert all(b.columns == columns for _, b in kept[:-1])
    machine = quality.train(kept[0][0], labels)
    good = quality.score(kept[0][0], machine).where(F.col("score") >= corpus_pipeline.LEAST_QUALITY)
    assert set(ids[0][1]) == {r["doc_id"] for r in good.collect()}
    rows = [tuple(r) for r in kept[1][0].select("doc_id", "text").collect()]
    assert set(ids[1][1]) == {k for k, _, least in brute_force(rows, 5, 80) if k == least}
    block = decontamination.Block(rows_of("SELECT item_id, text FROM benchmark", SMALL))
    assert set(ids[2][1]) == {r["doc_id"] for r in kept[2][0].collect() if not [*block.find([r["text"]])]}
    assert set(ids[3][1]) <= set(ids[3][0]) and max(ids[3][1].values()) <= 2
    assert ids[4][0] == ids[4][1]
    sizes = Counter(r["shard"] for r in kept[4][1].collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(8))
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted(again.select("doc_id", "shard", "slot").collect()) == sorted(
        kept[4][1].select("doc_id", "shard", "slot").collect())
