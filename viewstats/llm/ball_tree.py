"""Exact ranked lexical search: sparse ball trees over documents, searched best-first.

A document is a sparse vector of integer term scores, an item one of integer term weights, and a
document's score their inner product. Documents are sorted by the two smallest hashes of their terms, so
that neighbours share words, and every run of `TREE` documents becomes a ball tree: a node has the mean of
its documents and the radius around it, halves by which of two far documents is nearer, and ends in leaves
of `LEAF` documents. With c the mean, r the radius and q_S the weights of the terms that a node has, no
document below it scores more than q.c + |q_S| r. The node with the highest bound is opened first; the
search ends when that bound is below the k-th best score. Means, radii and bounds are doubles, widened by
far more than they can be rounded; scores are added up in 64-bit integers at the leaves.

Only terms of the items can score, so documents are reduced to those once N, L and n have been counted
over all terms. Every item goes to every tree, in blocks.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewstats.llm.common import cut, whole

TREE = 4096  # documents of a tree
TREE_TERMS = 1 << 20  # and their terms
LEAF = 64
BLOCK = 256  # items that travel together
MOST_BROADCAST = 1 << 18  # terms of all items that tasks get as a table; more are joined
MOST_BROADCAST_BYTES = 1 << 24
WIDER = 1e-9  # rounding stays below 1e-11 of what is rounded

# Fixed values of the scores.
TERM_SCALE, WEIGHT_SCALE = 1_000_000_000, 1000
SATURATION, LENGTH_SHARE = 8, 75  # of 1000 occurrences; percent

# Bytes of terms: digits, letters and all above ASCII, A-Z lower-cased; other bytes part terms.
TERM_BYTES = bytes(b | 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(TERM_BYTES).split()


def _lists(rows: list[list], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([v for row in rows for v in row], kind))


def _counted(rows: DataFrame, numbers=None) -> DataFrame:
    """(row, id, text) as (row, id, n, terms, times): all terms of a text, or the numbers of those that the
    broadcast table has. Texts without terms are left out."""
    kind, stored = ("binary", pa.binary()) if numbers is None else ("int", pa.int32())

    def run(batches):
        number = None if numbers is None else dict(numbers.value).get
        for batch in batches:
            kept, found = [], []
            lengths = []
            for i, text in enumerate(batch.column("text")):
                words = terms(text.as_py())
                if words:
                    counts = Counter(words if number is None else map(number, words))
                    counts.pop(None, None)
                    kept.append(i)
                    lengths.append(len(words))
                    found.append(counts)
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(kept)), batch.column("id").take(pa.array(kept)),
                     pa.array(lengths, pa.int64()), _lists([[*c] for c in found], stored),
                     _lists([[*c.values()] for c in found], pa.int64())], ["row", "id", "n", "terms", "times"])

    rows = rows.select("row", "id", whole("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"row long, id long, n long, terms array<{kind}>, times array<long>")


def _numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
                     F.col(text).alias("text"))


@dataclass
class Tree:
    """Documents in leaf order. `nodes`: left, right (0: leaf), first and last document, first and last
    entry of the mean, first and last posting. Means and postings are by term in each node or leaf."""

    vocabulary: np.ndarray
    ids: list
    nodes: np.ndarray
    radii: np.ndarray
    mean_terms: np.ndarray
    means: np.ndarray
    terms: np.ndarray
    docs: np.ndarray
    scores: np.ndarray

    ARRAYS = {"vocabulary": "<i8", "nodes": "<i8", "radii": "<f8", "mean_terms": "<i4", "means": "<f8",
              "terms": "<i4", "docs": "<i4", "scores": "<i4"}

    @classmethod
    def build(cls, ids: list, starts: np.ndarray, numbers: np.ndarray, scores: np.ndarray, leaf: int) -> Tree:
        """Document i has the term numbers and scores from starts[i] to starts[i + 1]."""
        vocabulary, local = np.unique(numbers, return_inverse=True)
        lengths, values = np.diff(starts), scores.astype(float)
        squares = np.bincount(np.repeat(np.arange(len(ids)), lengths), values * values, len(ids))
        nodes, radii, mean_terms, means, postings, order = [], [], [], [], [], []

        def entries(docs):
            n = lengths[docs]
            return np.repeat(starts[docs] - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(np.arange(len(docs)), n)

        def apart(docs, at, of, dense):
            """Squared distances of documents to a vector, not too small."""
            inner = np.bincount(of, values[at] * dense[local[at]], len(docs))
            length = float((dense * dense).sum())
            return np.maximum(squares[docs] - 2 * inner + length, 0) + WIDER * (squares[docs] + length)

        def only(doc):
            dense, (at, _) = np.zeros(len(vocabulary)), entries(np.array([doc]))
            dense[local[at]] = values[at]
            return dense

        waiting, sizes = [(np.arange(len(ids)), -1, 0)], [0, 0, 0]
        while waiting:
            docs, parent, side = waiting.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][side] = me
            at, of = entries(docs)
            mean = np.bincount(local[at], values[at], len(vocabulary)) / len(docs)
            away = apart(docs, at, of, mean)
            has = np.flatnonzero(mean)
            node = [0, 0, 0, 0, sizes[0], sizes[0] + len(has), 0, 0]
            sizes[0] += len(has)
            nodes.append(node)
            radii.append(away.max() ** 0.5 * (1 + WIDER))
            mean_terms.append(has)
            means.append(mean[has])
            if len(docs) <= leaf:
                by_term = np.argsort(local[at], kind="stable")
                node[2:4] = sizes[1], sizes[1] + len(docs)
                node[6:8] = sizes[2], sizes[2] + len(at)
                postings.append((local[at][by_term], of[by_term], scores[at][by_term]))
                sizes[1:] = node[3], node[7]
                order.extend(docs)
                continue
            one = docs[away.argmax()]
            from_one = apart(docs, at, of, only(one))
            nearer = from_one - apart(docs, at, of, only(docs[from_one.argmax()]))
            half = np.argsort(nearer, kind="stable")
            waiting += [(docs[half[:len(docs) // 2]], me, 0), (docs[half[len(docs) // 2:]], me, 1)]
        return cls(vocabulary, [ids[i] for i in order], np.array(nodes), np.array(radii), np.concatenate(mean_terms),
                   np.concatenate(means), *(np.concatenate(p) for p in zip(*postings)))

    def pack(self) -> dict:
        return {"ids": self.ids} | {
            name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.ARRAYS.items()}

    @classmethod
    def unpack(cls, row: dict) -> Tree:
        arrays = {name: np.frombuffer(row[name], kind) for name, kind in cls.ARRAYS.items()}
        return cls(ids=row["ids"], **arrays | {"nodes": arrays["nodes"].reshape(-1, 8).tolist(),
                                               "scores": arrays["scores"].astype("i8")})

    def bound(self, node: int, wanted: np.ndarray, weights: np.ndarray) -> float:
        """No document of the node scores more; 0 where it has none of the terms."""
        first, last = self.nodes[node][4:6]
        has = self.mean_terms[first:last]
        at = np.searchsorted(has, wanted)
        at[at == len(has)] = 0
        hit = has[at] == wanted
        q = weights[hit].astype(float)
        if not len(q):
            return 0.0
        return (float(q @ self.means[first:last][at[hit]]) + float(q @ q) ** 0.5 * float(self.radii[node])) * (1 + WIDER) + 1

    def score(self, node: int, wanted: np.ndarray, weights: np.ndarray) -> tuple[int, np.ndarray]:
        """Exact scores of a leaf's documents, from the first of them on."""
        _, _, first, last, _, _, start, end = self.nodes[node]
        held = self.terms[start:end]
        left, right = np.searchsorted(held, wanted, "left"), np.searchsorted(held, wanted, "right")
        n = right - left
        at = np.repeat(left - np.cumsum(n) + n, n) + np.arange(n.sum()) + start
        total = np.zeros(last - first, "i8")
        np.add.at(total, self.docs[at], self.scores[at] * np.repeat(weights, n))
        return first, total

    def search(self, numbers: np.ndarray, weights: np.ndarray, k: int, best: list) -> list:
        """The best k of `best` and the tree's documents, as (-score, id is null, id)."""
        at = np.searchsorted(self.vocabulary, numbers)
        at[at == len(self.vocabulary)] = 0
        hit = self.vocabulary[at] == numbers
        wanted, weights = at[hit], weights[hit]
        heap = [(-self.bound(0, wanted, weights), 0)] if len(wanted) else []
        while heap:
            bound, node = heapq.heappop(heap)
            if not bound or len(best) == k and -bound < -best[-1][0]:
                break
            left, right = self.nodes[node][:2]
            if left:
                heapq.heappush(heap, (-self.bound(left, wanted, weights), left))
                heapq.heappush(heap, (-self.bound(right, wanted, weights), right))
                continue
            first, scores = self.score(node, wanted, weights)
            least = -best[-1][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= max(least, 1)):
                key = self.ids[first + i]
                best.append((-int(scores[i]), key is None, key or 0))
            best = sorted(best)[:k]
        return best


TREES = "part long, ids array<long>, " + ", ".join(f"{name} binary" for name in Tree.ARRAYS)


def _trees(counted: DataFrame, n_docs: int, n_terms: int, tree: int, leaf: int, parts: int) -> DataFrame:
    """Ball trees of all documents, neighbours by the smallest hashes of their terms."""
    def run(batches):
        part, ids, held, size = TaskContext.get().partitionId(), [], [], 0
        shape = pa.schema([("part", pa.int64()), ("ids", pa.list_(pa.int64())),
                           *((name, pa.binary()) for name in Tree.ARRAYS)])

        def flush():
            lengths = np.concatenate([h[0] for h in held])
            built = Tree.build(ids, np.concatenate([[0], np.cumsum(lengths)]), np.concatenate([h[1] for h in held]),
                               np.concatenate([h[2] for h in held]), leaf)
            return pa.RecordBatch.from_pylist([{"part": part} | built.pack()], schema=shape)

        for batch in batches:
            offsets = batch.column("terms").offsets.to_numpy()
            n, numbers = batch.column("n").to_numpy(), batch.column("terms").flatten().to_numpy()
            times, lengths = batch.column("times").flatten().to_numpy(), np.diff(offsets)
            length = np.repeat(100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms, lengths)
            scores = TERM_SCALE * times // (WEIGHT_SCALE * times + SATURATION * length)
            starts, keys, begin = np.cumsum(lengths) - lengths, batch.column("id").to_pylist(), 0
            while begin < len(keys):
                room = np.searchsorted(starts + lengths, starts[begin] + TREE_TERMS - size, "right") - begin
                end = min(len(keys), begin + min(tree - len(ids), max(int(room), 0 if ids else 1)))
                if end > begin:
                    a, b = starts[begin], starts[end - 1] + lengths[end - 1]
                    held.append((lengths[begin:end], numbers[a:b], scores[a:b]))
                    ids += keys[begin:end]
                    size += int(b - a)
                if end < len(keys) or len(ids) >= tree:
                    yield flush()
                    ids, held, size = [], [], 0
                begin = end
        if ids:
            yield flush()

    hashes = F.array_sort(F.transform("terms", lambda t: F.xxhash64(t)))
    order = ["first", "second", "n", "id"]
    return cut(counted.where(F.size("terms") > 0).withColumns(
        {"first": F.get(hashes, F.lit(0)), "second": F.get(hashes, F.lit(1))})
        .repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select("id", "n", "terms", "times").mapInArrow(run, TREES))


def _blocks(items: DataFrame) -> DataFrame:
    """Items, `BLOCK` to a row."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                some = batch.slice(start, BLOCK).to_pydict()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some["row"]], pa.list_(pa.int64())), pa.array([some["id"]], pa.list_(pa.int64())),
                     pa.array([some["numbers"]], longs), pa.array([some["weights"]], longs)],
                    ["rows", "items", "numbers", "weights"])

    longs = pa.list_(pa.list_(pa.int64()))
    return items.mapInArrow(run, "rows array<long>, items array<long>, numbers array<array<long>>, "
                                 "weights array<array<long>>")


def _search(trees: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Every block against every part's trees."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if part != row["part"]:
                    part, held = row["part"], []
                if row["rows"] is None:
                    held.append(Tree.unpack(row))
                    continue
                out = []
                for of, item, numbers, weights in zip(row["rows"], row["items"], row["numbers"], row["weights"]):
                    best, numbers, weights = [], np.array(numbers, "i8"), np.array(weights, "i8")
                    for tree in held:
                        best = tree.search(numbers, weights, k, best)
                    out += [(of, item, None if none else key, -score) for score, none, key in best]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     ["row", "item", "id", "score"])

    last = trees.agg(F.max("part")).first()[0]
    if last is None:
        last = -1
    sent = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(last, 0)).cast("long"))))
    return (trees.unionByName(sent, allowMissingColumns=True).repartition("part")
            .sortWithinPartitions("part", F.col("rows").isNotNull()).mapInArrow(run, "row long, item long, id long, score long"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", tree: int = TREE, leaf: int = LEAF,
           most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """For every row of `items`, the `k` rows of `docs` with the highest scores above 0: item, rank (from
    1), id, score. Equal scores go by ascending id, null ids last.

    Null and empty texts have no terms: such documents count nowhere, such items find nothing. Rows that
    repeat are documents and items of their own, null keys included. An empty table gives an empty table.
    Other columns are not read. With `most_broadcast` terms in all items or fewer, each document is
    counted by a table of them; with more, its terms are joined to them.
    """
    queries = _counted(_numbered(items, item_key, item_text)).withColumnRenamed("id", "item")
    words = cut(queries.select("row", "item", F.explode(F.arrays_zip("terms", "times")).alias("t"))
                .select("row", "item", F.col("t.terms").alias("term"), F.col("t.times").alias("times")))
    vocabulary = cut(words.select("term").distinct().withColumn("number", F.monotonically_increasing_id()))
    size, sent = vocabulary.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    rows = _numbered(docs, key, text)
    if size <= most_broadcast and sent <= MOST_BROADCAST_BYTES:
        table = sorted(bytes(r[0]) for r in vocabulary.select("term").collect())
        vocabulary = docs.sparkSession.createDataFrame([*zip(table, range(size))], "term binary, number int")
        counted = cut(_counted(rows, docs.sparkSession.sparkContext.broadcast([*zip(table, range(size))])))
        lengths = counted
    else:
        lengths = cut(_counted(rows))
        found = lengths.select("row", "id", "n", F.explode(F.arrays_zip("terms", "times")).alias("t")).select(
            "row", "id", "n", F.col("t.terms").alias("term"), F.col("t.times").alias("times")).join(vocabulary, "term")
        counted = cut(found.groupBy("row", "id", "n").agg(F.collect_list(F.struct("number", "times")).alias("t"))
                      .select("row", "id", "n", F.col("t.number").alias("terms"), F.col("t.times").alias("times")))
    n_docs, n_terms = lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    in_docs = counted.select(F.explode("terms").alias("number")).groupBy("number").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(WEIGHT_SCALE * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = words.join(vocabulary, "term").join(in_docs, "number").select(
        "row", "item", F.struct(F.col("number").cast("long").alias("number"),
                                (weight * F.col("times")).alias("weight")).alias("t"))
    queries = weighed.groupBy("row", "item").agg(F.array_sort(F.collect_list("t")).alias("t")).select(
        "row", F.col("item").alias("id"), F.col("t.number").alias("numbers"), F.col("t.weight").alias("weights"))
    trees = _trees(counted, n_docs, max(n_terms, 1), tree, leaf, max(1, -(-n_docs // tree)))
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return _search(trees, _blocks(queries), k).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).select("item", "rank", "id", "score")
