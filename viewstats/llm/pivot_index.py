"""Exact top-k search by inner product over a pivot-distance index.

A component of its own makes all vectors equally long, so that the largest inner product is the smallest
distance: |q - x|^2 = |q|^2 + M^2 - 2 q.x, with M the largest norm. Vectors are keyed by their nearest
pivot and the distance to it and stored in that order; a *segment* is a run of vectors of one pivot, a
*part* the segments of one partition. A query at distance d from a pivot can only be within r of vectors
whose own distance is in [d - r, d + r]. It first searches the part where its own ring lies, which bounds
r; then every part that the directory does not rule out. In a part it takes the annuli around d outwards,
r shrinking as better vectors are found, until the triangle inequality rules the next one out.

Scores are exact integers; distances only rule vectors out and are widened by more than they can be
rounded. Pivots are chosen from a bounded sample (`SAMPLE`); every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewstats.llm.common import cut

PIVOTS = 64
SAMPLE = 4096  # vectors, the smallest by hash, from which pivots are chosen
PART = 4096  # vectors of a part, more once there are MOST_PARTS parts
MOST_PARTS = 1 << 15
BLOCK = 256  # queries that travel together
TASK_QUERIES = 1 << 20  # beyond so many, a part's queries are dealt to several tasks
ANNULUS = 128  # vectors of a query's first annulus; each next one is twice as wide
SLACK = 1e-6  # of the norms; rounding is below 1e-7 of them

ROWS = "pivot int, distance double, id long, vector binary"
SEGMENTS = ("part long, pivot int, low double, high double, ids array<long>, distances binary, vectors binary")
BLOCKS = "part long, share int, rows array<long>, ids array<long>, vectors binary, least array<long>"
FOUND = "row long, query_id long, own long, vector binary, home long, ids array<long>, scores array<long>"


@dataclass(frozen=True)
class Space:
    """What all tasks know: shape and type of the vectors, the bound on norms, pivots with their extra
    component."""

    dims: int
    stored: str
    exact: str  # type in which inner products are exact
    largest: float
    pivots: np.ndarray

    def matrix(self, vectors: bytes | list[bytes]) -> np.ndarray:
        data = vectors if isinstance(vectors, bytes) else b"".join(vectors)
        return np.frombuffer(data, self.stored).reshape(-1, self.dims).astype(self.exact)

    def distances(self, vectors: np.ndarray, as_query: bool) -> np.ndarray:
        """From each vector to each pivot; a query's extra component is 0."""
        x = vectors.astype(float)
        squares = (x * x).sum(1)
        extra = np.zeros(len(x)) if as_query else np.sqrt(np.maximum(self.largest ** 2 - squares, 0))
        inner = x @ self.pivots[:, :-1].T
        own = (self.pivots[:, :-1] ** 2).sum(1)
        flat = np.maximum(squares[:, None] + own - 2 * inner, 0)
        return np.sqrt(flat + (extra[:, None] - self.pivots[:, -1]) ** 2)

    def radius(self, query: np.ndarray, score: float) -> float:
        """Beyond it, a vector's inner product with the query is less than the score."""
        square = float((query.astype(float) ** 2).sum())
        return (max(square + self.largest ** 2 - 2 * float(score), 0.0) ** 0.5
                + SLACK * (square ** 0.5 + self.largest + 1))


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, vector): each component x as floor(scale * x). Vectors that are null or hold a component that
    is null or not finite are left out."""
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
            .where(F.col("vector").isNotNull() & ~odd)
            .select("id", F.transform("vector", lambda x: F.floor(x.cast("double") * scale)).alias("vector")))


def _dense(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The list column `vector` as a matrix; components that a vector lacks are 0."""
    column = batch.column("vector")
    lengths = np.diff(column.offsets.to_numpy())
    matrix = np.zeros((len(column), dims), "<i8")
    matrix[np.arange(dims) < lengths[:, None]] = column.flatten().to_numpy()
    return matrix


def _space(vectors: DataFrame, pivots: int, sample: int) -> tuple[Space, int] | None:
    """None where there are no vectors. Pivots are taken farthest first, after the one of the least hash."""
    size = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    count, dims, most, square = vectors.agg(
        F.count(F.lit(1)), F.max(F.size("vector")), F.max(F.aggregate(
            "vector", F.lit(0).cast("long"), lambda most, x: F.greatest(most, F.abs(x)))), F.max(size)).first()
    if not count:
        return None
    if max(dims, 1) * (most + 1) ** 2 >= 1 << 63:
        raise ValueError(f"inner products of {dims} components up to {most} do not fit into a long")
    stored = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    exact = "f8" if max(dims, 1) * (most + 1) ** 2 < 1 << 53 else "i8"
    dims = max(dims, 1)
    rows = vectors.select("vector").orderBy(F.xxhash64("id", "vector")).limit(sample).collect()
    points = np.zeros((len(rows), dims + 1))
    for i, (row,) in enumerate(rows):
        points[i, :len(row)] = row
    largest = (square * (1 + 1e-9)) ** 0.5
    points[:, -1] = np.sqrt(np.maximum(largest ** 2 - (points[:, :-1] ** 2).sum(1), 0))
    chosen, nearest = [0], np.full(len(points), np.inf)
    while len(chosen) < min(pivots, len(points)):
        nearest = np.minimum(nearest, np.linalg.norm(points - points[chosen[-1]], axis=1))
        if not nearest.max() > 0:
            break
        chosen.append(int(nearest.argmax()))
    return Space(dims, stored, exact, largest, points[chosen]), count


def _index(vectors: DataFrame, space: Space, parts: int) -> DataFrame:
    """The segments of all vectors, in order of pivot and distance."""
    def keyed(batches):
        for batch in batches:
            dense = _dense(batch, space.dims)
            distances = space.distances(dense, as_query=False)
            pivot = distances.argmin(1)
            packed = [v.tobytes() for v in dense.astype(space.stored)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivot.astype("i4")), pa.array(distances[np.arange(len(pivot)), pivot]),
                 batch.column("id"), pa.array(packed, pa.binary())], ["pivot", "distance", "id", "vector"])

    def packed(batches):
        part, held, pivot = TaskContext.get().partitionId(), [], None

        def segment():
            distances = np.concatenate([b.column("distance").to_numpy() for b in held])
            return pa.RecordBatch.from_pylist([{
                "part": part, "pivot": pivot, "low": distances[0], "high": distances[-1],
                "ids": [i for b in held for i in b.column("id").to_pylist()], "distances": distances.tobytes(),
                "vectors": b"".join(v for b in held for v in b.column("vector").to_pylist())}], schema=shape)

        shape = pa.schema([("part", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()),
                           ("ids", pa.list_(pa.int64())), ("distances", pa.binary()), ("vectors", pa.binary())])
        for batch in batches:
            pivots = batch.column("pivot").to_numpy()
            ends = [*(np.flatnonzero(np.diff(pivots)) + 1), len(pivots)]
            for start, end in zip([0, *ends], ends):
                # a segment ends with its pivot, and where a part is larger than it should be
                if held and (pivots[start] != pivot or sum(map(len, held)) >= 4 * PART):
                    yield segment()
                    held = []
                if end > start:
                    held.append(batch.slice(start, end - start))
                    pivot = int(pivots[start])
        if held:
            yield segment()

    order = ["pivot", "distance", "id"]
    return cut(vectors.mapInArrow(keyed, ROWS).repartitionByRange(parts, *order)
               .sortWithinPartitions(*order).mapInArrow(packed, SEGMENTS))


class _Best:
    """The best `most` (score, id) found for a query: larger scores, then smaller ids, null ids last."""

    def __init__(self, query: np.ndarray, space: Space, most: int, least: int | None):
        self.query, self.space, self.most = query, space, most
        self.scores, self.ids, self.none = np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, bool)
        self.bound = least  # a score that `most` vectors are known to reach
        self.radius = np.inf if least is None else space.radius(query, least)

    def add(self, vectors: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        scores = (vectors @ self.query).astype("i8")
        if self.bound is not None:
            good = scores >= self.bound
            scores, ids, none = scores[good], ids[good], none[good]
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        none = np.concatenate([self.none, none])
        order = np.lexsort((ids, none, -scores))[:self.most]
        self.scores, self.ids, self.none = scores[order], ids[order], none[order]
        if len(order) == self.most and (self.bound is None or self.scores[-1] > self.bound):
            self.bound = int(self.scores[-1])
            self.radius = self.space.radius(self.query, self.bound)


@dataclass(frozen=True)
class Segment:
    pivot: int
    ids: np.ndarray
    none: np.ndarray
    distances: np.ndarray
    vectors: np.ndarray

    def search(self, best: _Best, at: float) -> None:
        """Takes annuli outwards from distance `at`."""
        left = right = int(np.searchsorted(self.distances, at))
        width, end = ANNULUS, len(self.distances)
        while left > 0 or right < end:
            below = at - self.distances[left - 1] if left else np.inf
            above = self.distances[right] - at if right < end else np.inf
            if min(below, above) > best.radius:
                return
            if below <= above:
                rows = slice(max(left - width, 0), left)
                left = rows.start
            else:
                rows = slice(right, min(right + width, end))
                right = rows.stop
            best.add(self.vectors[rows], self.ids[rows], self.none[rows])
            width *= 2


def _search_part(segments: list[Segment], space: Space, query: np.ndarray, at: np.ndarray, most: int,
                 least: int | None) -> _Best:
    best = _Best(query, space, most, least)
    gaps = [max(s.distances[0] - at[s.pivot], at[s.pivot] - s.distances[-1], 0.0) for s in segments]
    for i in np.argsort(gaps, kind="stable"):
        if gaps[i] > best.radius:
            break
        segments[i].search(best, at[segments[i].pivot])
    return best


def _search(index: DataFrame, blocks: DataFrame, space: Space, most: int, shares: int) -> DataFrame:
    """Each block of queries against its part: the queries with the best `most` vectors of the part."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        part, segments = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if part != (row["part"], row["share"]):
                    part, segments = (row["part"], row["share"]), []
                if row["rows"] is None:
                    ids = np.array([0 if i is None else i for i in row["ids"]], "i8")
                    segments.append(Segment(row["pivot"], ids, np.array([i is None for i in row["ids"]]),
                                            np.frombuffer(row["distances"]), space.matrix(row["vectors"])))
                    continue
                queries = space.matrix(row["vectors"])
                distances = space.distances(queries, as_query=True)
                width = len(row["vectors"]) // max(len(queries), 1)
                out = []
                for i, query in enumerate(queries):
                    best = _search_part(segments, space, query, distances[i], most,
                                        row["least"][i] if row["least"] else None)
                    out.append({"row": row["rows"][i], "query_id": row["ids"][i], "own": int(query @ query),
                                "vector": row["vectors"][i * width:(i + 1) * width], "home": row["part"],
                                "ids": [None if gone else int(k) for k, gone in zip(best.ids, best.none)],
                                "scores": [int(s) for s in best.scores]})
                yield pa.RecordBatch.from_pylist(out, schema=shape)

    longs = pa.list_(pa.int64())
    shape = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("own", pa.int64()), ("vector", pa.binary()),
                       ("home", pa.int64()), ("ids", longs), ("scores", longs)])
    stored = index.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    both = stored.unionByName(blocks, allowMissingColumns=True)
    return (both.repartition("part", "share")
            .sortWithinPartitions("part", "share", F.col("rows").isNotNull()).mapInArrow(run, FOUND))


def _blocks(queries: DataFrame, space: Space, directory: np.ndarray, shares: int, first: bool) -> DataFrame:
    """Queries sent to parts: to the one of their own ring, or to all others that may hold better ones."""
    part, pivot, low, high = directory[:, 0].astype("i8"), directory[:, 1].astype("i8"), directory[:, 2], directory[:, 3]

    def run(batches):
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(start, BLOCK).to_pylist()
                queries = space.matrix([r["vector"] for r in rows])
                at = space.distances(queries, as_query=True)[:, pivot]
                gaps = np.maximum(np.maximum(low - at, at - high), 0)
                goes = np.zeros(gaps.shape, bool)
                if first:  # of the nearest pivot with vectors, the ring that is nearest
                    nearest = np.lexsort((gaps, at))[:, 0] if gaps.size else []
                    goes[np.arange(len(rows)), nearest] = True
                else:
                    for i, r in enumerate(rows):
                        full = len(r["scores"]) and r["full"]
                        goes[i] = gaps[i] <= (space.radius(queries[i], r["scores"][-1]) if full else np.inf)
                        goes[i] &= part != r["home"]
                wanted = {(int(p), int(i)) for i, s in zip(*np.nonzero(goes)) for p in [part[s]]}
                by_part: dict[int, list[int]] = {}
                for p, i in sorted(wanted):
                    by_part.setdefault(p, []).append(i)
                out = [{"part": p, "share": int(rng.integers(shares)), "rows": [rows[i]["row"] for i in chosen], "ids": [rows[i]["query_id"] for i in chosen],
                        "vectors": b"".join(rows[i]["vector"] for i in chosen),
                        "least": None if first else [
                            rows[i]["scores"][-1] if rows[i]["full"] else None for i in chosen]}
                       for p, chosen in by_part.items()]
                for at_once in range(0, len(out), 64):
                    yield pa.RecordBatch.from_pylist(out[at_once:at_once + 64], schema=shape)

    longs = pa.list_(pa.int64())
    shape = pa.schema([("part", pa.int64()), ("share", pa.int32()), ("rows", longs),
                       ("ids", longs), ("vectors", pa.binary()), ("least", longs)])
    return queries.mapInArrow(run, BLOCKS)


def top_k(queries: DataFrame, vectors: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
          scale: int = 256, pivots: int = PIVOTS, sample: int = SAMPLE, part: int = PART) -> DataFrame:
    """For every row of `queries`, the `k` rows of `vectors` with the largest inner product: query_id,
    rank (from 1), id, score. Equal scores go by the smaller id, null ids last. `queries` are rows of
    `vectors`; a query's own row is no candidate of its, other rows of the same id or vector are.

    Components count as floor(scale * x). Rows whose vector is null or has a component that is null or
    not finite take no part on either side. Components that a shorter vector lacks are 0, so an empty
    vector scores 0 with all. Repeated rows are rows of their own, as queries too. Fewer than k
    candidates give fewer rows, an empty table none. Other columns are not read. Vectors whose inner
    products could exceed a long are an error.
    """
    vectors, queries = integer_vectors(vectors, key, vector, scale), integer_vectors(queries, key, vector, scale)
    result = "query_id long, rank int, id long, score long"
    spark = vectors.sparkSession
    fitted = _space(vectors, pivots, sample)
    if fitted is None:
        return spark.createDataFrame([], result)
    space, count = fitted
    index = _index(vectors, space, min(-(-count // part), MOST_PARTS))
    # Bounded: a row for every part and one more for every pivot that begins inside a part.
    directory = np.array([tuple(r) for r in index.select("part", "pivot", "low", "high").collect()], float)

    def pack(batches):
        for batch in batches:
            rows = [v.tobytes() for v in _dense(batch, space.dims).astype(space.stored)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary())], ["query_id", "vector"])

    asked = cut(queries.mapInArrow(pack, "query_id long, vector binary").withColumn("row", F.monotonically_increasing_id()))
    shares = max(1, -(-asked.count() // TASK_QUERIES))
    most = k + 1  # the query's own row may be among them
    seeds = cut(_search(index, _blocks(asked, space, directory, shares, first=True), space, most, shares))
    rest = _search(index, _blocks(seeds.withColumn("full", F.size("scores") == most), space, directory, shares,
                                  first=False), space, most, shares)
    found = seeds.unionByName(rest).select(
        "row", "query_id", "own", F.explode(F.arrays_zip("ids", "scores")).alias("hit")
    ).select("row", "query_id", "own", F.col("hit.ids").alias("id"), F.col("hit.scores").alias("score"))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    placed = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    is_own = F.col("id").eqNullSafe(F.col("query_id")) & (F.col("score") == F.col("own"))
    placed = placed.withColumn("own_place", F.coalesce(
        F.min(F.when(is_own, F.col("place"))).over(Window.partitionBy("row")), F.lit(most + 1)))
    return placed.where(F.col("place") != F.col("own_place")).select(
        "query_id", (F.col("place") - (F.col("place") > F.col("own_place")).cast("int")).alias("rank"), "id", "score"
    ).where(F.col("rank") <= k)
