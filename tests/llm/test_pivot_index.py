"""Top-k search against brute force over all pairs."""

import random
from math import floor, inf, isfinite, nan

import pytest
from pyspark.sql import functions as F

from llm_cases import clashing
from viewstats.llm.pivot_index import top_k

VECTORS = "vec_id long, embedding array<float>"


def brute_force(rows, asked, k):
    """Rows of (vec_id, vector); `asked` are positions of queries."""
    good = {i: [floor(256 * x) for x in v] for i, (_, v) in enumerate(rows)
            if v is not None and all(x is not None and isfinite(x) for x in v)}
    found = []
    for i in asked:
        if i in good:
            hits = sorted((-sum(a * b for a, b in zip(good[i], good[j])), rows[j][0] is None, rows[j][0] or 0)
                          for j in good if j != i)
            found += [(rows[i][0], rank, None if none else key, -score)
                      for rank, (score, none, key) in enumerate(hits[:k], 1)]
    return sorted(found, key=str)


def got(spark, rows, every=5, k=4, add=lambda df: df, **how):
    df = add(spark.createDataFrame(rows, VECTORS).repartition(3))
    return sorted(map(tuple, top_k(df.where(F.col("vec_id") % every == 0), df, k, **how).collect()), key=str)


def asked(rows, every=5):
    return [i for i, (key, _) in enumerate(rows) if key is not None and key % every == 0]


def clustered(seed, n=400, dims=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    # In binary fractions, so that float32 holds them.
    return [(i, [round((c + rng.gauss(0, 0.1)) * 1024) / 1024 for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"pivots": 5, "sample": 50, "part": 30}, {"pivots": 1, "part": 7}])
def test_clusters(spark, how):
    rows = clustered(3)
    assert got(spark, rows, **how) == brute_force(rows, asked(rows), 4)


def test_norms_differ(spark):
    rng = random.Random(5)
    rows = [(i, [x * scale for x in v]) for i, v in clustered(4, 200) for scale in [2.0 ** rng.randrange(-4, 5)]]
    assert got(spark, rows, part=20) == brute_force(rows, asked(rows), 4)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (5, [1.0, 0.5]), (5, None), (5, []), (None, [1.0, 0.5]), (None, [2.0, 1.0]),
            (10, [0.0, None]), (10, [nan, 1.0]), (15, [inf, 1.0]), (15, [-1.0, -0.25]), (20, [3.0]), (20, [0.0, 0.0, 7.0]),
            (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [1.0, 0.5])]
    expected = brute_force(rows, asked(rows), 4)
    assert got(spark, rows, part=3) == expected
    assert got(spark, rows, add=clashing) == expected


def test_third_of_all_rows_is_one_vector(spark):
    rows = [(i, [0.5, 0.25, 1.0]) if i % 3 else (i, v[:3]) for i, v in clustered(6, 300)]
    assert got(spark, rows, part=16) == brute_force(rows, asked(rows), 4)


def test_few_and_no_candidates(spark):
    assert got(spark, [(0, [1.0])]) == []
    assert got(spark, [(0, [1.0]), (1, [-1.0])]) == [(0, 1, 1, -65536)]
    assert got(spark, []) == [] and got(spark, [(5, None)]) == []


def test_large_components(spark):
    rows = [(i, [float(2 ** 22 + i), float(-i), 1.0]) for i in range(40)]
    assert got(spark, rows) == brute_force(rows, asked(rows), 4)
    with pytest.raises(ValueError, match="do not fit"):
        got(spark, [(0, [1e30]), (1, [1.0])])
