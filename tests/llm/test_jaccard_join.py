"""The Jaccard join and connected components against brute force."""

import random

import numpy as np
import pytest

from llm_cases import clashing, documents, odd_rows, prose, values
from viewstats.llm import components, jaccard_join as j


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute_force(rows, words, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    parent = [*range(len(rows))]
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (k, _) in enumerate(rows):
        root = find(parent, i)
        least[root] = min([x for x in (least.get(root), k) if x is not None], default=None)
    return sorted(((k, len(sets[i]), least[find(parent, i)]) for i, (k, _) in enumerate(rows)), key=str)


def near_copies(seed, copies=60):
    """Small and large texts with copies that differ in a few words, at both sides of the limits."""
    rng = random.Random(seed)
    rows = []
    for size in (1, 2, 4, 8, 11, 12, 13, 21, 22, 23, 32, 60, 200):
        base = prose(rng, size, 40).split()
        for _ in range(copies // 8):
            w = list(base)
            for _ in range(rng.randrange(1 + size // 12)):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], ["new"], [w[at], f"add{rng.randrange(99)}"]])
            rows.append(" ".join(w))
    base = prose(rng, 90, 300).split()
    for i in range(copies):  # a group in which nearly all link
        w = list(base)
        w[rng.randrange(90)] = f"v{i}"
        rows.append(" ".join(w))
    shared = prose(rng, 25, 300)
    rows += [f"{shared} {prose(rng, 25, 300)}" for _ in range(copies)]  # a passage in texts that don't link
    rows += [rows[0]] * copies  # exact copies
    rng.shuffle(rows)
    return [*enumerate(rows)]


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_components_of_near_copies(spark, words, percent):
    rows = near_copies(words) + odd_rows()
    rows = [(k if k is None or i < len(rows) - len(odd_rows()) else k + 10_000, t) for i, (k, t) in enumerate(rows)]
    got = j.link_sets(clashing(documents(spark, rows)), words, percent)
    assert values(got) == brute_force(rows, words, percent)


@pytest.mark.parametrize("hubs,more", [(2, 4)])
def test_rounds_miss_nothing(spark, monkeypatch, hubs, more):
    monkeypatch.setattr(j, "FIRST_HUBS", hubs)
    monkeypatch.setattr(j, "MORE_HUBS", more)
    rows = near_copies(8, 24)
    assert values(j.link_sets(documents(spark, rows), 3, 90)) == brute_force(rows, 3, 90)


@pytest.mark.parametrize("cost", [0.0, 1e9])
def test_light_and_heavy_sides_agree(spark, monkeypatch, cost):
    monkeypatch.setattr(j, "SUBSET_COST", cost)
    monkeypatch.setattr(j, "LIGHT_MOST", 24)
    rows = near_copies(9, 24)
    assert values(j.link_sets(documents(spark, rows), 2, 85)) == brute_force(rows, 2, 85)


def test_boundary_goes_with_the_cost():
    assert j.light_boundary([(9, 100, 10_000), (15, 100, 10_000), (30, 100, 10_000)], 90) == 15
    assert j.light_boundary([(9, 100, 10)], 90) == 0 and j.light_boundary([], 90) == 0


def test_subsets_meet_where_sets_do():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 12).astype(np.uint64)
    b = np.append(a[:11], np.uint64(5))
    met = {(n, x, y) for n, x, y in j.subsets(a, 90)} & {(n, x, y) for n, x, y in j.subsets(b, 90)}
    assert {n for n, _, _ in met} == {11} and len(j.subsets(a, 90)) == 13


def test_no_documents(spark):
    assert j.link_sets(documents(spark, [])).count() == 0
    assert values(j.link_sets(documents(spark, [(1, None), (2, " ")])), "key", "size", "component") == [
        (1, 0, 1), (2, 0, 2)]


def test_one_of_each(spark):
    rows = near_copies(5)
    kept = {k for k, _, least in brute_force(rows, 5, 80) if k == least}
    docs = documents(spark, rows)
    got = j.one_of_each(docs)
    assert {r["doc_id"] for r in got.collect()} == kept and got.columns == docs.columns


@pytest.mark.parametrize("kind", ["chain", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    pairs = {"chain": [(i, i + 1) for i in range(60)],
             "random": [(500, i) for i in range(40)] + [(rng.randrange(400), rng.randrange(400)) for _ in range(200)],
             "none": []}[kind]
    parent = [*range(501)]
    for a, b in pairs:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    expected = {(x, find(parent, x)) for pair in pairs for x in pair if find(parent, x) != x}
    df = spark.createDataFrame(pairs + [(1, None)] * bool(pairs), "a long, b long")
    got = components.components(df).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
