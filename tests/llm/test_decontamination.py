"""Spaced seeds and the search against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest

from llm_cases import clashing, documents, odd_rows, prose
from viewstats.llm import decontamination as d


def test_masks_hit_every_window_with_two_substitutions():
    for changed in combinations(range(d.WINDOW), 2):
        assert any(all(start + i not in changed for i in cared)
                   for cared in d.seeds_for(d.WINDOW) for start in range(d.WINDOW - cared[-1]))


def test_masks_hit_every_stretch_with_a_fifth_substituted():
    """Of the stretches no mask hits, the least of 5 x substitutions - tokens, by length: above 0 from the
    window on. What a long stretch holds is at least the sum over its parts, so lengths beyond `far` follow
    once the least of `far` tokens outweighs the lowest of any part shorter than the window."""
    masks = [[i for i, sign in enumerate(mask) if sign == "1"] for mask in d.MASKS]
    bits = max(cared[-1] for cared in masks) + 1
    states = np.arange(1 << bits)  # the last tokens, bit 0 the latest; before the stretch all count as changed
    free = np.ones(len(states), bool)
    for cared in masks:
        looks = sum(1 << (cared[-1] - i) for i in cared)
        free &= states & looks != looks
    least, lowest = np.where(states == 0, 0, 1 << 20), [0]
    for _ in range(200):
        onward = np.full(len(states), 1 << 20)
        for equal in (0, 1):
            np.minimum.at(onward, (states << 1 & len(states) - 1) | equal, least + (-1 if equal else 4))
        least = np.where(free, onward, 1 << 20)
        lowest.append(int(least.min()))
    far = next(n for n, value in enumerate(lowest) if value > -min(lowest[:d.WINDOW]))
    assert far > d.WINDOW and min(lowest[d.WINDOW:]) > 0


@pytest.mark.parametrize("length", range(15, 26))
def test_long_items_at_exactly_the_share_allowed(length):
    """Every placement of three substitutions, some hundred of more, against brute force."""
    rng, item = random.Random(length), [f"w{i}" for i in range(length)]
    placed = [*combinations(range(1, length - 1), length // 5)]
    texts = []
    for changed in placed if length < 16 else rng.sample(placed, 300):
        texts.append(" ".join(["before", *("other" if i in changed else w for i, w in enumerate(item)), "after"]))
    found = {row: equal for row, *_, equal in d.Block([(1, " ".join(item))]).find(texts)}
    assert [*found] == [*range(len(texts))]
    for row in range(0, len(texts), 25):
        assert found[row] == brute_force(texts[row], " ".join(item))


def test_placements_that_hold_no_window_with_two_substitutions():
    for length, changed in ((15, (2, 5, 11)), (20, (3, 7, 11, 15)), (20, (4, 8, 11, 15)), (25, (3, 7, 12, 17, 21))):
        item = [f"w{i}" for i in range(length)]
        text = " ".join("other" if i in changed else w for i, w in enumerate(item))
        assert [row for row, *_ in d.Block([(1, " ".join(item))]).find([text])] == [0]


@pytest.mark.parametrize("length", range(1, d.WINDOW))
def test_seeds_of_short_items_hit_every_allowed_case(length):
    (cared,) = d.seeds_for(length)
    spare = length - -(-length * 8 // 10)
    for changed in combinations(range(length), spare):
        assert any(not set(range(s, s + len(cared))) & set(changed) for s in range(length - len(cared) + 1))


def brute_force(text, item):
    """The longest aligned stretch with enough equal tokens, over all alignments."""
    a, b = d.tokens(text), d.tokens(item)
    best = None
    for shift in range(-len(b), len(a)):
        equal = [0 <= shift + j < len(a) and a[shift + j] == b[j] for j in range(len(b))]
        inside = [0 <= shift + j < len(a) for j in range(len(b))]
        found = None
        for i, j in combinations(range(len(b) + 1), 2):
            n, k = j - i, sum(equal[i:j])
            if all(inside[i:j]) and equal[i] and equal[j - 1] and 5 * k >= 4 * n and (found is None or n > found[0]):
                found = (n, k)
        if found:
            n, k = found
            enough = n >= d.WINDOW if len(b) >= d.WINDOW else 5 * k >= 4 * len(b)
            if len(b) < 4:
                enough = k == len(b) == len(a)
            if enough and (best is None or k > best):
                best = k
    return best


def cases(seed):
    rng = random.Random(seed)
    items = [prose(rng, n, 60) for n in (1, 3, 4, 5, 8, 12, 13, 14, 20, 40)]
    texts = [prose(rng, rng.randrange(30), 60) for _ in range(10)] + items
    for _ in range(60):
        words = rng.choice(items[2:]).split()
        for i in rng.sample(range(len(words)), rng.randrange(1 + len(words) // 4)):
            words[i] = "changed"
        if rng.random() < 0.3:
            words = words[rng.randrange(len(words)):]
        texts.append(f"{prose(rng, 5)} {' '.join(words).upper()} {prose(rng, 5)}")
    return texts, items


@pytest.mark.parametrize("seed", range(4))
def test_finds_what_brute_force_finds(seed):
    """Windows of 13 with two substitutions are sure to be found; longer stretches hold one."""
    texts, items = cases(seed)
    block = d.Block([*enumerate(items)])
    got = {(row, block.keys[item]): equal for row, item, *_, equal in block.find(texts)}
    expected = {(i, j): brute_force(t, item) for i, t in enumerate(texts) for j, item in enumerate(items)}
    assert set(got) == {k for k, v in expected.items() if v is not None}


def test_a_run_too_short_does_not_hide_a_stretch():
    """12 equal tokens, which mismatches around them would make longer than the stretch that counts."""
    item = [f"w{i}" for i in range(45)]
    text = [w if i < 12 or i >= 32 and i not in (36, 40) else f"other{i}" for i, w in enumerate(item)]
    for a, b in ((text, item), (text[::-1], item[::-1])):
        (found,) = d.Block([(1, " ".join(b))]).find([" ".join(a)])
        at = 32 if a is text else 0
        assert found == (0, 0, at, at + 13, at, at + 13, 11) and brute_force(" ".join(a), " ".join(b)) == 11


@pytest.mark.parametrize("seed", range(3))
def test_long_items_with_edited_middles(seed):
    rng = random.Random(seed)
    item = [f"w{i}" for i in range(48)]
    texts = []
    for _ in range(40):
        share, text = 0.0, []
        for i, word in enumerate(item):
            if i % 12 == 0:
                share = rng.choice([0, 0.1, 0.2, 1])
            text.append("other" if rng.random() < share else word)
        texts.append(" ".join(text))
    found = {row: equal for row, *_, equal in d.Block([(1, " ".join(item))]).find(texts)}
    expected = {row: brute_force(text, " ".join(item)) for row, text in enumerate(texts)}
    assert found == {row: equal for row, equal in expected.items() if equal is not None}


def test_overlaps_and_blocks(spark):
    texts, items = cases(9)
    docs = documents(spark, [*enumerate(texts)] + [(k, t) for k, t in odd_rows()])
    bench = spark.createDataFrame([(j, t) for j, t in enumerate(items)] + [(50, None), (51, "")],
                                  "item_id long, text string")
    whole = d.overlaps(clashing(docs), bench)
    rows = {tuple(r) for r in whole.collect()}
    assert rows == {tuple(r) for r in d.overlaps(docs, bench, block_tokens=20).collect()}
    block = d.Block([*enumerate(items)])
    assert {(r[0], r[1]) for r in rows} == {(row, block.keys[i]) for row, i, *_ in block.find(texts)}
    for key, item, start, end, at, to, equal in rows:
        a, b = d.tokens(texts[key])[start:end], d.tokens(items[item])[at:to]
        assert len(a) == len(b) and equal == sum(x == y for x, y in zip(a, b)) >= 0.8 * len(a)
    for block_tokens in (20, 200_000):
        kept = d.drop_contaminated(clashing(docs), bench, block_tokens=block_tokens)
        assert kept.columns == clashing(docs).columns
        left = [r["text"] for r in kept.collect()]
        hit = {r[0] for r in rows}
        expected = [t for i, t in enumerate(texts) if i not in hit] + [t for _, t in odd_rows()]
        assert sorted(left, key=str) == sorted(expected, key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, odd_rows())
    assert d.overlaps(docs, none).count() == 0
    assert d.drop_contaminated(docs, none).count() == len(odd_rows())
    assert d.overlaps(documents(spark, []), spark.createDataFrame([(1, "a b c d e")], none.schema)).count() == 0


def test_many_items_share_a_seed():
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    block = d.Block([(i, f"{item} tail{i}") for i in range(50)])
    assert len([*block.find([item])]) == 50
    assert np.all([equal == 14 for *_, equal in block.find([item])])
