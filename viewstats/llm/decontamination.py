"""Benchmark passages in documents, found with spaced seeds.

A mask looks at some of the tokens of a window and ignores the rest, so a hash under a mask is blind to
substitutions at the ignored positions. The masks below are chosen so that any stretch of `WINDOW` tokens
or more with up to a fifth of them substituted is hit by at least one of them, inside the stretch (the
tests prove it for every length). Hashes of the documents meet the hashes of the benchmark; around each
hit the two texts are compared token by token and the longest stretch with `IDENTITY` of its tokens equal
is kept.

The documents never move: blocks of at most about `block_tokens` benchmark tokens go to the tasks, one
after another, so neither the memory of a task nor what is sent depends on the size of the benchmark.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstats.llm.common import Memo, numbered_columns, whole, word_count

WINDOW = 13
IDENTITY = 0.8
# 1 looks at a token, 0 ignores it. The first three hit all windows with two substitutions,
# the others what is left of stretches of 15 to 25 tokens with three to five.
MASKS = ["11101111", "11110010011", "10111111", "11101000001011", "11100101101", "11111011"]
BLOCK_TOKENS = 200_000
TABLE_BITS = 20
BATCH_TOKENS = 1 << 20
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def tokens(text: str | None) -> list[str]:
    """Words in lower case without the signs around them."""
    return [EDGE.sub("", word) for word in (text or "").lower().split()]


def _mixed(values: np.ndarray, cared: list[int], salt: int) -> np.ndarray:
    """Hashes of all windows under a mask that looks at the offsets `cared`."""
    n = len(values) - cared[-1]
    hashes = np.full(max(n, 0), salt, np.uint64)
    for offset in cared:
        hashes = (hashes ^ values[offset:offset + len(hashes)]) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    return hashes


def seeds_for(length: int, identity: float = IDENTITY) -> list[list[int]]:
    """Offsets each mask looks at, for items of so many tokens. Items shorter than the window must match
    as a whole: with m substitutions allowed, one of m + 1 parts is free of them."""
    if length >= WINDOW:
        return [[i for i, sign in enumerate(mask) if sign == "1"] for mask in MASKS]
    return [[*range(max(1, length // (length - math.ceil(length * identity) + 1)))]]


class Block:
    """Items of the benchmark, ready for finding. `items`: (item key, text) rows."""

    def __init__(self, items: list[tuple], identity: float = IDENTITY):
        self.identity = identity
        texts = [(key, tokens(text)) for key, text in items]
        self.keys = [key for key, words in texts if words]
        vocabulary: dict[str, int] = {}
        self.items = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int64)
                      for _, words in texts if words]
        # Number of a raw word: that of its token in this block, or 0.
        self.numbers = Memo(lambda word: vocabulary.get(EDGE.sub("", word), 0))
        # Scrambled numbers for the hashes; 0, a word of no item, is told from all of them.
        self.codes = np.arange(len(vocabulary) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        found: dict[tuple[int, ...], list] = {}
        for at, item in enumerate(self.items):
            for cared in seeds_for(len(item), identity):
                hashes = _mixed(self.codes[item], cared, len(cared))
                found.setdefault(tuple(cared), []).append((hashes, np.full(len(hashes), at), np.arange(len(hashes))))
        self.seeds = []
        for cared, parts in found.items():
            hashes, of, offset = (np.concatenate(column) for column in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            present = np.zeros(1 << TABLE_BITS, bool)
            present[hashes >> np.uint64(64 - TABLE_BITS)] = True
            self.seeds.append(([*cared], hashes[order], of[order], offset[order], present))

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(text, item, start, end, item start, item end, equal tokens) of the best stretch of each text
        and item that overlap."""
        rows = [np.fromiter(map(self.numbers.__getitem__, (text or "").lower().split()), np.int64)
                for text in texts]
        ends = np.cumsum([len(row) for row in rows])
        stream = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        codes = self.codes[stream]
        diagonals = set()
        for cared, known, of, offset, present in self.seeds:
            hashes = _mixed(codes, cared, len(cared))
            places = np.flatnonzero(present[hashes >> np.uint64(64 - TABLE_BITS)])
            left = np.searchsorted(known, hashes[places], "left")
            right = np.searchsorted(known, hashes[places], "right")
            for place, a, b in zip(places[right > left], left[right > left], right[right > left]):
                row = int(np.searchsorted(ends, place, "right"))
                diagonals.update((row, int(of[i]), int(place - offset[i])) for i in range(a, b))
        best: dict[tuple[int, int], tuple] = {}
        for row, item, shift in diagonals:
            found = self._stretch(stream, int(ends[row]) - len(rows[row]), int(ends[row]), self.items[item], shift)
            if found and (row, item) not in best or found and found > best[row, item]:
                best[row, item] = found
        for (row, item), (equal, start, end, at, to) in sorted(best.items()):
            first = int(ends[row]) - len(rows[row])
            yield row, item, start - first, end - first, at, to, equal

    def _stretch(self, stream, first: int, end: int, item: np.ndarray, shift: int) -> tuple | None:
        """The longest stretch along a diagonal that begins and ends with an equal token and has enough of
        them, if it is long enough."""
        a, b = max(first, shift), min(end, shift + len(item))
        equal = stream[a:b] == item[a - shift:b - shift]
        height = np.concatenate([[0.0], np.cumsum(np.where(equal, 1 - self.identity, -self.identity))])
        on = np.flatnonzero(equal)
        if not len(on):
            return None
        # From the first equal token not higher than the end, which is past an equal token.
        low = np.minimum.accumulate(height[on])
        begin = on[np.searchsorted(-low, -height[on + 1] - 2e-9)]
        longest = int(np.argmax(on + 1 - begin))
        start, length = int(begin[longest]), int(on[longest] + 1 - begin[longest])
        count = int(equal[start:start + length].sum())
        enough = length >= WINDOW if len(item) >= WINDOW else count >= math.ceil(len(item) * self.identity)
        if len(item) < 4:  # too short to tell anything but a document that is nothing else
            enough = count == len(item) == end - first
        if not enough:
            return None
        return count, a + start, a + start + length, a + start - shift, a + start + length - shift


def blocks(benchmark: DataFrame, key: str, text: str, block_tokens: int = BLOCK_TOKENS) -> Iterator[list]:
    """(item key, text) rows of the benchmark in blocks of about so many tokens (an item that is longer makes its block longer)."""
    items = benchmark.select(F.col(key).alias("key"), whole(text).alias("text"))
    total = items.agg(F.sum(word_count("text"))).first()[0] or 0
    n = max(1, -(-total // block_tokens))
    part = F.pmod(F.xxhash64("key", "text"), F.lit(n))
    for i in range(n):
        yield [tuple(row) for row in items.where(part == i).orderBy("key", "text").collect()]


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of a batch, some at a time."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append(text.as_py())
        size += len(held[-1] or "") // 6
        if size >= BATCH_TOKENS:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
             item_key: str = "item_id", item_text: str = "text",
             block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per row of `docs` and item with an overlap: key, item, doc_start, doc_end, item_start,
    item_end (tokens, ends excluded), n_equal.

    An overlap is an aligned stretch of `WINDOW` tokens or more, or with 80 % of all tokens of a shorter
    item, of which 80 % are equal; items of under four tokens match only documents that are nothing
    else. Null and empty texts overlap nothing; null keys are reported as null; rows and items that
    repeat are reported each. Other columns are not read. Empty tables give an empty table.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    result = None
    for items in blocks(benchmark, item_key, item_text, block_tokens):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def find(batches, sent=sent):
            block = Block(sent.value)
            for batch in batches:
                keys = batch.column(0)
                for first, texts in _slices(batch.column(1)):
                    found = [(keys[first + row].as_py(), block.keys[item], *where)
                             for row, item, *where in block.find(texts)]
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(column, pa.int64()) for column in zip(*found)], FOUND)

        part = rows.mapInArrow(find, ", ".join(f"{name} long" for name in FOUND))
        result = part if result is None else result.unionByName(part)
    return result


FOUND = ["key", "item", "doc_start", "doc_end", "item_start", "item_end", "n_equal"]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                      item_key: str = "item_id", item_text: str = "text",
                      block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of `docs` that overlap no item, with all their columns; see `overlaps`."""
    at, names = docs.columns.index(text), docs.columns
    for items in blocks(benchmark, item_key, item_text, block_tokens):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches, sent=sent):
            block = Block(sent.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for first, texts in _slices(batch.column(at)):
                    for row, *_ in block.find(texts):
                        clean[first + row] = False
                yield batch.filter(pa.array(clean)).rename_columns(names)

        docs = numbered_columns(docs).mapInArrow(keep, docs.schema)
    return docs
