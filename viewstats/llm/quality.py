"""Text quality by a factorisation machine.

A text's features are its words, hashed; steps of structure statistics (share of capitals, signs,
repeated words and lines and the like); and steps of its length. The score is

    sigmoid(bias + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

so that all pairs of features interact through low-rank factors in time linear in the features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstats.llm.common import cut, numbered_columns, whole

WORDS = 1 << 14
STEPS = 16
FACTORS = 8
STEPS_LEAST = 600
SAMPLE = 12_000
MOST_FEATURES = 12_000_000  # of the sample, in all
STRUCTURE = ["bytes", "words", "word_length", "capitals", "digits", "signs", "odd_signs", "not_ascii",
             "spaces", "distinct_words", "commonest_word", "lines", "distinct_lines", "line_ends",
             "joined_signs", "repeated_pairs"]
FEATURES = WORDS + STEPS * len(STRUCTURE)
# Classes of bytes.
CAPITALS, DIGITS, SPACES = range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32)
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
COMMON_SIGNS = b".,;:'\"-()?"
_CLASS = np.zeros((256, 6), np.float64)
_CLASS[list(CAPITALS), 0] = 1
_CLASS[list(DIGITS), 1] = 1
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()], 2] = 1
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and b not in COMMON_SIGNS], 3] = 1
_CLASS[range(128, 256), 4] = 1
_CLASS[list(SPACES), 5] = 1


def _number(word: bytes) -> int:
    """Feature of a word: signs around it and its case don't count."""
    return xxhash.xxh3_64_intdigest(word.lower().strip(SIGNS)) % WORDS


class Featurizer:
    """Sparse features of texts: columns and values, the words' scaled to length 1."""

    def structure(self, text: bytes, words: list[bytes], counts: np.ndarray, pairs: float) -> np.ndarray:
        """The statistics, each between 0 and 1."""
        size, n = max(1, len(text)), max(1, len(words))
        capitals, digits, signs, odd, high, spaces = np.bincount(
            np.frombuffer(text, np.uint8), minlength=256) @ _CLASS / size
        lines = [line for line in text.split(b"\n") if line.strip()]
        ends = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines)
        joined = sum(word[-1] in b"!*$%&#|" for word in words)
        return np.array([
            np.log2(size) / 24, np.log2(n) / 20, min(1.0, (size - spaces * size) / n / 20), capitals, digits,
            signs, odd, high, spaces, len(counts) / n, counts.max(initial=0) / n,
            min(1.0, len(lines) / n), len(set(lines)) / max(1, len(lines)), ends / max(1, len(lines)),
            joined / n, pairs])

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        numbers = np.fromiter(map(_number, words), np.int64, len(words))
        columns, counts = np.unique(numbers, return_counts=True)
        pair = numbers[1:] * WORDS + numbers[:-1]
        repeated = 1 - len(np.unique(pair)) / len(pair) if len(pair) else 0.0
        weight = np.log1p(counts)
        weight /= max(1e-9, float(np.sqrt((weight ** 2).sum())))
        statistics = self.structure(text, words, counts, repeated)
        # Square roots spread the small shares, where most texts differ, over more steps.
        step = np.minimum(STEPS - 1, np.sqrt(np.clip(statistics, 0, 1)) * STEPS).astype(np.int64)
        structure = WORDS + np.arange(len(STRUCTURE)) * STEPS + step
        return (np.concatenate([columns, structure]),
                np.concatenate([weight, np.full(len(STRUCTURE), 0.5)]))


@dataclass
class Machine:
    """A factorisation machine: bias, weights, factors (features x FACTORS)."""
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int):
        """Scores before the sigmoid, and the sums over factors that a step of fitting needs."""
        linear = np.bincount(rows, self.weights[columns] * values, minlength=n)
        starts = np.searchsorted(rows, np.arange(n))  # every text has features
        parts = self.factors[columns] * values[:, None]
        sums = np.add.reduceat(parts, starts, axis=0)
        pairs = (sums ** 2 - np.add.reduceat(parts ** 2, starts, axis=0)).sum(axis=1)
        return self.bias + linear + pairs / 2, sums

    def score(self, features: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Probability of label 1 for each text."""
        rows = np.repeat(np.arange(len(features)), [len(c) for c, _ in features])
        columns, values = (np.concatenate(part) for part in zip(*features))
        return 1 / (1 + np.exp(-np.clip(self.raw(rows, columns, values, len(features))[0], -30, 30)))


def fit(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 8,
        step: float = 0.1, decay: float = 1e-5, batch: int = 128, seed: int = 3) -> Machine:
    """Fits by Adagrad on the logistic loss. Without rows of both labels the machine gives their share
    (one half without any row)."""
    random = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(FEATURES), random.normal(0, 0.05, (FEATURES, FACTORS)))
    if len(set(labels.tolist())) < 2:
        machine.factors[:] = 0
        return machine
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-2), np.full((FEATURES, FACTORS), 1e-2), 1e-2
    for _ in range(max(rounds, -(-STEPS_LEAST * batch // len(features)))):
        order = random.permutation(len(features))
        for start in range(0, len(order), batch):
            chosen = order[start:start + batch]
            part = [features[i] for i in chosen]
            rows = np.repeat(np.arange(len(part)), [len(c) for c, _ in part])
            columns, values = (np.concatenate(x) for x in zip(*part))
            raw, sums = machine.raw(rows, columns, values, len(part))
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) / len(part)
            order_by = np.argsort(columns, kind="stable")
            in_order = columns[order_by]
            first = np.flatnonzero(np.r_[True, in_order[1:] != in_order[:-1]])
            used, pull = in_order[first], error[rows] * values
            # By feature: the weights' gradient, that of the factors, and what their own share takes off.
            pulls = np.column_stack([pull, pull * values, pull[:, None] * sums[rows]])[order_by]
            pulls = np.add.reduceat(pulls, first, axis=0)
            grad = pulls[:, 0] + decay * machine.weights[used]
            seen_w[used] += grad ** 2
            machine.weights[used] -= step * grad / np.sqrt(seen_w[used])
            v = machine.factors[used]
            grad = pulls[:, 2:] - pulls[:, 1:2] * v + decay * v
            seen_v[used] += grad ** 2
            machine.factors[used] -= step * grad / np.sqrt(seen_v[used])
            seen_b += error.sum() ** 2
            machine.bias -= step * error.sum() / np.sqrt(seen_b)
    return machine


def held_out(key: str = "doc_id"):
    """Rows that no score may learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _texts(docs: DataFrame, text: str, *others) -> DataFrame:
    return docs.select(*others, whole(text).cast("binary").alias("__text"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", most: int = SAMPLE, most_features: int = MOST_FEATURES, seed: int = 3) -> Machine:
    """A machine fitted on at most `most` labelled rows with about `most_features` features at most
    (chosen by hashes of the key) that are not held out. Rows without key, label or document are not used."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)).select(
        F.col(key).alias("__key"), F.col(label).cast("double").alias("__label")).distinct()
    n = usable.count()
    if n > most:
        usable = usable.where(F.pmod(F.xxhash64(F.lit(seed), "__key"), F.lit(n)) < most * 95 // 100).limit(most)
    chosen = _texts(docs.select(F.col(key), F.col(text)).join(F.broadcast(usable), F.col(key) == F.col("__key")),
                    text, "__key", "__label")

    def run(batches):
        featurizer = Featurizer()
        for batch in batches:
            for k, y, t in zip(*batch.columns):
                columns, values = featurizer(t.as_py())
                yield pa.RecordBatch.from_pydict({
                    "key": [k.as_py()], "label": [y.as_py()], "columns": [columns.astype("<i4").tobytes()],
                    "values": [values.astype("<f4").tobytes()]})

    rows = cut(chosen.mapInArrow(run, f"key {dict(labels.dtypes)[key]}, label double, columns binary, values binary"))
    total = rows.agg(F.sum(F.octet_length("columns"))).first()[0] or 0
    if total > 4 * most_features:  # very long texts: fewer of them
        rows = rows.where(F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(total)) < 4 * most_features)
    sample = sorted(rows.collect(), key=lambda r: (r["key"], r["label"], r["columns"]))
    features = [(np.frombuffer(r["columns"], "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(np.float64))
                for r in sample]
    return fit(features, np.array([r["label"] for r in sample]), seed=seed)


def _scored(texts: list[bytes], featurizer: Featurizer, machine: Machine) -> np.ndarray:
    return machine.score([featurizer(text) for text in texts]) if texts else np.zeros(0)


def _slices(texts: pa.Array) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= 4 << 20:
            yield held
            held, size = [], 0
    if held:
        yield held


def score(docs: DataFrame, machine: Machine, text: str = "text", column: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 of each whole text as the column `column` (replaced where
    it exists). A null text is empty; an empty text has a score like others."""
    sent = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))
    docs = docs.drop(column)
    rows, names = numbered_columns(_texts(docs, text, "*")), docs.columns
    at = len(names)

    def run(batches):
        featurizer, machine = Featurizer(), Machine(*sent.value)
        for batch in batches:
            scores = [_scored(part, featurizer, machine) for part in _slices(batch.column(at))]
            values = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], values], [*names, column])

    return rows.mapInArrow(run, docs.withColumn(column, F.lit(None).cast("double")).schema)
