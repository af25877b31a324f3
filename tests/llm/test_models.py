"""The quality classifier and the hidden Markov model."""

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_cases import clashing, documents, odd_rows, prose
from viewstats.llm import hmm, quality
from viewstats.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def junk(rng, words):
    kind = rng.randrange(3)
    text = prose(rng, words)
    if kind == 0:
        return text.upper().replace(" ", "!! ")
    if kind == 1:
        return " ".join([text.split()[0]] * words)
    return text.replace(" ", "$$$ ")


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        rows.append((i, prose(rng, 20 + rng.randrange(60)) if good else junk(rng, 20 + rng.randrange(60))))
        labels.append((i, int(good), 0))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_pairs_by_sums_of_squares():
    rng = np.random.default_rng(0)
    machine = quality.Machine(0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, quality.FACTORS)))
    columns, x = rng.choice(quality.FEATURES, 12, replace=False), rng.normal(size=12)
    pairs = sum(machine.factors[a] @ machine.factors[b] * x[i] * x[k]
                for i, a in enumerate(columns) for k, b in enumerate(columns) if i < k)
    raw, _ = machine.raw(np.zeros(12, int), columns, x, 1)
    assert raw[0] == pytest.approx(0.3 + machine.weights[columns] @ x + pairs)


def plain_features(text):
    """Columns and values of a text, counted one byte, word and line at a time."""
    data = (text or "").encode()
    words, size = data.split(), max(1, len(data))
    numbers = [xxhash.xxh3_64_intdigest(w.lower().strip(quality.SIGNS)) % quality.WORDS for w in words]
    counts, n = Counter(numbers), max(1, len(words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    signs = [b for b in data if 32 < b < 127 and not chr(b).isalnum()]
    spaces = sum(b in quality.SPACES for b in data)
    followed = [*zip(numbers, numbers[1:])]
    shares = [
        math.log2(size) / 24, math.log2(n) / 20, (size - spaces) / n / 20, sum(65 <= b <= 90 for b in data) / size,
        sum(48 <= b <= 57 for b in data) / size, len(signs) / size,
        sum(b not in quality.COMMON_SIGNS for b in signs) / size, sum(b > 127 for b in data) / size, spaces / size,
        len(counts) / n, max(counts.values(), default=0) / n, len(lines) / n, len(set(lines)) / max(1, len(lines)),
        sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines) / max(1, len(lines)),
        sum(w[-1] in b"!*$%&#|" for w in words) / n, 1 - len(set(followed)) / len(followed) if followed else 0.0]
    length = math.sqrt(sum(math.log(1 + c) ** 2 for c in counts.values()))
    x = {number: math.log(1 + c) / length for number, c in counts.items()}
    for i, share in enumerate(shares):
        x[quality.WORDS + i * quality.STEPS + min(quality.STEPS - 1, int(math.sqrt(min(1, share)) * quality.STEPS))] = 0.5
    return x


def test_scores_are_sums_over_all_pairs(spark, labelled):
    """The scores of whole texts, from plain counts and a sum over every pair of features."""
    docs, labels = labelled
    machine = quality.train(docs, labels, most=200)
    assert np.abs(machine.weights).max() > 0.01
    rng = random.Random(9)
    texts = [None, "", " ", "x", "One. Two!\nOne. Two!\n", "\u00e9t\u00e9 $$$ A1|B2 # 77", "word " * 3000]
    texts += [prose(rng, 40) for _ in range(6)] + [junk(rng, 40) for _ in range(6)]
    got = quality.score(documents(spark, [*enumerate(texts)]), machine).select("text", "score").collect()
    assert len(got) == len(texts)
    for text, found in got:
        x = plain_features(text)
        raw = machine.bias + sum(machine.weights[a] * x[a] for a in x) + sum(
            float(machine.factors[a] @ machine.factors[b]) * x[a] * x[b] for a in x for b in x if a < b)
        assert found == pytest.approx(1 / (1 + math.exp(-raw)), rel=1e-6)


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    machine = quality.train(docs, labels)
    scored = quality.score(docs, machine).where(quality.held_out()).join(labels, "doc_id").collect()
    right = sum((r["score"] >= 0.7) == bool(r["quality"]) for r in scored)
    assert len(scored) > 100 and right / len(scored) > 0.97


def test_held_out_labels_teach_nothing(labelled):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert a.bias == b.bias and np.array_equal(a.factors, b.factors)


def test_quality_of_odd_rows(spark, labelled):
    docs, labels = labelled
    machine = quality.train(docs, labels, most=100)
    odd = clashing(documents(spark, odd_rows()))
    got = quality.score(odd, machine)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["score"]
    scores = [r["score"] for r in got.collect()]
    assert len(scores) == len(odd_rows()) and all(0 <= s <= 1 for s in scores)
    assert quality.score(documents(spark, []), machine).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(None, 1, 0), (1, None, 0), (777, 0, 0)]])
def test_labels_that_cannot_teach(spark, labels):
    rows = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, "a b"), (2, "c")])
    assert all(0 < r["score"] < 1 for r in quality.score(docs, quality.train(docs, rows)).collect())


def test_quality_of_the_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, SF_DIR, "labels"))).where(quality.held_out())
    rows = scored.join(table(spark, SF_DIR, "labels"), "doc_id").collect()
    assert sum((r["score"] >= 0.7) == bool(r["quality"]) for r in rows) / len(rows) > 0.95


# Hidden Markov model


@pytest.fixture
def small(monkeypatch):
    """A model small enough to sum over all paths."""
    rng = np.random.default_rng(4)
    start, move = rng.random(hmm.STATES), rng.random((hmm.STATES, hmm.STATES))
    emit = rng.random((hmm.ALL, hmm.STATES))
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def test_forward_recursion_is_exact(small):
    texts = [np.array(t, np.int32) for t in ([hmm.END], [3, hmm.END], [5, 3, 5, hmm.END])]
    for text, got in zip(texts, hmm.log10_likelihood(small, texts)):
        total = 0.0
        for path in product(range(hmm.STATES), repeat=len(text)):
            p = small.start[path[0]] * small.emit[text[0], path[0]]
            for a, b, symbol in zip(path, path[1:], text[1:]):
                p *= small.move[a, b] * small.emit[symbol, b]
            total += p
        assert got == pytest.approx(math.log10(total))


def test_expected_counts_are_those_of_all_paths(small):
    text = np.array([7, 2, 7, hmm.END], np.int32)
    start, move, emit = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((hmm.ALL, hmm.STATES))
    hmm.expected_counts(small, [text, text[2:], text], start, move, emit)
    expected, total = np.zeros_like(move), 0.0
    for path in product(range(hmm.STATES), repeat=len(text)):
        p = small.start[path[0]] * small.emit[text[0], path[0]]
        for a, b, symbol in zip(path, path[1:], text[1:]):
            p *= small.move[a, b] * small.emit[symbol, b]
        total += p
        for a, b in zip(path, path[1:]):
            expected[a, b] += p
    short = np.zeros_like(move)
    weights = {(a, b): small.start[a] * small.emit[7, a] * small.move[a, b] * small.emit[hmm.END, b]
               for a in range(hmm.STATES) for b in range(hmm.STATES)}
    for (a, b), p in weights.items():
        short[a, b] = p / sum(weights.values())
    assert np.allclose(move, 2 * expected / total + short)
    assert start.sum() == pytest.approx(3) and emit.sum() == pytest.approx(10)
    assert emit[7].sum() == pytest.approx(5) and emit[2].sum() == pytest.approx(2)


def test_equal_texts_count_as_often_as_they_occur(small):
    rng = np.random.default_rng(5)
    texts = [np.append(rng.integers(0, 50, n), hmm.END).astype(np.int32) for n in rng.integers(0, 90, 30)]
    times = rng.integers(1, 5, 30)
    one, many = ([np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((hmm.ALL, hmm.STATES))] for _ in "ab")
    hmm.expected_counts(small, texts, *one, times)
    hmm.expected_counts(small, [t for t, n in zip(texts, times) for _ in range(n)], *many)
    assert all(np.allclose(a, b) for a, b in zip(one, many))


def test_every_round_reads_all_texts(spark):
    """Also long texts and copies; beside it the rounds one after another over all texts in this process."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 7000 if i % 20 == 0 else rng.randrange(60), 300)) for i in range(80)]
    rows += [(100 + i, rows[1][1]) for i in range(30)] + [(200, None), (201, "")]
    trained = hmm.train(documents(spark, rows))
    reader = hmm.Reader(trained.lexicon)
    texts = [reader((text or "").encode())[2] for _, text in rows]
    random_counts = np.random.default_rng(11)
    emit = trained.lexicon.shares[:, None] * random_counts.uniform(0.2, 1.8, (hmm.ALL, hmm.STATES)) * 100
    move = np.eye(hmm.STATES) * 10 + random_counts.uniform(0.5, 1.5, (hmm.STATES,) * 2)
    model = hmm.from_counts(np.ones(hmm.STATES), move, emit, trained.lexicon.shares)
    for _ in range(14):
        counts = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((hmm.ALL, hmm.STATES))
        hmm.expected_counts(model, texts, *counts)
        model = hmm.from_counts(*counts, trained.lexicon.shares)
    assert np.allclose(trained.model.move, model.move, rtol=1e-4, atol=1e-7)
    assert np.allclose(trained.model.emit, model.emit, rtol=1e-4, atol=1e-9)


def test_blocks_do_not_change_likelihoods(small):
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(0, 50, n), hmm.END).astype(np.int32) for n in rng.integers(0, 90, 70)]
    alone = [hmm.log10_likelihood(small, [t])[0] for t in texts]
    assert np.allclose(hmm.log10_likelihood(small, texts), alone)


def test_steps_work_on_many_texts():
    """What a step costs besides its tokens is shared by enough of them, long texts included."""
    lengths = np.random.default_rng(6).lognormal(5.6, 1.1, 33_000).astype(int) + 1
    texts = [np.zeros(n, hmm.CODE) for n in lengths]
    blocks = list(hmm._blocks(texts))
    assert sorted(i for chosen in blocks for i in chosen) == list(range(len(texts)))
    assert lengths.sum() > 300 * sum(lengths[chosen[0]] for chosen in blocks)


def test_steps_of_a_task_work_on_wide_rows():
    lengths = np.random.default_rng(6).lognormal(5.6, 1.1, 33_000).astype(int) + 1
    blocks = list(hmm._blocks([np.zeros(n, hmm.CODE) for n in lengths]))
    assert lengths.sum() > 550 * sum(lengths[chosen[0]] for chosen in blocks)
    assert all(lengths[chosen].sum() <= max(hmm.MOST_TOKENS, lengths[chosen[0]]) for chosen in blocks)


def reading_lexicon(counts: Counter) -> hmm.Lexicon:
    words = sorted(counts, key=lambda w: (-counts[w], w))
    n = np.array([counts[w] for w in words], float)
    return hmm.Lexicon(words, np.log10(n + 1), np.zeros(hmm.ENDINGS), np.ones(hmm.ALL) / hmm.ALL, 1, 1, 1)


def plain_ending(word: bytes) -> int:
    bare = word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return zlib.crc32(bare[-3:], len(bare) != len(word)) % hmm.ENDINGS


def test_words_are_read_many_at_once(monkeypatch):
    """No call for a single word, and the same words, places and symbols as those of plain Python."""
    def one_by_one(word):
        raise AssertionError("words are read one by one")

    rng = random.Random(12)
    texts = [bytes(rng.randrange(256) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += [b"", b" ", b"\n a\x0bB\x0c", b"...", b"x!", "É. été, ÉTÉ\x85a\u00a0b".encode(), b"\x1c\x1d", b"The the THE!"]
    texts += [" ".join(f"w{rng.randrange(90)}{rng.choice(['', '.', '?)'])}" for _ in range(50)).encode() for _ in range(60)]
    counts = Counter(w for t in texts[::2] for w in t.lower().split())
    lexicon = reading_lexicon(counts)
    monkeypatch.setattr(hmm, "ending", one_by_one)
    monkeypatch.setattr(hmm, "SYMBOLS", 40)
    places, reader = {w: i for i, w in enumerate(lexicon.words)}, hmm.Reader(lexicon)
    for text in texts:
        words = text.lower().split()
        own = [places[w] if places.get(w, 40) < 40 else 40 + plain_ending(w) for w in words]
        got, at, symbols = reader(text)
        assert got == words and symbols.tolist() == [*own, hmm.END]
        assert [i if i >= 0 else None for i in at.tolist()] == [places.get(w) for w in words]
    column = pa.array([b"before", *texts, b"after"], pa.binary()).slice(1, len(texts))
    assert [t.tolist() for t in reader.read(column).texts()] == [reader(t)[2].tolist() for t in texts]


def test_parts_hold_all_rows_in_order():
    rng = random.Random(13)
    rows = [(i, bytes(rng.choice([0, 1, 30, 300]))) for i in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[a:a + 37]]),
                                           pa.array([t for _, t in rows[a:a + 37]], pa.binary())], ["k", "t"])
               for a in range(0, 200, 37)] + [pa.RecordBatch.from_pydict(
                   {"k": pa.array([], pa.int64()), "t": pa.array([], pa.binary())})]
    for most in (1, 100, 1000, 1 << 20):
        parts = [list(zip(*(c.to_pylist() for c in part.columns))) for part in hmm._parts(iter(batches), most)]
        assert [row for part in parts for row in part] == rows
        sizes = [[len(t) + hmm.ROW_BYTES for _, t in part] for part in parts]  # empty texts are bounded, too
        assert all(part and sum(part[:-1]) < most for part in sizes) and all(sum(part) >= most for part in sizes[:-1])


def test_counts_of_long_and_unlike_texts(small, monkeypatch):
    """Against forward and backward probabilities of one text at a time, in doubles, each scaled anew."""
    rng = np.random.default_rng(9)
    lengths = [0, 0, 1, 2, 15, 16, 17, 18, 40, 700, 701, 9000]
    texts = [np.append(rng.integers(0, 50, n), hmm.END).astype(hmm.CODE) for n in lengths]
    times = rng.integers(1, 2000, len(texts))
    start, move, emit = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((hmm.ALL, hmm.STATES))
    for text, n in zip(texts, times):
        ahead = [small.start * small.emit[text[0]]]
        for symbol in text[1:]:
            ahead.append(ahead[-1] / ahead[-1].sum() @ small.move * small.emit[symbol])
        rest = np.ones(hmm.STATES)
        for step in range(len(text) - 1, -1, -1):
            states = ahead[step] * rest / (ahead[step] @ rest)
            emit[text[step]] += n * states
            if step:
                here = rest * small.emit[text[step]]
                pairs = ahead[step - 1][:, None] * small.move * here
                move += n * pairs / pairs.sum()
                rest = small.move @ here
                rest /= rest.sum()
        start += n * states
    for part in (hmm.PART_TOKENS, 40, 1):
        monkeypatch.setattr(hmm, "PART_TOKENS", part)
        got = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((hmm.ALL, hmm.STATES))
        hmm.expected_counts(small, texts, *got, times)
        assert all(np.allclose(a, b, rtol=1e-5, atol=1e-4) for a, b in zip(got, (start, move, emit)))


def test_likelihood_of_long_and_unlike_texts(small):
    rng = np.random.default_rng(10)
    texts = [np.append(rng.integers(0, 50, n), hmm.END).astype(np.int32) for n in (0, 1, 7, 8, 9, 9, 500, 3000)]
    for text, got in zip(texts, hmm.log10_likelihood(small, texts)):
        state, expected = small.start * small.emit[text[0]], 0.0
        for symbol in text[1:]:
            expected += math.log10(state.sum())
            state = state / state.sum() @ small.move * small.emit[symbol]
        assert got == pytest.approx(expected + math.log10(state.sum()))


def test_scores_and_counts(spark, monkeypatch):
    monkeypatch.setattr(hmm, "KNOWN", 30)
    monkeypatch.setattr(hmm, "COUNTED", 50)
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(60), 300)) for i in range(300)] + odd_rows()
    docs = clashing(documents(spark, rows))
    trained = hmm.train(docs.where(~hmm.held_out()))
    learnt = [tuple(r) for r in docs.where(~hmm.held_out()).select("doc_id", "text").collect()]
    counts = Counter(w for _, t in learnt for w in (t or "").encode().lower().split())
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    expected = []
    for k, t in rows:
        words = (t or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(learnt) + 1) / (n + v + 1))
        expected.append((str(k), len(words) + 1, 1 + sum(w in counts for w in words), n, round(base, 6)))
    got = [(str(r["key"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
           for r in hmm.score(docs, trained).collect()]
    assert sorted(got) == sorted(expected)
    assert all(r["score"] < 0 for r in hmm.score(docs, trained).collect())


def test_emissions_of_words_add_up_to_one(spark):
    """Symbols of their own, and inside an ending all its words and one unseen word."""
    rng = random.Random(2)
    docs = documents(spark, [(i, prose(rng, 30, 3000)) for i in range(100)])
    counts = hmm.count_words(docs)
    lexicon = hmm.make_lexicon(counts, 100)
    assert lexicon.shares.sum() == pytest.approx(1)
    inside = Counter()
    own = set(lexicon.words[:hmm.SYMBOLS])
    for row in counts.collect():
        if bytes(row["word"]) not in own:
            inside[hmm.ending(bytes(row["word"]))] += row["n"] + 1
    for ending in range(hmm.ENDINGS):
        assert (inside[ending] + 1) / 10 ** lexicon.endings[ending] == pytest.approx(1)


def test_training_raises_the_likelihood(spark):
    """Two kinds of texts with words of their own: states tell them apart, single counts cannot."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.randrange(200)}" for _ in range(40))) for i in range(400)]
    docs = documents(spark, rows)
    scored = hmm.score(docs, hmm.train(docs.where(~hmm.held_out()))).where(hmm.held_out("key"))
    base, score = scored.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base + 0.1 * abs(base)


def test_nothing_to_learn_from(spark):
    none = documents(spark, [])
    trained = hmm.train(none)
    assert hmm.score(none, trained).count() == 0
    row = hmm.score(documents(spark, [(1, "new words")]), trained).first()
    assert row["n_known"] == 0 and row["train_tokens"] == 0 and row["score"] < 0 and row["base_score"] == 0
