"""Language-model scores by a hidden Markov model.

Training counts every word of the corpus. The commonest words are symbols of their own; all others
share a symbol with the words of their ending, inside which they weigh count + 1, unseen ones 1. So
every text has a probability. The hidden states' transitions and emissions are fitted by Baum-Welch,
from random expected counts and over all texts in every round: each task runs the forward-backward
recursion over its sequences of symbols, equal ones once and weighted by how often they occur, and gives
expected counts by symbol, Spark adds them up, and the next round starts from the sums. Scores come from the scaled forward recursion,
which gives the exact likelihood of a whole text.

Tables that go to the tasks have fixed bounds (`KNOWN` words of up to `LONGEST` bytes; `SYMBOLS` +
`ENDINGS` + 1 symbols); counts of all other words are joined to the texts that have them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstats.llm.common import cut, kept, release, whole

STATES = 8
SYMBOLS = 1 << 15
ENDINGS = 1 << 11
END = SYMBOLS + ENDINGS
ALL = END + 1
KNOWN = 1 << 17
LONGEST = 64
COUNTED = 1 << 24  # bytes of texts whose words are counted together
CODE = np.dtype(np.min_scalar_type(END)).newbyteorder("<")  # of stored symbols
ROUNDS = 14
SCALED = 2  # steps after which states are scaled; none shrinks below its least move in a step
LIKELIHOOD_SCALED = 8  # likewise for likelihoods, in double precision
TASK_TOKENS = 1 << 24  # of a task in a round, at least; many, as there are few long texts of like length
RELEASED = 4  # rounds after which shuffle files are let go
PRIOR = 20.0  # tokens of the whole corpus' mix that each state is given
BLOCK_TOKENS, BLOCK_TEXTS, MOST_TOKENS = 1 << 18, 4096, 3 << 20  # see _blocks
PART_TOKENS = 1 << 16  # of steps whose counts are added up together
EVENED = 16  # steps after which what is expected of a text is made to add up again
READ_BYTES = 1 << 24  # of texts that are read, and put together by length, at once
ROW_BYTES = 32  # that a row counts for besides its text, which may be empty
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def endings(words: pa.Array) -> np.ndarray:
    """Numbers of the classes of words without symbols: their last letters and whether signs follow them."""
    words = words.cast(pa.binary())
    bare = pc.ascii_rtrim(words.view(pa.string()), characters=SIGNS).view(pa.binary())
    signs = pc.binary_length(bare).to_numpy() != pc.binary_length(words).to_numpy()
    last = pc.binary_slice(bare, -3).dictionary_encode()
    numbers = np.array([[zlib.crc32(letters, follow) % ENDINGS for follow in (0, 1)]
                        for letters in last.dictionary.to_pylist()], np.int64).reshape(-1, 2)
    return numbers[last.indices.to_numpy(), signs.astype(np.intp)]


def ending(word: bytes) -> int:
    return int(endings(pa.array([word], pa.binary()))[0])


def held_out(key: str = "doc_id") -> Column:
    """Rows that the model does not learn from; a row without key is not one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


# Counts of words


def _texts(docs: DataFrame, text: str, *others: Column) -> DataFrame:
    return docs.select(*others, whole(text).cast("binary").alias("text"))


def _parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows, as many at once as have about `most` bytes; the text is the last column."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy()
        ends = np.cumsum(sizes.astype(np.int64) + ROW_BYTES)
        start = 0
        while start < len(ends):
            before = int(ends[start - 1]) if start else 0
            stop = min(int(np.searchsorted(ends, before + most - size)) + 1, len(ends))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= most:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z lower-cased, and where each text's begin among them, and their number."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words = parts.values.view(pa.binary())
    some = pc.binary_length(words).to_numpy() > 0  # space at either end of a text leaves an empty word there
    if some.all():
        return words, parts.offsets.to_numpy().astype(np.int64)
    before = np.concatenate([[0], np.cumsum(some)])
    return words.filter(pa.array(some)), before[parts.offsets.to_numpy()]


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n: counts of all lower-cased words, added up in each task before they are shuffled."""
    def run(batches):
        for part in _parts(batches, COUNTED):
            counted = split_words(part.column(0))[0].value_counts()
            yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["word", "n"])

    return _texts(docs, text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What tasks need of the counts: the commonest words by count, log10(count + 1) of each, log10 of
    the weight of each ending, and the share of each symbol of all tokens."""
    words: list[bytes]
    weights: np.ndarray
    endings: np.ndarray
    shares: np.ndarray
    total: int
    distinct: int
    texts: int

    def fields(self) -> tuple:
        return (self.words, self.weights, self.endings, self.shares, self.total, self.distinct, self.texts)


def make_lexicon(counts: DataFrame, texts: int) -> Lexicon:
    """`counts`: word, n; `texts`: how many texts they come from, which is how often the end occurs."""
    # Counts by steps of about 1 %, so that whole steps make up at most KNOWN words.
    step = F.floor(F.log2(F.col("n").cast("double")) * 64)
    short = counts.where(F.octet_length("word") <= LONGEST).withColumn("step", step)
    steps = sorted(((row[0], row[1]) for row in short.groupBy("step").count().collect()), reverse=True)
    fit = np.searchsorted(np.cumsum([words for _, words in steps]), KNOWN, "right")
    least = steps[fit - 1][0] if fit else np.inf
    known = short.where(F.col("step") >= F.lit(float(least))).select("word", "n").collect()
    known.sort(key=lambda row: (-row["n"], row["word"]))
    words, n = [bytes(row["word"]) for row in known], np.array([row["n"] for row in known], np.float64)

    def run(batches):
        for batch in batches:
            classes = pa.array(endings(batch.column(0)), pa.int64())
            yield pa.RecordBatch.from_arrays([classes, batch.column(1)], ["ending", "n"])

    sums = (counts.mapInArrow(run, "ending long, n long").groupBy("ending")
            .agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words")).collect())  # ENDINGS rows
    tokens, distinct = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for row in sums:
        tokens[row["ending"]], distinct[row["ending"]] = row["tokens"], row["words"]
    total, types = int(tokens.sum()) + texts, int(distinct.sum()) + (texts > 0)
    own = endings(pa.array(words[:SYMBOLS], pa.binary()))
    tokens -= np.bincount(own, n[:SYMBOLS], minlength=ENDINGS)
    distinct -= np.bincount(own, minlength=ENDINGS)
    seen = np.concatenate([n[:SYMBOLS], np.zeros(SYMBOLS - len(n[:SYMBOLS])), tokens, [texts]]) + 0.5
    seen[len(n[:SYMBOLS]):SYMBOLS] = 0
    return Lexicon(words, np.log10(n + 1), np.log10(tokens + distinct + 1), seen / seen.sum(), total, types, texts)


@dataclass
class Read:
    """Texts as read: all words one after another, their places among the known ones or -1, the symbols
    with an end after each text, and where each text begins among the words and among the symbols."""
    words: pa.Array
    places: np.ndarray
    symbols: np.ndarray
    word_at: np.ndarray
    at: np.ndarray

    def texts(self) -> list[np.ndarray]:
        return [self.symbols[start:stop] for start, stop in zip(self.at.tolist(), self.at[1:].tolist())]


class Reader:
    """Texts as symbols."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known = pa.array(lexicon.words, pa.binary())
        places = np.arange(max(len(lexicon.words), 1))
        self.symbol = places.astype(CODE)
        self.symbol[SYMBOLS:] = SYMBOLS + endings(self.known[SYMBOLS:])

    def read(self, texts: pa.Array) -> Read:
        words, word_at = split_words(texts)
        places = pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy()
        own = self.symbol.take(np.maximum(places, 0))
        unknown = places < 0
        own[unknown] = SYMBOLS + endings(words.filter(pa.array(unknown)))
        at = word_at + np.arange(len(word_at))
        symbols, inner = np.full(at[-1], END, CODE), np.ones(at[-1], bool)
        inner[at[1:] - 1] = False
        symbols[inner] = own
        return Read(words, places, symbols, word_at, at)

    def __call__(self, text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words of one text, their places, and the symbols of the text, its end included."""
        read = self.read(pa.array([text], pa.binary()))
        return read.words.to_pylist(), read.places, read.symbols


def reader_of(fields: tuple) -> Reader:
    """The reader of a lexicon, kept for all tasks of a process that need the same one."""
    words, weights, *_ = fields
    name = f"reader_{xxhash.xxh3_64_intdigest(weights.tobytes() + b' '.join(words)):x}"
    return kept(name, lambda: Reader(Lexicon(*fields)))


# The model


@dataclass
class Model:
    """Probabilities: first state, next state by state, symbol (ALL x STATES)."""
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def from_counts(start: np.ndarray, move: np.ndarray, emit: np.ndarray, shares: np.ndarray) -> Model:
    """The model that expected counts give, each state with a little of the whole corpus' mix."""
    emit = emit + PRIOR * shares[:, None]
    move, start = move + 0.1, start + 0.1
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _blocks(texts: list[np.ndarray], tokens: int = BLOCK_TOKENS, rows: int = BLOCK_TEXTS,
            most: int = MOST_TOKENS) -> Iterator[np.ndarray]:
    """Places of texts of like length, longest first, that make up a block together: about `tokens` of
    short texts, but `rows` texts at least, as a step of a few texts costs as much as one of many, and
    `most` tokens at most."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    start = 0
    while start < len(order):
        length = len(texts[order[start]])
        chosen = max(1, min(max(tokens // length, rows), most // length))
        yield order[start:start + chosen]
        start += chosen


def _steps(texts: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """Symbols of a block step after step, those of texts that have ended left out; how many texts are as
    long as each step; and where each step begins."""
    lengths = np.array([len(texts[i]) for i in chosen])
    grid = np.full((len(chosen), lengths[0]), END, CODE)
    for row, i in enumerate(chosen):
        grid[row, :lengths[row]] = texts[i]
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    symbols = grid.T[np.arange(len(chosen)) < alive[:, None]].astype(np.intp)
    return symbols, alive.tolist(), [0, *np.cumsum(alive).tolist()]


def log10_likelihood(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the exact probability of each text, by the scaled forward recursion."""
    out = np.zeros(len(texts))
    for chosen in _blocks(texts, BLOCK_TOKENS // 2, BLOCK_TEXTS // 4):  # of doubles, fewer stay in the cache
        symbols, alive, at = _steps(texts, chosen)
        state, scores = np.repeat(model.start[None], len(chosen), axis=0), np.zeros(len(chosen))
        for step, (m, left) in enumerate(zip(alive, [*alive[1:], 0])):
            if step:
                state = state[:m] @ model.move
            state *= model.emit.take(symbols[at[step]:at[step + 1]], axis=0)
            if left < m:
                scores[left:m] += np.log10(state[left:].sum(axis=1))
            if step % LIKELIHOOD_SCALED == 0:  # doubles hold several steps
                scale = state[:left].sum(axis=1)
                state[:left] /= scale[:, None]
                scores[:left] += np.log10(scale)
        out[chosen] = scores
    return out


def expected_counts(model: Model, texts: list[np.ndarray], start, move, emit, times: np.ndarray | None = None) -> None:
    """Adds the expected counts of first states, moves and emissions of the texts, each text `times` over.

    Emissions go relative to the likeliest state's, which leaves the states' probabilities as they are.
    A row is the states of a token. On the way back, how often each state is expected is shared out among
    the states before it, by how much of it comes from each; so neither emissions nor scales are needed
    again, and sums stay as they are but for rounding. Rows hold single precision."""
    most = model.emit.max(axis=1, keepdims=True)
    relative = np.divide(model.emit, most, out=np.zeros_like(model.emit), where=most > 0).astype(np.float32)
    onward, back, first = (np.ascontiguousarray(x, np.float32) for x in (model.move, model.move.T, model.start))
    added = np.ones((STATES, STATES), np.float32)  # a product with it has a row's sum in every place
    moved, emitted = np.zeros((STATES, STATES)), np.zeros((STATES, len(emit)))
    room, part_room = np.empty((0, STATES), np.float32), np.empty((2, 0, STATES), np.float32)  # used again
    for chosen in _blocks(texts):
        symbols, alive, at = _steps(texts, chosen)
        steps, n = len(alive), len(chosen)
        weight = (np.ones(n) if times is None else times[chosen]).astype(np.float32)[:, None]
        if len(room) < at[-1]:
            room = np.empty((at[-1], STATES), np.float32)
        coming = np.empty((n, STATES), np.float32)  # the states of a step before its symbols are known
        parts = [range(low, min(low + max(1, PART_TOKENS // n), steps))
                 for low in range(0, steps, max(1, PART_TOKENS // n))]
        for part in parts:
            low, high = at[part.start], at[part.stop]
            np.take(relative, symbols[low:high], axis=0, out=room[low:high], mode="clip")
            for step in part:
                m, state = alive[step], room[at[step]:at[step + 1]]
                state *= np.matmul(before[:m], onward, out=coming[:m]) if step else first
                if step % SCALED == 0:
                    state /= np.matmul(state, added, out=coming[:m])
                before = state
        left = 0  # texts that go on after the step, and `later`, how often their next states are expected
        for part in reversed(parts):
            low, high = at[part.start], at[part.stop]
            if left:
                later = later.copy()  # as its place is used again
            if part_room.shape[1] < high - low:
                part_room = np.empty((2, high - low, STATES), np.float32)
            expected, follows = part_room[:, :high - low]
            for step in reversed(part):
                m, state = alive[step], room[at[step]:at[step + 1]]
                now, follow = (x[at[step] - low:at[step + 1] - low] for x in (expected, follows))
                if left:
                    np.matmul(state[:left], onward, out=coming[:left])
                    np.divide(later, coming[:left], out=follow[:left])
                    np.matmul(follow[:left], back, out=now[:left])
                    now[:left] *= state[:left]
                    if step % EVENED == 0:
                        now[:left] *= weight[:left] / np.matmul(now[:left], added, out=coming[:left])
                if left < m:  # where the text ends
                    follow[left:] = 0
                    now[left:] = state[left:] * (weight[left:m] / state[left:].sum(axis=1, keepdims=True))
                later, left = now, m
            moved += room[low:high].T @ follows
            for k in range(STATES):
                emitted[k] += np.bincount(symbols[low:high], expected[:, k], minlength=len(emit))
        start += later.sum(axis=0, dtype=np.float64)
    move += model.move * moved
    emit += emitted.T


def starting_model(shares: np.ndarray, seed: int = 11) -> Model:
    """A model from random expected counts, which the corpus then trains."""
    random = np.random.default_rng(seed)
    emit = shares[:, None] * random.uniform(0.2, 1.8, (ALL, STATES)) * 100
    move = np.eye(STATES) * 10 + random.uniform(0.5, 1.5, (STATES, STATES))
    return from_counts(np.ones(STATES), move, emit, shares)


def _groups(symbols: Iterator, most: int) -> Iterator[list]:
    """Items (with symbols last) in groups of about so many tokens."""
    held, size = [], 0
    for item in symbols:
        held.append(item)
        size += len(item[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def sequences(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """symbols, times: the texts of `docs` as symbols, equal ones once and how many they are."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon.fields())

    def run(batches):
        reader = reader_of(sent.value)
        for part in _parts(batches, READ_BYTES):
            read = reader.read(part.column(0))
            ends = (read.at * CODE.itemsize).astype(np.int32)
            coded = pa.Array.from_buffers(pa.binary(), len(part), [None, *map(pa.py_buffer, (ends, read.symbols))])
            yield pa.RecordBatch.from_arrays([coded], ["symbols"])

    return _texts(docs, text).mapInArrow(run, "symbols binary").groupBy("symbols").agg(
        F.count(F.lit(1)).alias("times"))


def baum_welch(texts: DataFrame, lexicon: Lexicon, model: Model) -> Model:
    """One round over all `sequences` of the training texts."""
    context = texts.sparkSession.sparkContext
    sent = context.broadcast((model.start, model.move, model.emit))

    def run(batches):
        model = Model(*sent.value)
        start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((ALL, STATES))
        read = ((times.as_py(), np.frombuffer(symbols.as_py(), CODE))
                for batch in batches for symbols, times in zip(*batch.columns))
        for group in _groups(read, 2 * TASK_TOKENS):
            times, symbols = zip(*group)
            expected_counts(model, symbols, start, move, emit, np.array(times))
        used = np.flatnonzero(emit.any(axis=1))
        rows = np.concatenate([used, -1 - np.arange(STATES), [-1 - STATES]])
        counts = np.concatenate([emit[used], move, [start]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), *(pa.array(counts[:, k]) for k in range(STATES))], ["of", *names])

    names = [f"s{k}" for k in range(STATES)]
    tasks = max(context.defaultParallelism, lexicon.total // TASK_TOKENS)
    counted = texts.coalesce(tasks).mapInArrow(run, "of long, " + ", ".join(f"{name} double" for name in names))
    summed = counted.groupBy("of").agg(*[F.sum(name).alias(name) for name in names]).collect()  # by symbol
    start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((ALL, STATES))
    for row in summed:
        of, values = row[0], np.array(row[1:])
        if of >= 0:
            emit[of] = values
        elif of == -1 - STATES:
            start = values
        else:
            move[-1 - of] = values
    return from_counts(start, move, emit, lexicon.shares)


@dataclass
class Trained:
    """A trained model with its lexicon and the counts of all words (word, n)."""
    lexicon: Lexicon
    model: Model
    counts: DataFrame


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, seed: int = 11) -> Trained:
    """Trains on all rows of `docs`; a null text is empty and teaches that texts may end at once.

    Every round reads all texts whole. An empty table gives a model that knows no word."""
    texts = _texts(docs, text)
    counts = cut(count_words(texts))
    lexicon = make_lexicon(counts, docs.count())
    model = starting_model(lexicon.shares, seed)
    coded = cut(sequences(texts, lexicon)) if lexicon.total else None
    for done in range(rounds if lexicon.total else 0):
        if done % RELEASED == 0:
            release(docs.sparkSession)
        model = baum_welch(coded, lexicon, model)
    return Trained(lexicon, model, counts)


# Scores


def score(docs: DataFrame, trained: Trained, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, n_tokens (words and the end), n_known (of them seen in training),
    train_tokens, base_score (log10 probability under add-one counts), score (log10 probability under
    the model). A null text is empty, that is, an end alone. Null and repeated keys are rows like
    others. Other columns are not read. An empty table gives an empty table."""
    lexicon, model = trained.lexicon, trained.model
    sent = docs.sparkSession.sparkContext.broadcast((lexicon.fields(), (model.start, model.move, model.emit)))
    ends = float(np.log10(lexicon.texts + 1))

    def run(batches):
        reader, model = reader_of(sent.value[0]), Model(*sent.value[1])
        weights, inside = np.append(reader.lexicon.weights, 0.0), reader.lexicon.endings

        for part in _parts(batches, READ_BYTES):
            read = reader.read(part.column(1))
            likelihoods = log10_likelihood(model, read.texts())
            known, own = read.places >= 0, np.delete(read.symbols, read.at[1:] - 1)
            row = np.repeat(np.arange(len(part)), np.diff(read.word_at))

            def sums(values, which=slice(None)):
                return np.bincount(row[which], values, len(part))

            weight = weights.take(read.places)  # 0 for words that are not known
            shared = np.flatnonzero(own >= SYMBOLS)
            likelihoods += sums(weight[shared] - inside.take(own[shared] - SYMBOLS), shared)
            rare = read.words.filter(pa.array(~known)).dictionary_encode()
            pairs, times = np.unique(row[~known] * len(rare.dictionary) + rare.indices.to_numpy(), return_counts=True)
            of, word = np.divmod(pairs, max(len(rare.dictionary), 1))
            listed = pa.StructArray.from_arrays([rare.dictionary.take(pa.array(word)), pa.array(times)], ["word", "times"])
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(np.diff(read.at), pa.int64()),
                pa.array(np.bincount(row[known], minlength=len(part)), pa.int64()),
                pa.array(sums(weight)), pa.array(likelihoods), pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of, np.arange(len(part) + 1)), pa.int32()), listed)], NAMES)

    NAMES = ["key", "n_tokens", "known", "base", "inside", "rare"]
    part = cut(_texts(docs, text, F.col(key).cast("long").alias("key")).mapInArrow(
        run, "key long, n_tokens long, known long, base double, inside double, "
        "rare array<struct<word: binary, times: long>>").withColumn("row", F.monotonically_increasing_id()))
    rare = part.select("row", F.explode("rare").alias("one")).select(
        "row", F.col("one.word").alias("word"), F.col("one.times").alias("times"))
    seen = rare.join(trained.counts, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("added"))
    n, v = lexicon.total, lexicon.distinct
    known, added = F.col("known") + F.coalesce("more", F.lit(0)), F.coalesce("added", F.lit(0.0))
    return part.drop("rare").join(seen, "row", "left").select(
        "key", "n_tokens", (known + (1 if n else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + added + F.lit(ends) - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1))))
        .alias("base_score"), (F.col("inside") + added).alias("score"))
