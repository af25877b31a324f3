"""Structure repair of conversations by Knuth's lightest-derivation agenda.

A repaired conversation is an optional system turn and pairs of a user and an assistant turn. An item
(row, state) stands for "the rows from here on can be repaired, coming from this state", and weighs the
cost and the edits' letters (the audit) of its lightest derivation. Axioms are the states after the last
row. A rule adds one edit before an item: keep, rerole and delete also step one row back, insert only one
state back. The agenda pops items by (cost, rows done, audit). Every rule raises that weight and keeps the
order of two derivations of one item, as it puts the same letter before both, so an item is final when it
is popped, and the search ends with the goal.

A conversation can be most of the table. So rows are sorted over all partitions, and a *piece* is a run of
rows of one conversation: a piece gives the lightest derivation from every state before it to every state
after it, and the pieces of a conversation are joined from the last one back by rules with two premises,
a piece's item and the item of what follows. Rows that are alike in all columns are counted, not listed.
Only the digest of the repaired texts needs a whole conversation in one task, row by row: it is one SHA-256.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from viewstats.llm.common import cut

PIECE = 512  # rows
PIECE_CHARS = 1 << 22
SPACE = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1  # added to keeping or reroling a truncated row
SOUND, CUT_OFF, LOST = 0, 1, 2  # faults: none, truncated, blank or duplicate (must be deleted)

START, ASKING, ANSWERING, DONE = range(4)  # nothing yet, after a system, user, assistant turn
STATES, ENDS = range(4), (START, DONE)
STEPS = {START: {"s": ASKING, "u": ANSWERING}, ASKING: {"u": ANSWERING}, ANSWERING: {"a": DONE},
         DONE: {"u": ANSWERING}}
NAMES = {"u": "user", "a": "assistant"}
# Where a state comes from by an added or reroled turn, and by a kept one of that initial.
MADE = {to: [s for s in STATES for letter, t in STEPS[s].items() if t == to and letter in NAMES] for to in STATES}
KEPT = {(letter, to): [s for s in STATES if STEPS[s].get(letter) == to] for to in STATES for letter in "sua"}

Weight = tuple[int, str]


def made_role(state: int) -> str:
    """The role of a turn that is added or reroled in a state."""
    return NAMES["a" if state == ANSWERING else "u"]


def lightest(rows: list[tuple[str, int, int]], ends=ENDS, goal: int | None = START) -> dict[int, Weight]:
    """Lightest (cost, audit) of repairing rows of (role initial, fault, copies) so that one of the states
    `ends` follows, by the state before them; of `goal` alone if it is given. Copies are deleted after
    the first, which keeps the least audit, as deletions sort before insertions."""
    agenda = [(0, 0, "", len(rows), end) for end in ends]
    heapq.heapify(agenda)
    final: set[tuple[int, int]] = set()
    result: dict[int, Weight] = {}
    while agenda:
        cost, done, audit, row, state = heapq.heappop(agenda)
        if (row, state) in final:
            continue
        final.add((row, state))
        if row == 0:
            result[state] = cost, audit
            if state == goal or len(result) == len(STATES):
                break
        for before in MADE[state]:
            if (row, before) not in final:
                heapq.heappush(agenda, (cost + INSERT, done, "I" + audit, row, before))
        if row == 0:
            continue
        initial, fault, copies = rows[row - 1]
        rest = "D" * (copies - 1) + audit if copies > 1 else audit
        cost += DELETE * (copies - 1)
        heapq.heappush(agenda, (cost + DELETE, done + 1, "D" + rest, row - 1, state))
        if fault == LOST:
            continue
        cost += TRUNCATED * fault
        for before in KEPT.get((initial, state), ()):
            heapq.heappush(agenda, (cost + KEEP, done + 1, "K" + rest, row - 1, before))
        for before in MADE[state]:
            heapq.heappush(agenda, (cost + REROLE, done + 1, "R" + rest, row - 1, before))
    return result


def joined(piece: dict[tuple[int, int], Weight], rest: dict[int, Weight]) -> dict[int, Weight]:
    """Lightest weights of a piece and what follows it, by the state before the piece. `piece` has the
    weights by state before and after."""
    best: dict[int, Weight] = {}
    for (before, after), (cost, audit) in piece.items():
        if after in rest:
            weight = cost + rest[after][0], audit + rest[after][1]
            best[before] = min(best.get(before, weight), weight)
    return best


@dataclass
class Piece:
    """Rows of one conversation that follow one another, and what is counted of them."""

    conv: int | None
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0  # distinct ones
    low: int | None = None
    high: int | None = None
    chars: int = 0
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    copies: list[int] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        bare = text.strip(SPACE)
        fault = LOST if seen or not bare else CUT_OFF if bare[-1] not in ".!?" else SOUND
        if not bare:
            self.blank += copies
        else:
            self.duplicate += copies - 1 + seen
            self.truncated += fault == CUT_OFF
        self.illegal += copies - 1 + (bool(self.roles) and not legal(self.roles[-1], role))
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.chars += len(text)
        for column, value in ((self.roles, role), (self.texts, text), (self.copies, copies), (self.faults, fault)):
            column.append(value)

    def rows(self) -> list[tuple[str, int, int]]:
        return [*zip((r[:1] for r in self.roles), self.faults, self.copies)]

    def row(self, part: int, at: int, alone: bool) -> dict:
        weights = [(START, DONE, *lightest(self.rows())[START])] if alone else [
            (before, end, *weight) for end in STATES
            for before, weight in lightest(self.rows(), [end], None).items()]
        return {"conv_id": self.conv, "part": part, "at": at, "first_role": self.roles[0], "last_role": self.roles[-1],
                "weights": [dict(zip(("before", "after", "cost", "audit"), w)) for w in weights]} | {
            name: getattr(self, name) for name in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high",
                                                   "roles", "texts", "copies", "faults")}


def legal(first: str, second: str) -> bool:
    """Whether the second role may follow the first."""
    return first[:1] + second[:1] in ("su", "ua", "au")


COUNTED = ["blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
PIECES = ("conv_id long, part long, at long, first_role string, last_role string, "
          "weights array<struct<before: int, after: int, cost: long, audit: string>>, "
          + ", ".join(f"{name} long" for name in COUNTED)
          + ", roles array<string>, texts array<string>, copies array<long>, faults array<int>")
REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _pieces(rows: DataFrame, parts: int, most: int) -> DataFrame:
    shape = _arrow(PIECES)

    def cut_into_pieces(batches):
        part, at, piece, piece_first, out, size = TaskContext.get().partitionId(), 0, None, True, [], 0

        def take(alone):
            nonlocal at, size
            out.append(piece.row(part, at, alone))
            at, size = at + 1, size + piece.chars

        for batch in batches:
            for conv, turn, role, text, copies, seen in zip(*(column.to_pylist() for column in batch.columns)):
                if piece is not None and piece.conv != conv:
                    # A partition's first and last conversations may go on in the next one.
                    take(piece_first and at > 0)
                    piece, piece_first = None, True
                elif piece is not None and (len(piece.roles) >= most or piece.chars >= PIECE_CHARS):
                    take(False)
                    piece, piece_first = None, False
                if size >= PIECE_CHARS or len(out) >= PIECE:
                    yield pa.RecordBatch.from_pylist(out, schema=shape)
                    out.clear()
                    size = 0
                if piece is None:
                    piece = Piece(conv)
                piece.add(turn, role, text, copies, seen)
        if piece is not None:
            take(False)
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    order = ["conv_id", "turn", "role"]
    return cut(rows.repartitionByRange(parts, *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
               .select(*order, "text", "copies", "seen").mapInArrow(cut_into_pieces, PIECES))


class _Conversation:
    """Pieces from the last to the first, then their rows from the first to the last."""

    def __init__(self, conv: int | None):
        self.conv, self.counts = conv, dict.fromkeys(COUNTED[:5], 0)
        self.low = self.high = self.next_role = self.next_low = None
        self.rest: dict[int, Weight] = dict.fromkeys(ENDS, (0, ""))
        self.digest, self.state, self.letter, self.written = hashlib.sha256(), START, 0, False

    def add_piece(self, row: dict) -> None:
        for name in self.counts:
            self.counts[name] += row[name]
        if self.next_role is not None:
            self.counts["illegal"] += not legal(row["last_role"], self.next_role)
        self.next_role = row["first_role"]
        if row["low"] is not None:
            self.counts["turns"] -= row["high"] == self.low
            self.low, self.high = row["low"], row["high"] if self.high is None else self.high
        self.rest = joined({(w["before"], w["after"]): (w["cost"], w["audit"]) for w in row["weights"]}, self.rest)

    def _say(self, letter: str, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
        self.written, self.state = True, STEPS[self.state][letter]

    def _insert(self, audit: str) -> None:
        while audit[self.letter:self.letter + 1] == "I":
            role = made_role(self.state)
            self._say(role[0], role, "")
            self.letter += 1

    def add_rows(self, row: dict) -> None:
        audit = self.rest[START][1]
        for role, text, copies in zip(row["roles"], row["texts"], row["copies"]):
            self._insert(audit)
            edit = audit[self.letter]
            if edit == "K":
                self._say(role[0], role, text)
            elif edit == "R":
                role = made_role(self.state)
                self._say(role[0], role, text)
            self.letter += copies

    def result(self) -> dict:
        cost, audit = self.rest[START]
        self._insert(audit)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.counts["turns"]
        return {"conv_id": self.conv, "gaps": gaps, "cost": cost, "audit": audit,
                "repaired_sha256": self.digest.hexdigest()} | {
            name: self.counts[name] for name in ("blank", "duplicate", "truncated", "illegal")}


def _joined(pieces: DataFrame, conversations: DataFrame) -> DataFrame:
    shape = _arrow(REPAIRED)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if held is None or held.conv != row["conv_id"]:
                    out += [held.result()] if held else []
                    held = _Conversation(row["conv_id"])
                if row["kind"] == 1:
                    held.add_piece(row)
                elif row["kind"] == 2:
                    held.add_rows(row)
            if len(out) >= PIECE:
                yield pa.RecordBatch.from_pylist(out, schema=shape)
                out = []
        out += [held.result()] if held else []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    summaries = pieces.drop("roles", "texts", "copies", "faults").withColumns(
        {"kind": F.lit(1), "first": -F.col("part"), "second": -F.col("at")})
    rows = pieces.select("conv_id", "roles", "texts", "copies", F.lit(2).alias("kind"),
                         F.col("part").alias("first"), F.col("at").alias("second"))
    named = conversations.withColumn("kind", F.lit(0))
    every = named.unionByName(summaries.drop("part", "at"), allowMissingColumns=True).unionByName(
        rows, allowMissingColumns=True)
    return (every.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "first", "second")
            .mapInArrow(run, REPAIRED))


def damage(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) damaged by the crc32 of "conv_id:turn" modulo 20: 0 drops the
    row, 1 empties its text, 2 takes its full stops, question and exclamation marks, 3 repeats it, 4 makes
    it a user's. Nulls count as one space, but a null turn stays null. Other columns are dropped."""
    def spaced(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    case = F.col("case")
    return (turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), (F.crc32(
                F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20).alias("case"))
            .where(case != 0)
            .select("conv_id", "turn", F.when(case == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(case == 1, "").when(case == 2, F.translate("text", ".!?", "")).otherwise(
                        F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(case == 3, 2).otherwise(1))))
            .drop("col"))


def repaired(turns: DataFrame, conversations: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text) rows: its faults before the repair (gaps in
    the turns; blank, duplicate and truncated rows; illegal neighbours), the cost and audit of the
    cheapest repair, the least audit among equally cheap ones, and the SHA-256 of the repaired turns
    ("role:text", joined by newlines).

    Rows come by turn, a null turn first, those of one turn by role and text. A null conv_id is a
    conversation of its own; a null role or text is empty, so a row of a null text is blank. An empty role
    has no initial, so its row is reroled or deleted. `conversations` names conversations (conv_id) that
    are reported even without rows. An empty table gives an empty table. Other columns are not read.
    """
    keys = ["conv_id", "turn", "role", "text"]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = cut(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
               .withColumn("digest", F.sha2("text", 256)))
    first = F.min(F.struct(F.col("turn").isNotNull(), "turn").alias("first")).alias("first")
    said = rows.groupBy("conv_id", "role", "digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    said = said.select(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("digest").alias("what"),
                       F.col("first.turn").alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("digest") == F.col("what"))
    rows = rows.join(said, same, "left").select(
        *keys, "copies", (F.col("what").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))).alias("seen"))
    named = turns.select(F.col("conv_id").cast("long").alias("conv_id"))
    if conversations is not None:
        named = named.unionByName(conversations.select(F.col("conv_id").cast("long").alias("conv_id")))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _joined(_pieces(rows, parts, piece), named.distinct())
