"""Conversations formatted for training by a compiled template (see `template`), and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from viewstats.llm.template import Template

# Control strings of the format.
START, END = "<|im_start|>", "<|im_end|>"
TURN_TEMPLATE = (
    "{{ '<|im_start|>' ~ (turn.role | header) ~ '\\n' }}"
    "{% if turn.role == 'assistant' %}"
    "{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}")
CHAT = "{% for turn in turns %}" + TURN_TEMPLATE + "{% endfor %}"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
ROWS_HELD, CHARS_HELD = 256, 1 << 20
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SCHEMA = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", SPANS)])
PIECES = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("formatted", pa.string()), ("loss", SPANS)])
DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
SPANS_DDL = "loss array<struct<start: long, end: long>>"


def escape(text: str | None) -> str:
    """Puts a backslash into every `<|`, and one more into every `<\\|`, so that no control string can
    be in a text; other text, backslashes included, is as it was."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text or "")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def header(role: str | None) -> str:
    """A role on one line."""
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unheader(line: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line))


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    at = 0
    for turn in TURN.finditer(formatted):
        if turn.start() != at:
            raise ValueError(f"no turn at {at}")
        at = turn.end()
        yield unheader(turn[1]), unescape(turn[2])
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")


def loss_texts(formatted: str, spans: list) -> Iterator[str]:
    """The texts under the loss mask, unescaped."""
    for start, end in spans:
        yield unescape(formatted[start:end])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, text: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most `ROWS_HELD` rows, or of about `CHARS_HELD` characters of the field `text`."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[text])
        if len(held) >= ROWS_HELD or chars > CHARS_HELD:
            yield _packed(held, schema)
            held, chars = [], 0
    if held:
        yield _packed(held, schema)


def _packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def _in_order(turns: DataFrame) -> DataFrame:
    """conv_id, role and text, the rows of a conversation one after another."""
    return (turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text"))


def _compiled(template: str) -> Template:
    return Template(template, {"escape": escape, "header": header})


def _spans(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in spans]


def format_conversations(turns: DataFrame, template: str = CHAT) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text) rows: conv_id, formatted, loss (spans of
    `formatted` in code points that the template puts in generation blocks, in order). The template is
    given all `turns`.

    Turns come in order of turn, a null turn first; rows with equal turns in order of role and text.
    A null conv_id is a conversation of its own, a null role or text is empty. A conversation is one
    value of the result, so its turns are in one task's memory; no other grouping is held, and
    `format_turns` holds none. Other columns are not read. An empty table gives an empty table.
    """
    def run(batches):
        compiled = _compiled(template)

        def formatted():
            for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
                text, spans = compiled.render({"turns": [{"role": role, "text": said} for _, role, said in rows]})
                yield conv_id, text, _spans(spans)

        yield from _batched(formatted(), SCHEMA, 1)

    return _in_order(turns).mapInArrow(run, f"conv_id long, formatted string, {SPANS_DDL}")


def format_turns(turns: DataFrame, template: str = TURN_TEMPLATE) -> DataFrame:
    """One row per turn, the turns of a conversation one after another in one partition: conv_id, place
    (from 0), formatted, loss (spans of this row's `formatted`). The template is given the `turn` and
    whether it is the `first`; the conversation is its rows' `formatted` joined.

    Order, nulls, other columns and empty tables are as in `format_conversations`. Turns are streamed
    through the task in order and none is held, so a conversation may be of any length.
    """
    def run(batches):
        compiled = _compiled(template)

        def formatted():
            for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
                for place, (_, role, said) in enumerate(rows):
                    text, spans = compiled.render({"turn": {"role": role, "text": said}, "first": place == 0})
                    yield conv_id, place, text, _spans(spans)

        yield from _batched(formatted(), PIECES, 2)

    return _in_order(turns).mapInArrow(run, f"conv_id long, place long, formatted string, {SPANS_DDL}")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what formatted conversations hold: conv_id, n_turns, turns_sha256 (role, newline,
    text, newline per turn), loss_chars, loss_sha256, formatted_chars. `formatted`: rows of
    `format_conversations`, or of `format_turns` as it gives them; pieces that come in another order are
    an error. Digests are taken piece by piece, so no conversation is held."""
    pieces = "place" in formatted.columns

    def digests(batches):
        rows = (row if pieces else (row[0], 0, *row[1:]) for row in _rows(batches))
        for conv_id, of in groupby(rows, key=lambda row: row[0]):
            n = loss_chars = chars = 0
            all_turns, loss = hashlib.sha256(), hashlib.sha256()
            for at, (_, place, text, spans) in enumerate(of):
                if place != at:
                    raise ValueError(f"piece {place} of conversation {conv_id} where {at} should be")
                chars += len(text)
                for role, said in read_turns(text):
                    n += 1
                    all_turns.update(f"{role}\n{said}\n".encode())
                for said in loss_texts(text, [(span["start"], span["end"]) for span in spans]):
                    loss_chars += len(said)
                    loss.update(said.encode())
            yield conv_id, n, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def run(batches):
        yield from _batched(digests(batches), DIGESTS, 2)

    names = ["conv_id", "place", "formatted", "loss"] if pieces else ["conv_id", "formatted", "loss"]
    return formatted.select(*names).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")
