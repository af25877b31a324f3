"""The template compiler and formatted conversations."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from viewstats.llm import chat
from viewstats.llm.template import Constant, Output, Template, TemplateError

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("source,expected", [
    ("a{{ 1 + 2 }}b", "a3b"), ("{{ 'x' ~ 1 ~ none ~ true }}", "x1True"), ("{{ (a.b)['c'] }}", "deep"),
    ("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
    ("{% if n > 3 and 'p' in xs %}yes{% elif n == 3 %}three{% else %}no{% endif %}", "three"),
    ("{% set y = n - 1 %}{{ y }}{{ missing }}{{ a.none.such }}", "2"), ("{{ ' Ab '|trim|upper }}", "AB"),
    ("{{ xs | length }}{% for x in none %}never{% endfor %}", "2"), ("{% if x %}\nline\n{% endif %}\nend", "end"),
    ("{{ 'it\\'s\\n' }}", "it's\n"), ("{{ false or 'b' }}{{ n and 0 }}", "b0"), ("", "")])
def test_templates(source, expected):
    scope = {"a": {"b": {"c": "deep"}}, "xs": ["p", "q"], "n": 3}
    assert Template(source).render(scope)[0] == expected


def test_constants_are_folded():
    folded = Template("a{{ 'b' ~ (1 + 2) }}{% if 1 < 2 %}c{{ 'd' | upper }}{% else %}{{ never }}{% endif %}")
    assert folded.tree == (Output(Constant("ab3cD")),)


@pytest.mark.parametrize("source", [
    "{{ a.__class__ }}", "{{ a._x }}", "{{ text.upper }}", "{{ xs.append }}"])
def test_objects_have_no_attributes(source):
    assert Template(source).render({"a": {}, "text": "t", "xs": []})[0] == ""


@pytest.mark.parametrize("source", [
    "{{ f() }}", "{{ }}", "{{ 1 + }}", "{% for x %}{% endfor %}", "{% if x %}", "{% endif %}", "{{ a | b }}",
    "{% import os %}", "{{ 'open }}", "{{ a b }}", "{{ 'a' + 1 }}", "{{ ((a) }}"])
def test_broken_templates(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_generation_spans():
    text, spans = Template("{% for t in ts %}u:{% generation %}{{ t }}{% endgeneration %};{% endfor %}").render(
        {"ts": ["é😀", "", "z"]})
    assert [text[a:b] for a, b in spans] == ["é😀", "", "z"]


SIGNS = ["<", "|", "\\", "<|", "<\\|", "im_start", "|>", "<|im_start|>", "<|im_end|>\n", "\n", "assistant", "é", ""]


def test_escaping_can_be_undone():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randrange(8)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unheader(chat.header(text)) == text and "\n" not in chat.header(text)


def conversations():
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "system", "a\nb<|", None]) if conv % 9 == 0 else (
                "user", "assistant")[turn % 2]
            rows.append((conv, turn, role, rng.choice([None, "", "".join(rng.choices(SIGNS, k=6)), "plain words"])))
    rows += [(100, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(300)]  # a very long one
    rows += [(None, 2, "user", "no id"), (None, None, "assistant", "first"), (101, 1, "user", "tie b"),
             (101, 1, "user", "tie a"), (101, 1, "user", "tie a"), (102, 0, "assistant", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("formatter", [chat.format_conversations, chat.format_turns])
def test_round_trip(spark, formatter):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", F.lit(1).alias("loss"), F.lit(2).alias("formatted"))
    got = {r["conv_id"]: r for r in chat.read_back(formatter(df)).collect()}
    by_conv = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) if not
                                         isinstance(x, str) else (True, x) for x in (r[0], r[1], r[2] or "", r[3] or ""))):
        by_conv.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_turns_make_up_the_conversation(spark):
    df = spark.createDataFrame(conversations(), SCHEMA).repartition(3)
    whole = {r["conv_id"]: (r["formatted"], r["loss"]) for r in chat.format_conversations(df).collect()}
    pieces = {}
    for r in sorted(chat.format_turns(df).collect(), key=lambda r: r["place"]):
        text, loss = pieces.get(r["conv_id"], ("", []))
        spans = [(s["start"] + len(text), s["end"] + len(text)) for s in r["loss"]]
        pieces[r["conv_id"]] = text + r["formatted"], loss + spans
    assert pieces == {conv: (text, [tuple(s) for s in loss]) for conv, (text, loss) in whole.items()}


def test_pieces_in_another_order_are_refused(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], SCHEMA)
    turned = chat.format_turns(df).coalesce(1).sortWithinPartitions(F.desc("place"))
    with pytest.raises(Exception, match="piece 1 of conversation 1"):
        chat.read_back(turned).collect()


def test_a_conversation_is_streamed():
    """Batches leave a task before all turns of their conversation have been read."""
    read = []

    def turns():
        for place in range(10 * chat.ROWS_HELD):
            read.append(place)
            yield 7, place, "text", []

    assert next(chat._batched(turns(), chat.PIECES, 2)).num_rows == chat.ROWS_HELD == len(read)


@pytest.mark.parametrize("formatter", [chat.format_conversations, chat.format_turns])
def test_no_conversations(spark, formatter):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(formatter(none)).count() == 0


def test_what_is_not_a_format_is_refused():
    for text in ("x", "<|im_start|>user\nno end", "<|im_start|>u\na<|im_end|>\nrest"):
        with pytest.raises(ValueError):
            [*chat.read_turns(text)]
