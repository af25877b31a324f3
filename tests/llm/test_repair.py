"""Repairs against all sequences of edits of small conversations."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from llm_cases import clashing
from viewstats.llm import repair

TURNS = "conv_id long, turn long, role string, text string"


def repairs(rows, role_letters="", audit="", cost=0, said=(), added=0):
    """All (cost, audit, repaired) of rows of (role, text, fault)."""
    if re.fullmatch("(s?(ua)+)?", role_letters) and not rows:
        yield cost, audit, said
    if added < 3:
        for role in ("user", "assistant"):
            yield from repairs(rows, role_letters + role[0], audit + "I", cost + 2, (*said, f"{role}:"), added + 1)
    if rows:
        (role, text, fault), rest = rows[0], rows[1:]
        yield from repairs(rest, role_letters, audit + "D", cost + 3, said, added)
        if fault in (None, "truncated"):
            late = int(fault == "truncated")
            yield from repairs(rest, role_letters + (role[:1] or "-"), audit + "K", cost + late, (*said, f"{role}:{text}"), added)
            for new in ("user", "assistant"):
                yield from repairs(rest, role_letters + new[0], audit + "R", cost + 2 + late, (*said, f"{new}:{text}"), added)


def brute_force(rows):
    """The result row for one conversation of (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    letters = [role[:1] for _, role, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, said = min(repairs([(r, t, f) for (_, r, t), f in zip(rows, faults)]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])),
            cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def got(spark, rows, add=lambda df: df, **how):
    return {r[0]: tuple(r)[1:] for r in repair.repaired(add(spark.createDataFrame(rows, TURNS).repartition(3)), **how).collect()}


def conversations(seed, n=40):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for _ in range(rng.randrange(1, 5)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 5]), rng.choice(["system", "user", "assistant", "assistant", "tool", ""]),
                         rng.choice(["Yes.", "No", "", " \n", "Why? ", "été"])))
    return rows


def expected(rows):
    return {conv: brute_force([r[1:] for r in rows if r[0] == conv]) for conv in {r[0] for r in rows}}


@pytest.mark.parametrize("piece", [repair.PIECE, 1, 2])
def test_all_edits(spark, piece):
    rows = conversations(piece)
    assert got(spark, rows, piece=piece) == expected(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (1, None, None, None), (2, 3, "user", "same."),
            (2, 3, "user", "same."), (2, 3, "user", "same."), (2, 4, "assistant", "x y. " * 30_000)]
    want = expected([(c, t, r or "", x or "") for c, t, r, x in rows])
    assert got(spark, rows) == want and got(spark, rows, add=clashing) == want
    assert got(spark, []) == {}
    none = spark.createDataFrame([(9,), (9,), (None,)], "conv_id long")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(spark, [], conversations=none) == {9: empty, None: empty}


def test_one_conversation_of_most_rows(spark):
    """Pieces, partitions and counted copies give what the whole list gives at once."""
    rng = random.Random(8)
    rows = [(3, i // 2, rng.choice(["user", "assistant", "system"]), f"{i % 700} words{rng.choice('. ')}") for i in range(3000)]
    rows += [(3, 9, "user", "a third of all rows.")] * 1500 + [(c + 10, *r) for c, *r in conversations(9, 20)]
    # Compare with pieces as long as the conversation.
    assert got(spark, rows) == got(spark, rows, piece=10 ** 6) == got(spark, rows, piece=50)
    whole = got(spark, rows)[3]
    ordered = sorted((t, r, x) for c, t, r, x in rows if c == 3)
    seen, faulty = set(), []
    for _, role, text in ordered:
        faulty.append((role[:1], repair.LOST if (role, text) in seen else
                       repair.SOUND if text.rstrip()[-1] in ".!?" else repair.CUT_OFF, 1))
        seen.add((role, text))
    assert repair.lightest(faulty)[repair.START] == whole[5:7]


def test_damage(spark):
    rows = [(c, t, r, x) for c in [*range(30), None] for t in [*range(6), None]
            for r, x in [("system", "A. B! C?"), (None, None)]]
    want = []
    for c, t, r, x in rows:
        r, x = r or " ", x or " "
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if case == 1 else re.sub("[.!?]", "", x) if case == 2 else x
        want += [(c, t, "user" if case == 4 else r, x)] * {0: 0, 3: 2}.get(case, 1)
    df = repair.damage(spark.createDataFrame(rows, TURNS).withColumn("case", F.lit("clash")))
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
