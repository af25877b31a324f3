"""Directly addressable codes and the tokenizer in front of them."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import clashing, documents, odd_rows, prose
from viewstats.llm import dac, token_ids
from viewstats.llm.common import scratch
from viewstats.llm.store import Store

PATH = public_tokenizers.path("byte_bpe_50k.json")
DEFINITION = open(PATH, encoding="utf-8").read()


@pytest.mark.parametrize("n", [0, 1, 7, 8, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [1, 256, 257, 65_536, 2 ** 32])
def test_any_id_and_any_range_can_be_read(tmp_path, n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    store = Store(str(tmp_path))
    name = store.write("t", dac.encode([None, -5], [n // 3, n - n // 3], ids))
    with store.open(name) as source:
        file = dac.DacFile(source)
        assert file.table()[0] == [None, -5] and file.table()[1].tolist() == [0, n // 3, n]
        for i in {0, n // 2, n - 1, 511, 512} & set(range(n)):
            assert file.token(i) == ids[i]
        for a, b in [(0, n), (n // 3, n // 2), (max(0, n - 9), n), (n, n)]:
            assert file.tokens(a, b).tolist() == ids[a:b].tolist()
        with pytest.raises(IndexError):
            file.token(n)


def test_a_token_is_read_without_decoding_others(tmp_path):
    ids = np.arange(100_000, dtype=np.uint32) % 50_000
    store = Store(str(tmp_path))
    name = store.write("t", dac.encode([1], [len(ids)], ids))
    with store.open(name) as source:
        file, read = dac.DacFile(source), []
        inner = file._read
        file._read = lambda at, size: read.append(size) or inner(at, size)
        assert file.token(77_777) == ids[77_777]
        assert sum(read) < 200


def test_encoder_equals_the_library():
    library, encoder = Tokenizer.from_file(PATH), token_ids.Encoder(DEFINITION)
    rng = random.Random(3)
    signs = ["a", "é", "Ж", "中", "'s", "'", "1", "12", ".", ",", "!!", " ", "  ", "\n", "\t", " ", " ",
             "\x1c", "<|endoftext|>", "<|", "word", "Word,", "don't", "́", "😀"]
    texts = ["", " ", "  x", "x  ", " x ", "a\n\nb", "a \n b", *[t for _, t in odd_rows() if t]]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    texts += [" ".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(1000)]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(text), "<u4").tolist() == expected, text


@pytest.mark.parametrize("file_ids", [10, 1 << 22])
def test_round_trip(spark, file_ids):
    rng = random.Random(5)
    rows = [(i * 7 % 501, prose(rng, rng.randrange(40))) for i in range(501)] + odd_rows()
    path = scratch(spark, "t")
    files = token_ids.write_tokens(clashing(documents(spark, rows)), path, DEFINITION, 0, file_ids=file_ids)
    got = token_ids.read_tokens(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(PATH)
    expected = {}
    for k, t in rows:
        expected.setdefault(k, []).append(library.encode(t or "", add_special_tokens=False).ids + [0])
    assert len(got) == len(rows) and files.count() >= (20 if file_ids == 10 else 1)
    start = 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["start"] == start and r["n_tokens"] == len(ids)
        expected[r["key"]].remove(ids)
        start += len(ids)
    keys = [r["key"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and not any(expected.values())


def test_no_documents(spark):
    path = scratch(spark, "t")
    token_ids.write_tokens(documents(spark, []), path, DEFINITION)
    assert token_ids.read_tokens(spark, path).count() == 0


def _definition(**changes):
    definition = json.loads(DEFINITION)
    for field, value in changes.items():
        definition[field] = value if value is None or field == "normalizer" else definition[field] | value
    return json.dumps(definition)


@pytest.mark.parametrize("changes", [
    {}, {"pre_tokenizer": {"add_prefix_space": True}}, {"normalizer": {"type": "Lowercase"}},
    {"pre_tokenizer": {"use_regex": False}}])
def test_other_definitions_give_what_the_library_gives(changes):
    definition = _definition(**changes)
    encoder, library = token_ids.Encoder(definition), Tokenizer.from_str(definition)
    for text in ["Hello there", " It's 12.  Fine,\n\nthen. ", "Ab cD, ab. Ab\tx", "été 漢字 a", "", "a,", ", . a.b"]:
        got = np.frombuffer(encoder(text), "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, text


def test_long_pieces_are_not_remembered():
    encoder = token_ids.Encoder(_definition())
    for i in range(40):
        encoder("word " + chr(97 + i % 26) * 5000 + f"{i} end")
    held = [*encoder.pieces, *encoder.parts]
    assert held and max(map(len, held)) <= encoder.pieces.longest
