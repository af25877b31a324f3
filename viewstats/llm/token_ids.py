"""Whole texts as token ids in files of directly addressable codes (see `dac`)."""

from __future__ import annotations

import hashlib
import json
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewstats.llm import dac
from viewstats.llm.common import Memo, kept, whole
from viewstats.llm.store import Store

FILE_IDS = 4 << 20
# The pattern by which byte-level BPE splits a text.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Characters whose class no Unicode version or regex library sees differently.
PLAIN = re.compile("[\n -~¡-ɏ]*")


class _Unsplittable(Exception):
    """A space in the text is not where pieces meet."""


def _splits_at_spaces(definition: dict) -> bool:
    """Whether a definition is plain byte-level BPE: nothing rewrites the text, the pattern above parts it,
    and a part always gives the same tokens."""
    before, model = definition.get("pre_tokenizer") or {}, definition["model"]
    return (before.get("type") == "ByteLevel" and not before.get("add_prefix_space", True)
            and before.get("use_regex", True) and definition.get("normalizer") is None
            and definition.get("truncation") is None and definition.get("padding") is None
            and model.get("type") == "BPE" and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))


class Encoder:
    """A byte-level BPE tokenizer of the tokenizers library with its results remembered.

    BPE treats the parts of a text that its pattern finds each on its own, and a single space between
    two other characters always begins a part. So texts are cut at such spaces and each distinct piece
    is encoded once. Texts where that does not hold, or with special tokens, go to the library whole, as
    do all texts of any other tokenizer.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        fields = json.loads(definition)
        self.splits = _splits_at_spaces(fields)
        added = [t["content"] for t in fields["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.pieces, self.parts = Memo(self.after_space), Memo(self.part)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.byte = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def part(self, part: str) -> bytes:
        """Ids, as packed uint32, of one part that the pattern finds."""
        if part.isascii() and part.isalpha():
            shown = part
        elif part[0] == " " and part.isascii() and part[1:].isalpha():
            shown = "\u0120" + part[1:]
        else:
            shown = "".join(map(self.byte.__getitem__, part.encode()))
        ids = [token.id for token in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def after_space(self, piece: str) -> bytes:
        """Ids of a space and the piece after it."""
        if piece.isascii():
            if piece.isalpha():
                ids = [token.id for token in self.model.tokenize("\u0120" + piece)]
                return struct.pack(f"<{len(ids)}I", *ids)
            if piece[-1:] in (",", ".") and piece[:-1].isalpha():
                # The word is likely to be there, or to be met, without the sign too.
                return self.pieces[piece[:-1]] + self.parts[piece[-1]]
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Unsplittable
        return self.piece(" " + piece)

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not self.special.search(text):
            return b"".join(map(self.parts.__getitem__, PATTERN.findall(text)))
        return self.library(text)

    def __call__(self, text: str) -> bytes:
        """The ids of a whole text as packed little-endian uint32."""
        if not self.splits:
            return self.library(text)
        first, *rest = text.split(" ")
        try:
            if first and first[-1].isspace():
                raise _Unsplittable
            return self.piece(first) + b"".join(map(self.pieces.__getitem__, rest))
        except _Unsplittable:
            return self.piece(text)


def write_tokens(docs: DataFrame, path: str, definition: str, end_id: int = 0, key: str = "doc_id",
                 text: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of every text, each with `end_id` after it, in ascending key order; returns the
    table of the files (also kept under `path`): part, number, file, documents, ids.

    `definition` is the JSON of a byte-level BPE tokenizer. A null text is empty; a null key comes
    first. Rows with equal keys follow each other in text order. Files end at the first document that
    brings them to `file_ids`. Other columns are not read. An empty table writes no file.
    """
    def write(batches):
        name = "encoder_" + hashlib.sha256(definition.encode()).hexdigest()
        encoder, store, part = kept(name, lambda: Encoder(definition)), Store(path), TaskContext.get().partitionId()
        end, keys, counts, packed, held, made = np.array([end_id], "<u4").tobytes(), [], [], [], 0, 0

        def flush():
            nonlocal keys, counts, packed, held, made
            ids = np.frombuffer(b"".join(packed), "<u4")
            name = store.write(f"tokens-{part:06d}-{made:06d}", dac.encode(keys, counts, ids))
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "number": pa.array([made], pa.int32()),
                "file": [name], "documents": [len(keys)], "ids": [len(ids)]})
            keys, counts, packed, held, made = [], [], [], 0, made + 1
            return row

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder(t.as_py()) + end
                keys.append(k)
                counts.append(len(ids) // 4)
                packed.append(ids)
                held += len(ids) // 4
                if held >= file_ids:
                    yield flush()
        if keys:
            yield flush()

    rows = docs.select(F.col(key).cast("long").alias("key"), whole(text).alias("text"))
    ordered = rows.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions(
        "key", F.xxhash64("text"), "text")
    files = ordered.mapInArrow(write, "part int, number int, file string, documents long, ids long")
    files.write.parquet(f"{path}/files")
    return docs.sparkSession.read.parquet(f"{path}/files")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under `path`: key, start (ids before it in all files),
    n_tokens, ids (packed little-endian uint32)."""
    files = spark.read.parquet(f"{path}/files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def read(batches):
        store = Store(path)
        for batch in batches:
            for name, base in zip(*(column.to_pylist() for column in batch.columns)):
                with store.open(name) as source:
                    keys, starts = (file := dac.DacFile(source)).table()
                    at = 0
                    while at < len(keys):  # some documents at a time: about a million ids, one at least
                        to = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 20), "right")) - 1)
                        ids = file.tokens(int(starts[at]), int(starts[to])).astype("<u4")
                        cuts = starts[at:to + 1] - starts[at]
                        yield pa.RecordBatch.from_pydict({
                            "key": pa.array(keys[at:to], pa.int64()), "start": starts[at:to] + base,
                            "n_tokens": np.diff(cuts),
                            "ids": [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]})
                        at = to

    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(read, "key long, start long, n_tokens long, ids binary")
