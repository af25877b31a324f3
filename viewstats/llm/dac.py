"""Directly addressable codes: token ids with random access to each one.

An id is cut into chunks of 8 bits, lowest first. Level 0 holds the first chunk of every id; a bitmap
says which ids go on, and the next chunks of those ids make up level 1, and so on. The position of an
id in the next level is the number of set bits before it, found with a rank directory that holds the
running count every 512 bits. One id is read with one byte, one directory entry and part of one bitmap
block per level; nothing else is decoded.

File, little-endian: 8 bytes magic, uint64 documents, uint64 ids, uint64 levels; per level uint64
entries; int64 keys, uint8 flags (1: the key is not null), uint64 first ids (one more than documents);
per level the chunks, the bitmap (padded to whole blocks of 64 bytes) and the uint32 directory.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"DACTOK01"
CHUNK_BITS = 8
BLOCK_BITS = 512
_POPCOUNT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint32)


def encode(keys: list[int | None], counts: list[int], ids: np.ndarray) -> list[bytes]:
    """The file of documents with these keys and numbers of ids; `ids` are uint32, one after another."""
    levels, rest = [], ids.astype(np.uint32, copy=False)
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more != 0
        bitmap = np.packbits(goes_on, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (BLOCK_BITS // 8), np.uint8)])
        per_block = _POPCOUNT[bitmap].reshape(-1, BLOCK_BITS // 8).sum(axis=1)
        directory = np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")
        levels.append(((rest & 0xFF).astype(np.uint8), bitmap, directory))
        rest = more[goes_on]
        if not len(rest):
            break
    starts = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))]).astype("<u8")
    flags = np.array([k is not None for k in keys], np.uint8)
    head = np.array([len(keys), len(ids), len(levels), *[len(chunks) for chunks, _, _ in levels]], "<u8")
    parts = [MAGIC, head.tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(), flags.tobytes(),
             starts.tobytes()]
    for level in levels:
        parts += [part.tobytes() for part in level]
    return parts


class DacFile:
    """Reads a file of `encode` by ranges; `source` has seek and read."""

    def __init__(self, source):
        self._source = source
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.documents, self.ids, levels = np.frombuffer(self._read(8, 24), "<u8").tolist()
        self._entries = np.frombuffer(self._read(32, 8 * levels), "<u8").tolist()
        at = 32 + 8 * levels
        self._keys, self._flags = at, at + 8 * self.documents
        self._starts = self._flags + self.documents
        at, self._levels = self._starts + 8 * (self.documents + 1), []
        for n in self._entries:
            blocks = -(-(-(-n // 8)) // (BLOCK_BITS // 8))
            self._levels.append((at, at + n, at + n + blocks * (BLOCK_BITS // 8)))
            at += n + blocks * (BLOCK_BITS // 8) + 4 * (blocks + 1)

    def _read(self, at: int, size: int) -> bytes:
        self._source.seek(at)
        return self._source.read(size)

    def table(self) -> tuple[list[int | None], np.ndarray]:
        """Keys, and where each document's ids start (one more than documents)."""
        keys = np.frombuffer(self._read(self._keys, 8 * self.documents), "<i8").tolist()
        flags = self._read(self._flags, self.documents)
        starts = np.frombuffer(self._read(self._starts, 8 * (self.documents + 1)), "<u8").astype(np.int64)
        return [k if there else None for k, there in zip(keys, flags)], starts

    def _rank(self, level: int, position: int) -> int:
        """Set bits of the level's bitmap before `position`."""
        _, bitmap, directory = self._levels[level]
        block, bits = divmod(position, BLOCK_BITS)
        count = int.from_bytes(self._read(directory + 4 * block, 4), "little")
        if bits:
            head = self._read(bitmap + block * (BLOCK_BITS // 8), -(-bits // 8))
            count += (int.from_bytes(head, "little") & ((1 << bits) - 1)).bit_count()
        return count

    def token(self, position: int) -> int:
        """One id, by one range read per level and structure."""
        if not 0 <= position < self.ids:
            raise IndexError(position)
        value = 0
        for level, (chunks, bitmap, _) in enumerate(self._levels):
            value |= self._read(chunks + position, 1)[0] << (CHUNK_BITS * level)
            if not self._read(bitmap + position // 8, 1)[0] >> position % 8 & 1:
                break
            position = self._rank(level, position)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids from `start` to before `end` as uint32, read from those ranges of each level alone."""
        values = np.zeros(end - start, np.uint32)
        at = np.arange(end - start)
        for level, (chunks, bitmap, _) in enumerate(self._levels):
            if start >= end:
                break
            chunk = np.frombuffer(self._read(chunks + start, end - start), np.uint8)
            values[at] |= chunk.astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            first = start // 8
            bits = np.frombuffer(self._read(bitmap + first, -(-end // 8) - first), np.uint8)
            goes_on = np.unpackbits(bits, bitorder="little")[start - 8 * first:end - 8 * first].astype(bool)
            at = at[goes_on]
            start = self._rank(level, start) if len(at) else 0
            end = start + len(at)
        return values
