"""WARC archives with a two-level capture index.

Every page becomes a record in its own gzip member, so any record can be read by its file, offset and
length. The index has one line per record, `surt key, record key, file, offset, length`, sorted by
reversed-host key. Each index file holds its lines in compressed blocks and ends with a sparse
directory: the first key of each block and where the block lies. A look-up searches the first keys of
the index files, then a file's directory, then reads one block by its range and searches inside it.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstats.llm.common import cut, quoted, whole
from viewstats.llm.store import Store

ARCHIVE_BYTES = 32 << 20  # before compression
BLOCK_LINES = 512
FILE_BLOCKS = 2048
TASK_BYTES = 16 << 20  # of compressed records, for one reading task
READ_BYTES = 4 << 20  # neighbouring records read at once
SALTS = 32
RECORD_URN = "urn:x-page:"


def surt(url: Column) -> Column:
    """Reversed-host key: http://www.a.example/x?y becomes example,a,www)/x?y. Null is an empty url."""
    host = F.lower(F.regexp_extract(whole(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))
    rest = F.regexp_replace(whole(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def first_copies(pages: DataFrame, key: str, body: str, least_bytes: int, salts: int = SALTS) -> DataFrame:
    """`pages` (all columns) with `refers_to`: the smallest key of an equal payload of at least
    `least_bytes`, null for the record with that key and for smaller payloads.

    Payloads are equal when length, SHA-1 and SHA-256 are. A payload that many pages share is spread
    over `salts` keys. A null key is larger than every key; where all are null, all are responses.
    """
    payload = whole(body)
    identity = F.struct(F.octet_length(payload).alias("size"), F.sha1(payload).alias("sha1"),
                        F.sha2(payload, 256).alias("sha256"))
    keyed = pages.select("*", identity.alias("__payload"),
                         F.pmod(F.xxhash64(key), F.lit(salts)).alias("__salt"))
    shared = (keyed.where(F.octet_length(payload) >= least_bytes)
              .groupBy(F.col("__payload").alias("__shared")).agg(
                  F.min(key).alias("__first"), F.count(F.lit(1)).alias("__n"))
              .where((F.col("__n") > 1) & F.col("__first").isNotNull())
              .withColumn("__spread", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).drop("__n"))
    joined = keyed.join(shared, (F.col("__payload") == F.col("__shared"))
                        & (F.col("__salt") == F.col("__spread")), "left")
    refers = F.when(~F.col(key).eqNullSafe(F.col("__first")), F.col("__first"))
    return joined.withColumn("refers_to", refers).select(*[quoted(c) for c in pages.columns], "refers_to")


def sha1_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(key, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC 1.1 record, response or (with `refers_to`) revisit, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD_URN}{'' if key is None else key}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")),
        ("WARC-Payload-Digest", f"sha1:{sha1_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block)))]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<{RECORD_URN}{refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Fields of one uncompressed record: page (text), type, refers_to (text), digest, size (of the full
    payload), payload (None for revisits). Raises ValueError where lengths or digests don't hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not one whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1_digest(payload) != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")

    def page(name):
        return fields[name][len(RECORD_URN) + 1:-1] if name in fields else None

    return {"page": page("WARC-Record-ID"), "type": kind, "refers_to": page("WARC-Refers-To"),
            "digest": digest, "size": size, "payload": payload if kind == "response" else None}


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url",
                   body: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row under `path` and returns the captures: surt, record (key as text), file,
    offset, length. Null urls and bodies are empty; a null key is an empty record key. Rows that repeat
    the smallest key of a payload are all responses. Other columns are not read."""
    def write(batches):
        store, part, parts, rows, size, offset, made = Store(path), TaskContext.get().partitionId(), [], [], 0, 0, 0

        def flush():
            nonlocal parts, rows, size, offset, made
            name = store.write(f"archive-{part:06d}-{made:06d}.warc.gz", parts)
            surts, records, offsets, lengths = zip(*rows)
            batch = pa.RecordBatch.from_pydict({
                "surt": pa.array(surts, pa.string()), "record": pa.array(records, pa.string()),
                "file": [name] * len(rows), "offset": offsets, "length": lengths})
            parts, rows, size, offset, made = [], [], 0, 0, made + 1
            return batch

        for batch in batches:
            for row in zip(*batch.columns):
                page, target, sort_key, payload, refers_to = (value.as_py() for value in row)
                record = build_record(page, target, payload, refers_to, date)
                member = gzip.compress(record, 6, mtime=0)
                rows.append((sort_key, "" if page is None else str(page), offset, len(member)))
                parts.append(member)
                offset, size = offset + len(member), size + len(record)
                if size >= archive_bytes:
                    yield flush()
        if rows:
            yield flush()

    chosen = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(body).alias("body"))
    rows = first_copies(chosen, "key", "body", least_bytes).select(
        "key", "url", surt(F.col("url")).alias("surt"), whole("body").cast("binary").alias("body"),
        "refers_to")
    return cut(rows.mapInArrow(write, "surt string, record string, file string, offset long, length long"))


def write_index(captures: DataFrame, path: str, block_lines: int = BLOCK_LINES,
                file_blocks: int = FILE_BLOCKS) -> None:
    """Writes the index of `captures` under `path`, with a table of its files and their first keys."""
    def write(batches):
        store, part, made = Store(path), TaskContext.get().partitionId(), 0
        lines, blocks, directory, first = [], [], [], None

        def close_block():
            nonlocal lines
            packed = zlib.compress("\n".join(lines).encode(), 6)
            offset = sum(map(len, blocks))
            directory.append([*key_of(lines[0]), offset, len(packed)])
            blocks.append(packed)
            lines = []

        def close_file():
            nonlocal blocks, directory, made
            packed = zlib.compress(json.dumps(directory).encode(), 6)
            name = store.write(f"index-{part:06d}-{made:06d}", [*blocks, packed, len(packed).to_bytes(8, "little")])
            row = pa.RecordBatch.from_pydict({
                "surt": [directory[0][0]], "record": [directory[0][1]], "file": [name],
                "blocks": [len(directory)]})
            blocks, directory, made = [], [], made + 1
            return row

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                lines.append(json.dumps(row))
                if len(lines) >= block_lines:
                    close_block()
                    if len(directory) >= file_blocks:
                        yield close_file()
        if lines:
            close_block()
        if directory:
            yield close_file()

    ordered = (captures.select("surt", "record", "file", "offset", "length")
               .repartitionByRange("surt", "record").sortWithinPartitions("surt", "record", "file", "offset"))
    ordered.mapInArrow(write, "surt string, record string, file string, blocks long").write.parquet(
        f"{path}/files")


def key_of(line: str) -> tuple[str, str]:
    surt_key, record, *_ = json.loads(line)
    return surt_key, record


class Index:
    """Searches an index; the last directory and block are remembered, as sorted look-ups need."""

    def __init__(self, path: str, files: list[tuple[str, str, str]]):
        """`files`: (surt, record, file) of each index file, in order."""
        self.store, self.names = Store(path), [name for _, _, name in files]
        self.first = [(s.encode(), r.encode()) for s, r, _ in files]
        self._directory = self._block = (None, None)

    def directory(self, file: int) -> list:
        if self._directory[0] != file:
            with self.store.open(self.names[file]) as source:
                end = source.size()
                source.seek(end - 8)
                size = int.from_bytes(source.read(8), "little")
                source.seek(end - 8 - size)
                entries = json.loads(zlib.decompress(source.read(size)))
            keys = [(s.encode(), r.encode()) for s, r, _, _ in entries]
            self._directory = file, (keys, [(offset, size) for _, _, offset, size in entries])
        return self._directory[1]

    def block(self, file: int, at: int) -> tuple[list, list]:
        """Keys and captures of a block."""
        if self._block[0] != (file, at):
            offset, size = self.directory(file)[1][at]
            with self.store.open(self.names[file]) as source:
                source.seek(offset)
                lines = [json.loads(x) for x in zlib.decompress(source.read(size)).decode().split("\n")]
            self._block = (file, at), ([(s.encode(), r.encode()) for s, r, *_ in lines],
                                       [tuple(x[2:]) for x in lines])
        return self._block[1]

    def find(self, surt_key: str, record: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of every capture with this key; runs on into later blocks and files
        where captures repeat."""
        key = (surt_key.encode(), record.encode())
        file = max(0, bisect.bisect_left(self.first, key) - 1)
        while file < len(self.names) and self.first[file] <= key:
            keys, _ = self.directory(file)
            at = max(0, bisect.bisect_left(keys, key) - 1)
            while at < len(keys) and keys[at] <= key:
                held, captures = self.block(file, at)
                for i in range(bisect.bisect_left(held, key), bisect.bisect_right(held, key)):
                    yield captures[i]
                at += 1
            file += 1


def look_up(queries: DataFrame, path: str) -> DataFrame:
    """Captures of (surt, record) rows through the index under `path`: surt, record, file, offset,
    length. Rows are looked up in key order, once per row; repeated rows give repeated captures only
    once per distinct row."""
    spark = queries.sparkSession
    files = spark.read.parquet(f"{path}/files").orderBy("surt", "record", "file").select(
        "surt", "record", "file").collect()  # a row per FILE_BLOCKS x BLOCK_LINES captures

    def find(batches):
        index = Index(path, [tuple(f) for f in files])
        for batch in batches:
            found = [(s, r, *capture) for s, r in zip(*(c.to_pylist() for c in batch.columns))
                     for capture in index.find(s, r)]
            if found:
                columns = zip(*found)
                yield pa.RecordBatch.from_pydict(dict(zip(("surt", "record", "file", "offset", "length"), columns)))

    # Not left to Spark, which would put tasks together by the few bytes of their keys.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (queries.select("surt", "record").distinct().repartitionByRange(tasks, "surt", "record")
               .sortWithinPartitions("surt", "record"))
    return ordered.mapInArrow(find, "surt string, record string, file string, offset long, length long")


def read_records(captures: DataFrame, path: str, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records of `captures`: record, record_type, refers_to (record key), payload_digest,
    payload_bytes, payload (null for revisits). Captures of one stretch of an archive are read together."""
    stretch = F.expr(f"offset div {read_bytes}")

    def read(batches):
        store = Store(path)

        def members():
            """Compressed records; neighbours come from one range read."""
            run: list[tuple[int, int]] = []
            name = None

            def fetch():
                with store.open(name) as source:
                    start = run[0][0]
                    source.seek(start)
                    data = source.read(run[-1][0] + run[-1][1] - start)
                for offset, length in run:
                    yield data[offset - start:offset - start + length]

            for batch in batches:
                for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                    apart = run and (file != name or offset > run[-1][0] + run[-1][1]
                                     or offset + length - run[0][0] > read_bytes)
                    if apart:
                        yield from fetch()
                        run = []
                    name = file
                    run.append((offset, length))
            if run:
                yield from fetch()

        held, size = [], 0
        for member in members():
            held.append(parse_record(gzip.decompress(member)))
            size += held[-1]["size"]
            if size > 8 << 20 or len(held) >= 2048:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    def batch_of(records: list[dict]) -> pa.RecordBatch:
        def column(name, kind):
            return pa.array([r[name] for r in records], kind)
        return pa.RecordBatch.from_pydict({
            "record": column("page", pa.string()), "record_type": column("type", pa.string()),
            "refers_to": column("refers_to", pa.string()), "payload_digest": column("digest", pa.string()),
            "payload_bytes": column("size", pa.int64()), "payload": column("payload", pa.binary())})

    captures = cut(captures.select("file", "offset", "length"))
    total = captures.agg(F.sum("length")).first()[0] or 0
    # A capture is a few bytes for Spark, so the tasks are counted by what they will read.
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    ordered = captures.repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, "record string, record_type string, refers_to string, "
                              "payload_digest string, payload_bytes long, payload binary")


def archive(spark: SparkSession, pages: DataFrame, path: str, **options) -> DataFrame:
    """Writes archives and index of `pages` under `path`; the captures."""
    captures = write_archives(pages, f"{path}/archives", **options)
    write_index(captures, f"{path}/index")
    return captures
