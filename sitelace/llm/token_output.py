"""Token ids in files of Simple-8b words.

File: magic; blocks; document table as an Arrow stream; block table; lengths; magic.  A block holds up to BLOCK_IDS ids.
A 64-bit word has a selector in its top four bits, which says how many ids of how many bits the rest holds; selector 0
is an escape, whose value of over 60 bits stands behind the block's words.  The block table has each block's place and
counts, so any block is found and decoded alone, one selector at a time for all its words at once.

Cases: null or empty texts have the end id alone; very long ones span blocks.  A vocabulary file of another kind than the
one that texts are cut for is refused.  Order: document id with nulls first, then a hash of the text, so
equal ids are in a fixed order and a crowd of them is still split between tasks; equal rows are interchangeable.  An
empty table makes no files.  Files of a failed task are never named in the result, so retries do no harm.
"""

from __future__ import annotations

import io
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import ChunkEncoder, byte_symbols, checked
from .common import shared_dir, worker_cache

MAGIC = b"S8BIDS01"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 25
#: Fixed values of the format: ids in a word for selectors 1 to 14, and the bits of each.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_STEPS = np.array([1, *COUNTS], np.int64)
_POWERS = np.uint64(1) << np.arange(61, dtype=np.uint64)
#: Bits of each small id.
_BITS = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.int8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the escaped values."""
    n = len(ids)
    values = np.concatenate([ids.astype(np.uint64), np.zeros(COUNTS[0], np.uint64)])
    bits = _BITS[ids] if n and ids.max() < len(_BITS) else np.searchsorted(_POWERS, values[:n], side="right").astype(np.int8)
    # The widest id of each window, longer windows from two shorter ones; the longest window that fits is chosen.
    window, length = np.concatenate([bits, np.zeros(COUNTS[0], np.int8)]), 1
    chosen = np.zeros(n, np.int8)
    for s in range(len(COUNTS), 0, -1):
        if (more := COUNTS[s - 1] - length) > 0:
            window, length = np.maximum(window[: len(window) - more], window[more:]), COUNTS[s - 1]
        chosen[window[:n] <= WIDTHS[s - 1]] = s
    steps, starts, i = _STEPS[chosen].tolist(), [], 0
    while i < n:
        starts.append(i)
        i += steps[i]
    starts = np.array(starts, np.int64)
    kinds = chosen[starts]
    words = np.empty(len(starts), np.uint64)
    for s in np.unique(kinds).tolist():
        at = starts[kinds == s]
        if s == 0:
            words[kinds == 0] = 0
            continue
        shifts = np.arange(COUNTS[s - 1], dtype=np.uint64) * np.uint64(WIDTHS[s - 1])
        held = np.bitwise_or.reduce(values[at[:, None] + np.arange(COUNTS[s - 1])] << shifts, axis=1)
        words[kinds == s] = held | np.uint64(s) << np.uint64(60)
    return words, values[starts[kinds == 0]]


def unpack(words: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    kinds = (words >> np.uint64(60)).astype(np.int8)
    steps = _STEPS[kinds]
    at = np.cumsum(steps) - steps
    out = np.zeros(n + COUNTS[0], np.uint64)
    for s in np.unique(kinds).tolist():
        own = kinds == s
        if s == 0:
            out[at[own]] = escaped
            continue
        shifts = np.arange(COUNTS[s - 1], dtype=np.uint64) * np.uint64(WIDTHS[s - 1])
        out[at[own][:, None] + np.arange(COUNTS[s - 1])] = words[own][:, None] >> shifts & np.uint64((1 << WIDTHS[s - 1]) - 1)
    return out[:n]


class FileWriter:
    """Ids go in document by document; blocks go out as they fill."""

    def __init__(self, sink):
        self.sink, self.blocks, self.docs, self.sizes, self.waiting, self.n_waiting, self.n = sink, [], [], [], [], 0, 0
        sink.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            self.flush(BLOCK_IDS)

    def flush(self, least: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        at = 0
        while len(ids) - at >= max(1, least):
            block = ids[at : at + BLOCK_IDS]
            words, escaped = pack(block)
            raw = words.astype("<u8").tobytes() + escaped.astype("<u8").tobytes()
            self.sink.write(raw)
            self.blocks.append((self.at, len(block), len(words), len(escaped)))
            self.at += len(raw)
            at += len(block)
        self.waiting, self.n_waiting = [ids[at:]], len(ids) - at

    def close(self) -> None:
        self.flush(1)
        docs = pa.record_batch({"doc_id": pa.array(self.docs, pa.int64()), "n": pa.array(self.sizes, pa.int64())})
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, docs.schema) as w:
            w.write_batch(docs)
        table, blocks = sink.getvalue(), np.array(self.blocks, "<i8").tobytes()
        self.sink.write(table + blocks + struct.pack("<QQ", len(table), len(blocks)) + MAGIC)
        self.sink.close()


def read_file(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a file with their ids, a block in memory at a time."""
    end = source.size()
    source.seek(end - 16 - len(MAGIC))
    n_table, n_blocks = struct.unpack("<QQ", source.read(16))
    if source.read(len(MAGIC)) != MAGIC:
        raise ValueError("no such file of ids")
    source.seek(end - 16 - len(MAGIC) - n_blocks - n_table)
    docs = pa.ipc.open_stream(source.read(n_table)).read_all()
    blocks = np.frombuffer(source.read(n_blocks), "<i8").reshape(-1, 4).tolist()
    have, left = np.empty(0, np.uint64), iter(blocks)
    for doc_id, n in zip(docs["doc_id"].to_pylist(), docs["n"].to_pylist(), strict=True):
        parts, got = [have], len(have)
        while got < n:
            at, ids, words, escaped = next(left)
            source.seek(at)
            raw = np.frombuffer(source.read(8 * (words + escaped)), "<u8")
            parts.append(unpack(raw[:words], raw[words:], ids))
            got += ids
        have = np.concatenate(parts) if len(parts) > 1 else have
        yield doc_id, have[:n]
        have = have[n:]


class LibraryEncoder(ChunkEncoder):
    """The tokenizers library, asked once for each chunk that the cache lacks: its whole pipeline, or for pieces that are
    their own normal form its model alone."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        checked(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        super().__init__(self.tokenizer)
        self.model, self.symbols = self.tokenizer.model, byte_symbols()

    def piece_ids(self, raw: bytes) -> bytes:
        shown = raw.decode() if raw.isascii() else "".join(map(self.symbols.__getitem__, raw))
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def chunk_ids(self, raw: bytes) -> bytes:
        return array("I", self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids).tobytes()


def encoder(path: str) -> LibraryEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = worker_cache("tokens")
    if path not in held:
        held[path] = LibraryEncoder(path)
    return held[path]


def _open(uri: str, how: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    if how == "w":
        where.create_dir(os.path.dirname(path), recursive=True)
        return where.open_output_stream(path)
    return where.open_input_file(path)


def _uri(path: str) -> str:
    return f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path


def write_tokens(df: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the files; returns their table (uri, shard, number within the shard, n_ids), already computed."""
    spark = df.sparkSession
    folder = _uri(folder or shared_dir(spark, "tokens"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, out, uri, enc = TaskContext.get().partitionId(), 0, None, "", encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()

        def row():
            return pa.RecordBatch.from_pylist([{"uri": uri, "shard": shard, "number": number, "n_ids": out.n}])

        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None:
                    uri = f"{folder}/{shard:06d}-{number:04d}-{uuid.uuid4().hex}.s8b"
                    out = FileWriter(_open(uri, "w"))
                out.add(d, np.frombuffer(enc.encode(t.as_py()) + end, "<u4"))
                if out.n >= FILE_IDS:
                    out.close()
                    yield row()
                    out, number = None, number + 1
        if out is not None:
            out.close()
            yield row()

    rows = df.select(F.col(doc_id).cast("bigint").alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    key = F.xxhash64("t").alias("h")
    ordered = rows.select("d", key, "t").repartitionByRange("d", "h").sortWithinPartitions("d", "h").select("d", "t")
    files = ordered.mapInArrow(write, "uri string, shard bigint, number bigint, n_ids bigint")
    made = files.collect()  # one row for each file of 32 million ids or rest of a partition
    return spark.createDataFrame(sorted(made, key=lambda r: (r["shard"], r["number"])), "uri string, shard bigint, number bigint, n_ids bigint")


def read_tokens(spark: SparkSession, files: DataFrame) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    known, at = [], 0
    for r in files.orderBy("shard", "number").collect():
        known.append((r["uri"], at))
        at += r["n_ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, start in chain.from_iterable(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for b in batches):
            rows = []
            with _open(uri, "r") as source:
                for doc_id, ids in read_file(source):
                    rows.append({"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
                    start += len(ids)
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, OUT)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, OUT)

    listed = spark.createDataFrame(known, "uri string, start bigint")
    return listed.repartition(max(1, len(known))).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
