"""Token ids in training order, as binary shards.

Documents are tokenised and packed, each followed by the vocabulary's end token, into sequences of ``length`` tokens;
the last sequence of a chunk of documents is filled with end tokens. The sequences are numbered, and a keyed
Feistel permutation of the numbers gives every sequence its slot in the training order: the network permutes the
smallest power of four that covers all numbers, and a result outside them is permuted again until it is inside
(cycle walking). So the order is a bijection that needs no sort by a random key and can be computed for any slot
at any time. (The numbers follow the order in which the table is read; a table that is read in other splits has its
sequences numbered in another order.) A shard is a range of ``records`` slots; tasks write ranges of shards, each shard as
one file of records of a fixed stride, so slot ``s`` stands at byte ``s % records * stride`` of shard ``s // records`` and a reader can start anywhere.

A record has the tokens (little-endian, 2 bytes each, or 4 for a large vocabulary), 8 bytes for the slot, 3 for the
number of tokens without the filling, 4 for the CRC-32 of the tokens, and a line feed. The files are written by
Spark's own text writer, whose line separator is that last byte; they need no shared file system but the one Spark
writes to, and a lost task is written again.

Defined results: null text counts as empty, and an empty text has its end token only; rows with equal or null ids
are documents like any other; other columns, whatever their names, play no part; an empty table gives no shards.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.chunks import pack, pieces, text_bytes, unpack
from millrace.llm.hashing import mix
from millrace.operators.ordering import running_total
from millrace.session import scratch, shared_folder

#: Tokens of a sequence and records of a shard.
LENGTH = 2048
RECORDS = 2048
#: Bytes of a record behind its tokens.
TRAILER = 16
#: Bytes of text in a chunk, and bytes of shards that one task sorts and writes.
CHUNK_BYTES = 4 << 20
TASK_BYTES = 256 << 20
ROUNDS = 6
#: Compression of tokens on their way.
LEVEL = 6


@dataclass(frozen=True)
class Bytepairs:
    """A byte-level vocabulary by ranks; the id after the last one ends a document."""

    ranks: bytes
    pattern: str

    @staticmethod
    def read(path: str, pattern: str) -> Bytepairs:
        """From a file that the driver can read; it is small and goes to the tasks as a value."""
        with open(path, "rb") as file:
            return Bytepairs(zlib.compress(file.read(), 9), pattern)


@lru_cache(maxsize=2)
def encoding(vocabulary: Bytepairs):
    import tiktoken

    lines = zlib.decompress(vocabulary.ranks).splitlines()
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(uuid.uuid4().hex, pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={}), len(ranks)


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each of the numbers 0 to n - 1; a bijection for every key."""
    bits = max(1, -(-int(n - 1).bit_length() // 2))
    half, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    keys = mix(np.uint64(key & (2**64 - 1)) + np.arange(1, ROUNDS + 1, dtype=np.uint64))
    out = numbers.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> half, out[walk] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[walk] = (left << half) | right
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def slots_back(slots: np.ndarray, n: int, key: int) -> np.ndarray:
    """The numbers that have these slots."""
    bits = max(1, -(-int(n - 1).bit_length() // 2))
    half, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    keys = mix(np.uint64(key & (2**64 - 1)) + np.arange(1, ROUNDS + 1, dtype=np.uint64))
    out = slots.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> half, out[walk] & mask
        for k in keys[::-1]:
            left, right = right ^ (mix(left + k) & mask), left
        out[walk] = (left << half) | right
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


@dataclass
class Shards:
    """Written shards: where, of what, and the numbered sequences with the documents in them."""

    path: str
    count: int
    length: int
    records: int
    width: int
    sequences: DataFrame

    @property
    def stride(self) -> int:
        return self.length * self.width + TRAILER


def tokenised(docs: DataFrame, vocabulary: Bytepairs, length: int, id_column: str, text: str, chunk_bytes: int) -> DataFrame:
    """A stored table of chunks: their number of sequences and packed tokens, and ids and ends of their documents."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoding(vocabulary)
        task = TaskContext.get().partitionId() << 20
        chunk, held, ids, size = 0, [], [], 0

        def cut() -> pa.RecordBatch:
            nonlocal chunk, held, ids, size
            tokens = np.concatenate(held)
            ends = np.cumsum([len(x) for x in held])
            tokens = np.concatenate((tokens, np.full(-len(tokens) % length, end, tokens.dtype)))
            out = {
                "chunk": pa.array([task + chunk], pa.int64()),
                "n": pa.array([len(tokens) // length], pa.int64()),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "ends": pa.array([ends], pa.list_(pa.int64())),
                "tokens": pa.array([pack(tokens.tobytes(), LEVEL)], pa.binary()),
            }
            chunk, held, ids, size = chunk + 1, [], [], 0
            return pa.RecordBatch.from_pydict(out)

        kind = np.uint16 if end < 1 << 16 else np.uint32
        for batch in batches:
            for part in pieces(batch, "text", chunk_bytes) if batch.num_rows else ():
                if held and size + text_bytes(part.column("text"))[1][-1] > chunk_bytes:
                    yield cut()
                size += int(text_bytes(part.column("text"))[1][-1])
                for value in part.column("text").to_pylist():
                    tokens = encode.encode_ordinary(value) if value else []
                    tokens.append(end)
                    held.append(np.array(tokens, kind))
                ids += part.column("id").to_pylist()
        if held:
            yield cut()

    spark = docs.sparkSession
    shared_folder(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    name = f"tokens_{uuid.uuid4().hex}"
    made = rows.mapInArrow(each, "chunk long, n long, ids array<long>, ends array<long>, tokens binary")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    made.write.bucketBy(buckets, "chunk").option("path", scratch(spark, name)).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def write(docs: DataFrame, path: str, vocabulary: Bytepairs, key: int = 0, length: int = LENGTH, records: int = RECORDS, id_column: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> Shards:
    """Write ``docs`` as shards in the order that ``key`` gives."""
    chunks = tokenised(docs, vocabulary, length, id_column, text, chunk_bytes)
    width = 2 if zlib.decompress(vocabulary.ranks).count(b"\n") < (1 << 16) - 1 else 4
    kind = np.uint16 if width == 2 else np.uint32
    count = chunks.agg(F.sum("n")).first()[0] or 0
    begins = running_total(chunks.select("chunk", "n"), ["chunk"], weight="n", name="begin").select("chunk", "begin")
    placed = chunks.join(begins, "chunk")

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, begin, blob, ends in zip(*(batch.column(c) for c in ("n", "begin", "tokens", "ends"))):
                slots = permuted(np.arange(begin.as_py(), begin.as_py() + n.as_py()), count, key)
                tokens = np.frombuffer(unpack(blob.as_py()), kind).reshape(-1, length)
                real = np.clip(ends.values[-1].as_py() - np.arange(len(slots)) * length, 0, length)
                blobs = []
                for row, slot, used in zip(tokens, slots, real):
                    body = row.tobytes()
                    trailer = int(slot).to_bytes(8, "little") + int(used).to_bytes(3, "little")
                    blobs.append(pack(body + trailer + zlib.crc32(body).to_bytes(4, "little"), LEVEL))
                yield pa.RecordBatch.from_pydict(
                    {"shard": pa.array(slots // records), "slot": pa.array(slots), "record": pa.array(blobs, pa.binary())}
                )

    def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                blobs = pa.array([unpack(x.as_py()) for x in part.column("record")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("shard"), part.column("slot"), blobs], part.schema.names)

    shape = "shard long, slot long, record binary"
    # A task writes a range of shards: some hundred MB, or less while there are not enough for all cores.
    every = max(-(-count // records), 1)
    size = count * (length * width + TRAILER)
    tasks = min(every, max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))
    task = F.call_function("div", F.col("shard") * F.lit(tasks), F.lit(every)).cast("int")
    dealt = placed.mapInArrow(spread, shape).repartitionById(tasks, task).mapInArrow(unpacked, shape)
    ordered = dealt.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
    ordered.write.partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(path)

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, begin, ids, ends in zip(*(batch.column(c).to_pylist() for c in ("n", "begin", "ids", "ends"))):
                numbers = np.arange(begin, begin + n)
                edges = np.arange(n + 1) * length
                starts = np.concatenate(([0], ends[:-1]))
                first = np.searchsorted(ends, edges[:-1], side="right")
                last = np.searchsorted(starts, edges[1:], side="left")
                yield pa.RecordBatch.from_pydict(
                    {
                        "number": pa.array(numbers),
                        "slot": pa.array(permuted(numbers, count, key)),
                        "doc_ids": pa.array([ids[i:j] for i, j in zip(first, last)], pa.list_(pa.int64())),
                    }
                )

    sequences = placed.select("n", "begin", "ids", "ends").mapInArrow(listed, "number long, slot long, doc_ids array<long>")
    return Shards(path, count, length, records, width, sequences)


def read(spark: SparkSession, shards: Shards, start: int = 0, stop: int | None = None, tokens: bool = True) -> DataFrame:
    """The records of the slots from ``start`` to before ``stop``: shard, slot, place (its byte), n_tokens, whole
    (the checksum fits and the record is in its place) and, if wanted, tokens. Only shards of that range are read."""
    stop = shards.count if stop is None else min(stop, shards.count)
    shape = "shard long, slot long, place long, n_tokens int, whole boolean" + ", tokens array<int>" * tokens
    if stop <= start:
        return spark.createDataFrame([], shape)
    stride, body, kind = shards.stride, shards.length * shards.width, np.uint16 if shards.width == 2 else np.uint32
    first, last, records = start // shards.records, (stop - 1) // shards.records, shards.records
    files = spark.read.format("binaryFile").load(shards.path).select(F.col("shard").cast("long"), "content")
    files = files.where(F.col("shard").between(first, last))

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard"), batch.column("content")):
                shard, rows = shard.as_py(), np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                slots = rows[:, body : body + 8].copy().view(np.int64).ravel()
                used = rows[:, body + 8 : body + 11].astype(np.int32) @ np.array([1, 1 << 8, 1 << 16], np.int32)
                sums = rows[:, body + 11 : body + 15].copy().view(np.uint32).ravel()
                whole = np.array([zlib.crc32(r[:body]) for r in rows], np.uint32) == sums
                whole &= (slots == shard * records + np.arange(len(rows))) & (rows[:, -1] == 10)
                pick = np.flatnonzero((slots >= start) & (slots < stop))
                for part in np.array_split(pick, -(-len(pick) // 512)) if len(pick) else ():
                    out = {
                        "shard": pa.array(np.full(len(part), shard)),
                        "slot": pa.array(slots[part]),
                        "place": pa.array(part * stride),
                        "n_tokens": pa.array(used[part]),
                        "whole": pa.array(whole[part]),
                    }
                    if tokens:
                        ids = rows[part, :body].copy().view(kind).astype(np.int32)
                        out["tokens"] = pa.array([x[:k] for x, k in zip(ids, used[part])], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(out)

    return files.mapInArrow(each, shape)


def summary(docs: DataFrame, path: str, vocabulary: Bytepairs, **settings) -> DataFrame:
    """Write the shards and read them back: one row per sequence with its place, its documents and whether it is whole."""
    shards = write(docs, path, vocabulary, **settings)
    return read(docs.sparkSession, shards, tokens=False).join(shards.sequences, "slot")
