"""Documents packed into chunks, and the exchange of their keys by value.

A chunk is some MB of whole rows, kept as one compressed Arrow stream in one row of a stored table that is bucketed
by chunk: later steps join what they have learnt about a chunk to it without moving its text again. Keys of a
chunk (hashes of windows, shingles or words) are sorted, made unique, cut by value and sent to buckets; a bucket
sees all chunks' keys of its range and answers each chunk, entry by entry, in the same order. A frequent key
arrives once per chunk, so no bucket grows with the copies of a key.

Sizes: a bucket holds about ``chunks / buckets`` chunks' worth of keys. For a larger input raise ``chunk_bytes``
together with the executors' memory, so that the pieces of a chunk do not become too small.
"""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch, shared_folder

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 3 << 20
#: Rows in a chunk, so that row numbers fit beside chunk numbers.
CHUNK_ROWS = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and every pass sees the same rows."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(blob: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(blob)


def unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def give_back() -> None:
    """Returns free memory to the system. A worker lives on between tasks, and what one has kept lies idle beside the
    others; called after each chunk, bucket or part."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table_of(blob: bytes) -> pa.Table:
    """The rows of a chunk."""
    with pa.ipc.open_stream(blob) as reader:
        return reader.read_all().combine_chunks()


def blob_of(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes in a row and the bounds of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no rows
        column = pa.array([], column.type)
    column = column.cast(pa.large_binary()) if len(column) else pa.array([], pa.large_binary())
    column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batch: pa.RecordBatch, text: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows of about ``chunk_bytes`` of text."""
    _, bounds = text_bytes(batch.column(text))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(bounds, bounds[start] + chunk_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), start + CHUNK_ROWS, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


class Chunks:
    """A stored table of chunks. ``df`` has ``chunk`` and ``rows``; ``count`` is the number of chunks."""

    def __init__(self, docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES):
        spark = docs.sparkSession
        shared_folder(spark)

        def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId() << 20
            held: list[pa.RecordBatch] = []
            size = n = 0

            def cut() -> pa.RecordBatch:
                nonlocal n, size, held
                batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                n, size, held = n + 1, 0, []
                return pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([task + n - 1], pa.int64()), "rows": pa.array([blob_of(batch)], pa.binary())}
                )

            for batch in batches:
                for piece in pieces(batch, text, chunk_bytes) if batch.num_rows else ():
                    bounds = text_bytes(piece.column(text))[1]
                    if held and (size + bounds[-1] > chunk_bytes or sum(b.num_rows for b in held) + piece.num_rows > CHUNK_ROWS):
                        yield cut()
                    held.append(piece)
                    size += int(bounds[-1])
            if held:
                yield cut()

        made = docs.mapInArrow(make, "chunk long, rows binary")
        self.schema = docs.schema
        self.spark = spark
        self.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        name = f"chunks_{uuid.uuid4().hex}"
        path = scratch(spark, name)
        made.write.bucketBy(self.buckets, "chunk").option("path", path).saveAsTable(name)
        self.df = spark.table(name)
        self.count = self.df.count()

    def map(self, fn: Callable[[int, pa.Table], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
        """``fn(chunk, rows)`` over all chunks."""

        def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, rows in zip(batch.column("chunk"), batch.column("rows")):
                    yield from fn(chunk.as_py(), table_of(rows.as_py()))
                    give_back()

        return self.df.mapInArrow(each, schema)

    def map_with(
        self, answers: list[DataFrame], fn: Callable[..., Iterable[pa.RecordBatch]], schema: str
    ) -> DataFrame:
        """``fn(chunk, rows, answer of each)``: each of ``answers`` has chunk, bucket, entries and turns into a list
        of its blobs in the order of their buckets. Only the answers are shuffled."""
        joined = self.df
        for i, answer in enumerate(answers):
            lists = answer.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "entries"))).alias(f"_{i}"))
            joined = joined.join(lists, "chunk", "left")
        joined = joined.select("chunk", "rows", *[F.col(f"_{i}.entries").alias(f"_{i}") for i in range(len(answers))])

        names = [f"_{i}" for i in range(len(answers))]

        def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    got = [batch.column(name)[i].as_py() or [] for name in names]
                    yield from fn(batch.column("chunk")[i].as_py(), table_of(batch.column("rows")[i].as_py()), *got)
                    del got
                    give_back()

        return joined.mapInArrow(each, schema)

    def parts(self, chunks_per_bucket: int = 4) -> int:
        """Number of buckets for an exchange."""
        return max(16, math.ceil(self.count / chunks_per_bucket))


def row_ids(chunk: int, n: int) -> np.ndarray:
    """A number for every row of a chunk, unique in the table of chunks."""
    return (np.int64(chunk) << np.int64(20)) + np.arange(n, dtype=np.int64)


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the buckets in sorted 64-bit keys."""
    at = [(b << 64) // buckets for b in range(1, buckets)]
    return np.concatenate(([0], np.searchsorted(keys, np.array(at, np.uint64)), [len(keys)])).astype(np.int64)


def narrow(x: np.ndarray) -> bytes:
    """Integers as their smallest value and offsets of as few bytes as needed."""
    low = int(x.min())
    kind = np.min_scalar_type(int(x.max()) - low)
    return low.to_bytes(8, "little", signed=True) + bytes([kind.itemsize]) + (x - low).astype(kind).tobytes()


def sent(
    chunk: int,
    keys: np.ndarray,
    columns: list[np.ndarray],
    buckets: int,
    entry: Callable[[list[np.ndarray]], bytes] | None = None,
) -> Iterator[pa.RecordBatch]:
    """Rows chunk, bucket, n, entries: the columns' slices of every bucket, one after the other (or as ``entry`` puts
    them together). Signed 64-bit columns are sent narrow."""
    bounds = cuts(keys, buckets)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if not len(full):
        return

    def slices(b: int) -> bytes:
        parts = [c[bounds[b] : bounds[b + 1]] for c in columns]
        if entry:
            return entry(parts)
        return b"".join(narrow(x) if x.dtype == np.int64 else x.tobytes() for x in parts)

    yield pa.RecordBatch.from_pydict(
        {
            "chunk": pa.array(np.full(len(full), chunk), pa.int64()),
            "bucket": pa.array(full.astype(np.int32)),
            "n": pa.array(bounds[full + 1] - bounds[full], pa.int64()),
            "entries": pa.array([slices(b) for b in full], pa.binary()),
        }
    )


SENT = "chunk long, bucket int, n long, entries binary"
ANSWER = "chunk long, bucket int, entries binary"


def shares(keys: np.ndarray, parts: int = 8) -> Iterator[np.ndarray]:
    """Places of the entries, share by share; equal keys are in one share, so that what sorts them needs only a share's
    memory at once."""
    low = (keys % keys.dtype.type(parts)).astype(np.uint8)
    for part in range(parts):
        at = np.flatnonzero(low == part)
        if len(at):
            yield at


def columns_of(blob: bytes | memoryview, n: int, kinds: list) -> list[np.ndarray]:
    """The arrays of one row of ``sent``."""
    out, at = [], 0
    for kind in kinds:
        low = 0
        if kind == np.int64:
            low, kind, at = int.from_bytes(blob[at : at + 8], "little", signed=True), f"u{blob[at + 8]}", at + 9
            out.append(np.frombuffer(blob, kind, n, at).astype(np.int64) + low)
        else:
            out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


#: The chunk of rows with what buckets found in all.
FOUND = -1


def exchanged(requests: DataFrame, kinds: list, fn: Callable[[list[np.ndarray]], list[np.ndarray]], found: int = 0) -> DataFrame:
    """Answers of the buckets. ``fn`` gets a bucket's columns, those of ``sent``, and returns columns whose entries go
    back to the chunks they came from; the last ``found`` of them go, as integers, to a row of chunk ``FOUND``."""

    def bucket(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        n = rows.column("n").to_numpy()
        blobs = [columns_of(memoryview(e.as_buffer()).cast("B"), k, kinds) for e, k in zip(rows.column("entries"), n)]
        columns = [np.concatenate([b[i] for b in blobs]) for i in range(len(kinds))]
        del blobs
        out = fn(columns)
        out, more = out[: len(out) - found], out[len(out) - found :]
        ends = np.cumsum(n)
        del columns
        entries = [pack(b"".join(c[e - k : e].tobytes() for c in out)) for e, k in zip(ends, n)]
        give_back()
        chunk, number = rows.column("chunk").to_numpy(), rows.column("bucket").to_numpy()
        if found:
            entries.append(np.array([int(x) for x in more], np.int64).tobytes())
            chunk, number = np.append(chunk, FOUND), np.append(number, number[0])
        return pa.table({"chunk": pa.array(chunk), "bucket": pa.array(number), "entries": pa.array(entries, pa.binary())})

    return requests.groupBy("bucket").applyInArrow(bucket, ANSWER)


def found_in_all(answers: DataFrame, n: int) -> list[int]:
    """The sums of what the buckets found."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([np.frombuffer(x.as_py(), np.int64) for x in batch.column("entries")]).reshape(-1, n)
            yield pa.RecordBatch.from_pydict({f"x{i}": pa.array(rows[:, i].copy()) for i in range(n)})

    rows = answers.where(F.col("chunk") == FOUND).mapInArrow(each, ", ".join(f"x{i} long" for i in range(n)))
    return [x or 0 for x in rows.agg(*[F.sum(f"x{i}") for i in range(n)]).first()]


def answered(blobs: list[bytes], kind) -> np.ndarray:
    """The answers of all buckets in the order of the keys that were sent."""
    return np.concatenate([np.frombuffer(unpack(b), kind) for b in blobs]) if blobs else np.zeros(0, kind)

