"""Suffix-array dedup: bytes covered by a string that also starts in a document with a smaller id.

Method. Every window of ``width`` bytes has a minimiser: its ``ANCHOR``-byte piece with the smallest hash. Windows
that follow each other and share one minimiser form a *string*; equal windows have equal minimisers, so all places
of a window meet in the bucket of its minimiser and no other place has to be looked at. Per bucket:

1. Strings are compared by hash and the smallest document of each is found. A minimiser with one string only is
   resolved by that; most copies are.
2. Where one minimiser has several strings, their windows may repeat across different strings. Each chunk sends the
   Burrows-Wheeler transform of those strings that it holds first. The bucket merges the shards' transforms by
   iterative interleave refinement: the interleave for prefixes of h + 1 bytes is the stable order, by preceding
   byte, of the interleave for h bytes, carried through the LF mapping. No suffix is sorted again. Blocks of equal
   prefixes are carried along: after ``width`` rounds they are the intervals of suffixes whose common prefix is
   ``width`` or longer, and the smallest document of an interval tells which windows repeat. Carried are the suffixes
   that become a window's in the rounds left, one per window; the others tell nothing about windows.

3. A minimiser with very many strings in a chunk (the edge of a passage that many documents share) is *hot*. The
   chunk sends one mark for it, and wherever strings meet a mark, their windows are compared by hash, each in the
   bucket of its own hash, so that the windows of one minimiser do not meet in one task.

Nothing depends on the number of copies: a chunk sends a string once, and a string is in the transforms once for
each chunk that holds it in its smallest document.

Defined results: null text is empty; rows with a null id are left as they are and take no part; rows with equal
ids are compared with smaller ids only, never with each other; other columns, whatever their names, stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing as H
from millrace.llm.chunks import (
    ANSWER,
    SENT,
    Chunks,
    answered,
    cuts,
    exchanged,
    give_back,
    pack,
    sent,
    shares,
    stored,
    text_bytes,
    unpack,
)

#: Bytes of a minimiser.
ANCHOR = 24
#: Classes of a string in a chunk.
ALONE, LATER, OPEN, SPLIT = 0, 1, 2, 3


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


class Strings:
    """The strings of a chunk's texts: rows ``start``, ``runs`` (windows), ``doc`` (row in the chunk), ``key``, ``name``."""

    STEP = H.STEP

    def __init__(self, rows: pa.Table, id_column: str, text: str, width: int):
        self.width = width
        self.data, self.bounds = text_bytes(rows.column(text))
        ids = rows.column(id_column).cast(pa.int64())
        self.known = ~np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        anchor = min(ANCHOR, width)
        found: list[tuple[np.ndarray, ...]] = []
        # Long texts are read in overlapping steps; a string cut at a step's end is found in two parts, each whole.
        for at in range(0, max(len(self.data) - width + 1, 0), self.STEP):
            found.append(self._step(at, min(at + self.STEP + width - 1, len(self.data)), anchor))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        self.start, self.runs, self.key, self.name = (np.concatenate(x) for x in zip(*found)) if found else empty
        self.doc = np.searchsorted(self.bounds, self.start, side="right") - 1
        if not self.known.all():
            use = self.known[self.doc]
            self.start, self.runs, self.key, self.name, self.doc = (
                x[use] for x in (self.start, self.runs, self.key, self.name, self.doc)
            )
        # Distinct strings, sorted by key and name, each with its smallest document.
        ids = self.ids[self.doc]
        order = np.lexsort((ids, self.name, self.key))
        key, name = self.key[order], self.name[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        self.first = order[new]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        # Hot minimisers: one mark is sent for all their strings.
        key = self.key[self.first]
        _, at, strings = np.unique(key, return_index=True, return_counts=True)
        self.hot = np.repeat(strings > HOT, strings)
        self.marks = at[strings > HOT]

    def _step(self, at: int, stop: int, anchor: int) -> tuple[np.ndarray, ...]:
        sums = H.prefix_sums(self.data[at:stop])
        _, down = H.powers(len(sums))
        n = len(sums) - anchor
        order = (sums[anchor:] - sums[:n]) * down[:n]
        order *= np.uint64(0x9FB21C651E98DF25)
        order ^= order >> np.uint64(32)
        order *= np.uint64(0x9FB21C651E98DF25)
        places = np.uint64((1 << 20) - 1)
        order &= ~places
        order |= np.arange(n, dtype=np.uint64)
        least = (sliding_min(order, self.width - anchor + 1) & places).astype(np.int64)
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        edges = self.bounds[1:-1]
        edges = edges[np.searchsorted(edges, at) : np.searchsorted(edges, at + len(least) + self.width)]
        inside = np.ones(len(least), bool)
        # A window that reaches over the end of a text is no window.
        for shift in range(1, self.width):
            cut = edges - shift - at
            inside[cut[(cut >= 0) & (cut < len(inside))]] = False
        starts = edges - at
        new[starts[(starts > 0) & (starts < len(new))]] = True
        new[1:] |= inside[1:] != inside[:-1]
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(least))
        ok = inside[start]
        start, end = start[ok], end[ok]
        place = least[start]
        return (
            start + at,
            end - start,
            H.slice_hashes(sums, place, place + anchor),
            H.slice_hashes(sums, start, end + self.width - 1),
        )

    def asked(self) -> np.ndarray:
        """The distinct strings (or marks) that are sent."""
        send = ~self.hot
        send[self.marks] = True
        return np.flatnonzero(send)

    def kinds(self, answers: np.ndarray) -> np.ndarray:
        """The classes of the distinct strings."""
        out = np.full(len(self.first), SPLIT, np.uint8)
        cold = self.asked()
        out[cold[~self.hot[cold]]] = answers[~self.hot[cold]]
        return out

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.runs[i] + self.width - 1].tobytes()


def transform(strings: list[bytes]) -> np.ndarray:
    """The Burrows-Wheeler transform of sorted, distinct strings, as byte + 1 with 0 for the end of a string.

    Rows are the suffixes of all strings in order, equal ones by the number of their string."""
    sizes = np.array([len(s) for s in strings])
    widest = int(sizes.max())
    padded = np.zeros((len(strings), 2 * widest), np.uint8)
    padded[np.arange(2 * widest) < sizes[:, None]] = np.frombuffer(b"".join(strings), np.uint8) + np.uint8(1)
    views = np.lib.stride_tricks.sliding_window_view(padded, widest, axis=1)
    real = np.arange(widest + 1)[None, :] <= sizes[:, None]
    string, place = np.nonzero(real)
    order = np.argsort(views[real].view(f"S{widest}").ravel(), kind="stable")
    string, place = string[order], place[order]
    return np.where(place > 0, padded[string, place - 1], 0).astype(np.uint8)


def last_to_first(bwts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each row of the transforms, set one behind the other, the row of the suffix one byte longer."""
    at, steps, starts = 0, [], []
    for bwt in bwts:
        step = np.empty(len(bwt), np.int32)
        step[np.argsort(bwt, kind="stable")] = np.arange(at, at + len(bwt), dtype=np.int32)
        steps.append(step)
        starts.append(at + np.arange(np.count_nonzero(bwt == 0), dtype=np.int32))
        at += len(bwt)
    return np.concatenate(steps), np.concatenate(starts)


def interleave(bwts: list[np.ndarray], step: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """For each row that ``rows`` reach in ``width`` steps the number of its interval: suffixes of them that share their
    first ``width`` bytes. Other rows have -1; they are in no interval of these and need not be carried."""
    last = np.concatenate(bwts)
    block = np.zeros(len(rows), np.int32)
    for _ in range(width):
        byte = last[rows]
        order = np.argsort(byte, kind="stable")
        byte, block = byte[order], block[order]
        rows = step[rows[order]]
        new = (byte[1:] != byte[:-1]) | (block[1:] != block[:-1])
        block = np.zeros(len(rows), np.int32)
        np.cumsum(new, out=block[1:])
    of_row = np.full(len(last), -1, np.int32)
    of_row[rows] = block
    return of_row


def repeated(bwts: list[np.ndarray], runs: np.ndarray, docs: np.ndarray, width: int) -> np.ndarray:
    """For each string a bit per window: does the window stand in a string of a smaller document?"""
    step, rows = last_to_first(bwts)
    # The suffixes behind the windows: only these become, byte by byte, suffixes that begin with a whole window.
    behind, at = [], rows
    for back in range(int(runs.max())):
        behind.append(at[runs > back])
        at = step[at]
    interval = interleave(bwts, step, np.concatenate(behind), width)
    for _ in range(width - 1):  # from the end of the strings to their last windows
        rows = step[rows]
    least = np.full(int(interval.max()) + 1, np.iinfo(np.int64).max)
    blocks = np.full((int(runs.max()), len(runs)), -1, np.int32)
    for back in range(int(runs.max())):
        rows = step[rows]
        live = runs > back
        blocks[runs[live] - 1 - back, np.flatnonzero(live)] = interval[rows[live]]
        np.minimum.at(least, interval[rows[live]], docs[live])
    bits = np.zeros(len(runs), np.uint64)
    for place in range(len(blocks)):
        smaller = (blocks[place] >= 0) & (least[blocks[place]] < docs)
        bits |= smaller.astype(np.uint64) << np.uint64(place)
    return bits


#: Strings in one transform, and bits of a row's number for the transforms of a chunk in a bucket.
SHARD = 4096
SHARD_BITS = 10
#: A minimiser with more strings than this in one chunk is hot.
HOT = 32
#: Stands for all strings of a hot minimiser.
MARK = 0


def shard_order(s: Strings, pick: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """The strings ``pick`` (sorted by key) as shards: number, places in ``pick`` in order of the bytes, the bytes."""
    bounds = cuts(s.key[pick], buckets)
    for b in np.flatnonzero(bounds[1:] > bounds[:-1]):
        for k in range(bounds[b], bounds[b + 1], SHARD):
            part = np.arange(k, min(k + SHARD, bounds[b + 1]))
            texts = [s.bytes_of(i) for i in pick[part]]
            order = sorted(range(len(part)), key=texts.__getitem__)
            yield (int(b) << SHARD_BITS) + (k - bounds[b]) // SHARD, part[order], [texts[i] for i in order]


def shards(chunk: int, s: Strings, pick: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The transforms of the strings ``pick`` for their buckets."""
    for number, part, texts in shard_order(s, pick, buckets):
        own = pick[part]
        blob = s.runs[own].astype(np.uint8).tobytes() + s.ids[s.doc[own]].tobytes() + transform(texts).tobytes()
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([chunk], pa.int64()),
                "bucket": pa.array([number], pa.int32()),
                "n": pa.array([len(own)], pa.int64()),
                "entries": pa.array([pack(blob)], pa.binary()),
            }
        )


def in_order(s: Strings, pick: np.ndarray, buckets: int, blobs: list[bytes]) -> np.ndarray:
    """The answers to ``shards`` in the order of ``pick``."""
    out = np.zeros(len(pick), np.uint64)
    for (_, part, _), blob in zip(shard_order(s, pick, buckets), blobs, strict=True):
        out[part] = np.frombuffer(unpack(blob), np.uint64)
    return out


def merged(requests: DataFrame, width: int) -> DataFrame:
    """The buckets' answers to ``shards``: bits of repeated windows, string by string."""

    def bucket(rows: pa.Table) -> pa.Table:
        n = rows.column("n").to_numpy()
        runs, docs, bwts = [], [], []
        for blob, k in zip(rows.column("entries"), n):
            blob = unpack(blob.as_py())
            runs.append(np.frombuffer(blob, np.uint8, k).astype(np.int64))
            docs.append(np.frombuffer(blob, np.int64, k, k))
            bwts.append(np.frombuffer(blob, np.uint8, offset=9 * k))
        bits = repeated(bwts, np.concatenate(runs), np.concatenate(docs), width)
        ends = np.cumsum(n)
        entries = [pack(bits[e - k : e].tobytes()) for e, k in zip(ends, n)]
        del runs, docs, bwts
        give_back()
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "entries": pa.array(entries, pa.binary())})

    keyed = requests.withColumn("at", F.expr(f"shiftright(bucket, {SHARD_BITS})"))
    return keyed.groupBy("at").applyInArrow(bucket, ANSWER)


def classes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The class of every entry key, name, doc of a bucket."""
    out = np.empty(len(columns[0]), np.uint8)
    for at in shares(columns[0]):
        out[at] = classes_of(*(c[at] for c in columns))
    return [out]


def classes_of(key: np.ndarray, name: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The classes of all entries of some keys."""
    order = np.lexsort((doc, name, key))
    key, name, doc = key[order], name[order], doc[order]
    new_key = np.ones(len(key), bool)
    new_key[1:] = key[1:] != key[:-1]
    new = new_key.copy()
    new[1:] |= name[1:] != name[:-1]
    least = doc[new]
    of_key = np.flatnonzero(new_key[new])
    several = np.minimum.reduceat(least, of_key) < np.maximum.reduceat(least, of_key)
    hot = np.logical_or.reduceat(name[new] == MARK, of_key)
    own = np.where(hot, SPLIT, np.where(several, OPEN, ALONE))[np.cumsum(new_key) - 1]
    out = np.empty(len(key), np.uint8)
    out[order] = np.where(doc > least[np.cumsum(new) - 1], LATER, own)
    return out


KINDS = [np.uint32, np.uint64, np.int64]


def windows_of(s: Strings, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of the strings ``pick``: sorted distinct hashes, smallest document, and which one each window is;
    the windows are numbered string by string."""
    runs = s.runs[pick]
    if not len(pick):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), runs
    within = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    start = np.repeat(s.start[pick], runs) + within
    hashes = np.concatenate(
        [
            H.places_hash(s.data, start[k : k + (1 << 16)], s.width)
            for k in range(0, len(start), 1 << 16)
        ]
    )
    keys, of = np.unique(hashes, return_inverse=True)
    docs = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(docs, of, np.repeat(s.ids[s.doc[pick]], runs))
    return keys, docs, of, runs


def later(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Of entries key, doc: does the key stand in a smaller document?"""
    key, doc = columns
    order = np.lexsort((doc, key))
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    out = np.empty(len(key), bool)
    out[order] = doc[order] > doc[order][new][np.cumsum(new) - 1]
    return [out]


def removed(s: Strings, kind: np.ndarray, bits: np.ndarray, split_later: np.ndarray) -> np.ndarray:
    """Which bytes go. ``kind`` has the distinct strings' classes, ``bits`` the windows of the open ones (in the order
    of ``shards``), ``split_later`` those of the split ones."""
    mask = np.zeros(len(s.data) + 1, np.int32)
    first_id = s.ids[s.doc[s.first]]
    behind = (kind[s.of] == LATER) | (s.ids[s.doc] > first_id[s.of])
    np.add.at(mask, s.start[behind], 1)
    np.add.at(mask, s.start[behind] + s.runs[behind] + s.width - 1, -1)
    own = np.zeros(len(s.first), np.uint64)
    own[kind == OPEN] = bits
    split = np.flatnonzero(kind == SPLIT)
    if len(split):
        _, least, of, runs = windows_of(s, s.first[split])
        hit = split_later[of] | (least[of] < np.repeat(first_id[split], runs))
        shift = (np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)).astype(np.uint64)
        np.bitwise_or.at(own, np.repeat(split, runs), hit.astype(np.uint64) << shift)
    some = np.flatnonzero(~behind & (own[s.of] != 0))
    for place in range(int(s.runs.max()) if len(some) else 0):
        hit = s.start[some[(own[s.of[some]] >> np.uint64(place)) & np.uint64(1) == 1]] + place
        np.add.at(mask, hit, 1)
        np.add.at(mask, hit + s.width, -1)
    return np.cumsum(mask[:-1]) > 0


def marks(docs: DataFrame, emit, schema, id_column: str, text: str, width: int) -> DataFrame:
    """``emit(rows, strings, gone)`` for every chunk; ``gone`` says which bytes are repeated."""
    if width - min(ANCHOR, width) >= 64:
        raise ValueError(f"width must be below {ANCHOR + 64}")
    chunks = Chunks(docs, text)
    buckets = chunks.parts()

    def strings(rows: pa.Table) -> Strings:
        return Strings(rows, id_column, text, width)

    def keys(chunk: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        s = strings(rows)
        asked = s.asked()
        f = s.first[asked]
        name = np.where(s.hot[asked], np.uint64(MARK), s.name[f])
        yield from sent(chunk, s.key[f], [s.key[f].astype(np.uint32), name, s.ids[s.doc[f]]], buckets)

    kinds = stored(exchanged(chunks.map(keys, SENT), KINDS, classes), "classes")

    def open_strings(chunk: int, rows: pa.Table, got: list[bytes]) -> Iterator[pa.RecordBatch]:
        s = strings(rows)
        yield from shards(chunk, s, s.first[s.kinds(answered(got, np.uint8)) == OPEN], buckets)

    def split_windows(chunk: int, rows: pa.Table, got: list[bytes]) -> Iterator[pa.RecordBatch]:
        s = strings(rows)
        key, doc, _, _ = windows_of(s, s.first[s.kinds(answered(got, np.uint8)) == SPLIT])
        yield from sent(chunk, key, [key, doc], buckets)

    bits = merged(chunks.map_with([kinds], open_strings, SENT), width)
    windows = exchanged(chunks.map_with([kinds], split_windows, SENT), [np.uint64, np.int64], later)

    def out(chunk: int, rows: pa.Table, kinds: list[bytes], bits: list[bytes], windows: list[bytes]) -> Iterator[pa.RecordBatch]:
        s = strings(rows)
        kind = s.kinds(answered(kinds, np.uint8))
        own = in_order(s, s.first[kind == OPEN], buckets, bits)
        yield from emit(rows, s, removed(s, kind, own, answered(windows, bool)))

    return chunks.map_with([kinds, bits, windows], out, schema)


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeat_digest(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 50) -> DataFrame:
    """Per document: its bytes, how many go in how many runs, and the SHA-256 of what stays."""

    def emit(rows: pa.Table, s: Strings, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
        sums = np.concatenate(([0], np.cumsum(gone)))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = s.bounds[(s.bounds > 0) & (s.bounds < len(gone))]
        begins[inner] = gone[inner]
        spans = np.concatenate(([0], np.cumsum(begins)))
        n_removed = sums[s.bounds[1:]] - sums[s.bounds[:-1]]
        kept = s.data[~gone]
        at = s.bounds - sums[s.bounds]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": rows.column(id_column).cast(pa.int64()).combine_chunks(),
                "n_bytes": pa.array(np.diff(s.bounds), pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array(spans[s.bounds[1:]] - spans[s.bounds[:-1]], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(kept[i:j]).hexdigest() for i, j in zip(at, at[1:])], pa.string()),
            }
        )

    return marks(docs, emit, DIGEST, id_column, text, width)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 50) -> DataFrame:
    """``docs`` with repeated bytes taken out of ``text``.

    What is left of a character cut in two is dropped. A document from which bytes were taken and of which only
    white space stays is dropped. ``n_chars``, where there is such a column, counts the new text."""
    schema = docs.schema

    def emit(rows: pa.Table, s: Strings, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
        sums = np.concatenate(([0], np.cumsum(gone)))
        hit = np.flatnonzero(sums[s.bounds[1:]] > sums[s.bounds[:-1]])
        if len(hit):
            texts = rows.column(text).to_pylist()
            keep = np.ones(len(texts), bool)
            for i in hit:
                part = slice(s.bounds[i], s.bounds[i + 1])
                texts[i] = s.data[part][~gone[part]].tobytes().decode("utf-8", "ignore")
                keep[i] = bool(texts[i].strip())
            rows = rows.set_column(rows.schema.get_field_index(text), rows.schema.field(text), pa.array(texts, rows.schema.field(text).type))
            if "n_chars" in rows.column_names:
                counts = rows.column("n_chars").to_pylist()
                for i in hit:
                    counts[i] = len(texts[i])
                field = rows.schema.field("n_chars")
                rows = rows.set_column(rows.schema.get_field_index("n_chars"), field, pa.array(counts, field.type))
            rows = rows.filter(pa.array(keep))
        yield from rows.to_batches()

    return marks(docs, emit, schema, id_column, text, width)
