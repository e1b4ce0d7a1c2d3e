"""Language-model scoring with a probabilistic suffix tree.

A text is its lower-cased words (A-Z; runs without ASCII white space), each with a space behind it, and one end. The
tree predicts the bytes of that sequence; its contexts are the last 0 to ``DEPTH`` bytes:

* The chunks exchange their distinct byte strings of ``DEPTH`` + 1 by value; the buckets sum the training counts. All
  strings of the corpus are there, so the table of counts grows with the corpus and is never sent whole anywhere.
* Level by level a context is retained if coding its successors by their own distribution instead of that of its
  longest retained suffix saves more bits than its parameters cost (a divergence test: the training count times the
  relative entropy against half a logarithm of the count for each successor seen).
* Distributions are smoothed with that suffix's, weighted by the number of different successors. So each
  string ends with the probability of its last byte in its longest retained suffix, which goes back to the chunks.

A token's probability (a word with its space, or the end) is that of its bytes, smoothed with the token's share of all
tokens at the weight ``WEIGHT``. The token probabilities of every state sum to one.

The word unigram score beside it is the usual baseline with half a count added.

Defined results: null text is empty and has one token, the end. A null id counts as an empty one in the choice of
training rows. Other columns, whatever their names, play no part. Without training rows all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import hashing as H
from millrace.llm.chunks import ANSWER, SENT, Chunks, answered, exchanged, found_in_all, pack, sent, stored, unpack

#: Bytes of the longest context; a string of one more has to fit into 6 bytes.
DEPTH = 5
#: Weight of the tokens' own shares beside their spelling.
WEIGHT = 0.2
START, END = b"\r", b"\n"
#: Odd, so that a string's first three bytes are spread over the buckets one to one; the strings that share them stay
#: neighbours and are sent as small steps.
SPREAD = 0x9E3779
UNSPREAD = pow(SPREAD, -1, 1 << 24)
#: The end of a text as a word.
END_WORD = H.places_hash(np.frombuffer(END, np.uint8), np.zeros(1, np.int64), 1)
TRAINS = "training row of the language model"


class Words:
    """The words of a chunk: distinct keys, which one each word is, and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.cumsum([0, *map(len, texts)])
        self.starts, self.ends, self.first = H.words_of(data, bounds)
        hashes = np.concatenate((H.word_hashes(data, self.starts, self.ends), END_WORD))
        self.keys, self.of = np.unique(hashes, return_inverse=True)
        self.end, self.of = self.of[-1], self.of[:-1]

    def counts(self, train: np.ndarray) -> np.ndarray:
        used = np.repeat(train, np.diff(self.first))
        out = np.bincount(self.of[used], minlength=len(self.keys))
        out[self.end] += np.count_nonzero(train)
        return out.astype(np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum over each text's words and its end of a value per key."""
        return self.totals(values[self.of], values[self.end])

    def totals(self, words: np.ndarray, end) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(words)))
        return total[self.first[1:]] - total[self.first[:-1]] + end


def normal(rows: pa.Table, text: str) -> list[bytes]:
    texts = rows.column(text).cast(pa.binary()).fill_null(b"").to_pylist()
    return [b" ".join([*t.lower().split(), END]) for t in texts]


def strings(texts: list[bytes]) -> np.ndarray:
    """The key of every byte with the ``DEPTH`` bytes before it, text after text."""
    data = np.frombuffer(b"".join(x for t in texts for x in (START * DEPTH, t)), np.uint8)
    # Two bytes, four, and six at every place from the sixth on.
    two = data.astype(np.uint64)
    two[1:] |= np.left_shift(two[:-1], np.uint64(8))
    out = np.left_shift(two[3:-2], np.uint64(16))
    out |= two[5:]
    out |= np.left_shift(two[1:-4], np.uint64(32))
    return key_of(out[data[DEPTH:] != START[0]])


def firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each different value of a sorted array begins."""
    return np.flatnonzero(np.concatenate((ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1])))


def numbered(keys: np.ndarray) -> np.ndarray:
    """The place of every key among the different ones in order."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.zeros(len(keys), np.int64)
    new[firsts(ordered)[1:]] = 1
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out


def distinct_counts(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and how often each stands in training text. Keys leave their last bits free, so one
    of them can say so while they are sorted."""
    flagged = keys | train.astype(np.uint64)
    flagged.sort()
    plain = flagged & ~np.uint64(1)
    at = firsts(plain)
    counts = np.add.reduceat((flagged & np.uint64(1)).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return plain[at], counts


def key_of(string: np.ndarray) -> np.ndarray:
    first = ((string >> np.uint64(24)) * np.uint64(SPREAD)) & np.uint64(0xFFFFFF)
    return (first << np.uint64(40)) | ((string & np.uint64(0xFFFFFF)) << np.uint64(16))


def string_of(key: np.ndarray) -> np.ndarray:
    first = ((key >> np.uint64(40)) * np.uint64(UNSPREAD)) & np.uint64(0xFFFFFF)
    return (first << np.uint64(24)) | ((key >> np.uint64(16)) & np.uint64(0xFFFFFF))


def training(rows: pa.Table) -> np.ndarray:
    return np.asarray(rows.column(TRAINS).fill_null(True)).astype(bool)


def totals(columns: list[np.ndarray]) -> list[np.ndarray]:
    """For entries key, count: the key's count; and the bucket's distinct trained keys and the sum of their counts."""
    key, count = columns
    keys, of = np.unique(key, return_inverse=True)
    total = np.bincount(of, weights=count, minlength=len(keys)).astype(np.int64)
    return [total[of], np.count_nonzero(total), total.sum()]


def planes(x: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second ones, and so on, compressed."""
    return pack(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes())


def from_planes(blob: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(unpack(blob), np.uint8).reshape(width, -1).T).view(kind).ravel()


def squeezed(parts: list[np.ndarray]) -> bytes:
    """Sorted keys by their steps, and their counts."""
    key, count = parts
    steps = planes(np.diff(key, prepend=np.uint64(0)))
    return len(steps).to_bytes(4, "little") + steps + planes(count.astype(np.uint32))


def keys_of(blob: bytes) -> np.ndarray:
    return np.cumsum(from_planes(blob[4 : 4 + int.from_bytes(blob[:4], "little")], np.uint64), dtype=np.uint64)


def counts_of(blob: bytes) -> np.ndarray:
    return from_planes(blob[4 + int.from_bytes(blob[:4], "little") :], np.uint32).astype(np.int64)


def counted(requests: DataFrame) -> DataFrame:
    """Rows bucket, g (the string as a number), c (training count)."""

    def bucket(rows: pa.Table) -> pa.Table:
        blobs = [e.as_py() for e in rows.column("entries")]
        key, count = np.concatenate([keys_of(b) for b in blobs]), np.concatenate([counts_of(b) for b in blobs])
        order = np.argsort(key)
        key = key[order]
        at = firsts(key)
        keys, total = key[at], np.add.reduceat(count[order], at)
        number = np.full(len(keys), rows.column("bucket")[0].as_py(), np.int32)
        return pa.table({"bucket": pa.array(number), "g": pa.array(string_of(keys).astype(np.int64)), "c": pa.array(total)})

    return requests.groupBy("bucket").applyInArrow(bucket, "bucket int, g long, c long")


def tree(counts: DataFrame) -> DataFrame:
    """The probability ``p`` of every string's last byte after its longest retained suffix, with ``g`` and ``bucket``."""

    def suffix(n: int) -> Column:
        return F.col("g").bitwiseAND((1 << (8 * n)) - 1)

    level = None
    for depth in range(DEPTH + 1):
        last = depth == DEPTH
        nodes = counts if last else counts.groupBy(suffix(depth + 1).alias("g")).agg(F.sum("c").alias("c"))
        if level is None:
            nodes = nodes.withColumn("p", F.lit(1 / 256))
        else:
            shorter = level.select(F.col("g").alias("shorter"), "p")
            nodes = nodes.withColumn("shorter", suffix(depth)).join(shorter, "shorter")
        context = Window.partitionBy(F.shiftright("g", 8))
        seen = F.col("c") > 0
        nodes = nodes.withColumns(
            {
                "n": F.sum("c").over(context),
                "k": F.sum(seen.cast("int")).over(context),
                "gain": F.sum(F.when(seen, F.col("c") * (F.log2("c") - F.log2("p"))).otherwise(0.0)).over(context),
            }
        )
        bits = F.when(F.col("n") > 0, F.col("n") * F.log2("n")).otherwise(0.0)
        cost = F.when(F.col("n") > 0, F.col("k") * F.log2("n") / 2).otherwise(0.0)
        state = (F.col("k") > 0) & (F.lit(depth == 0) | (F.col("gain") - bits > cost))
        own = (F.col("c") + F.col("k") * F.col("p")) / (F.col("n") + F.col("k"))
        level = nodes.withColumn("p", F.when(state, own).otherwise(F.col("p"))).select("g", "p", *["bucket"] * last)
    return level.select("bucket", "g", "p")


def looked_up(requests: DataFrame, model: DataFrame) -> DataFrame:
    """For each chunk's strings the logarithm (10) of the model's probability."""

    def bucket(asked: pa.Table, known: pa.Table) -> pa.Table:
        key = key_of(known.column("g").to_numpy().astype(np.uint64))
        order = np.argsort(key)
        key, p = key[order], np.log10(known.column("p").to_numpy()[order]).astype(np.float32)
        entries = [planes(p[np.searchsorted(key, keys_of(e.as_py()))]) for e in asked.column("entries")]
        return pa.table({"chunk": asked.column("chunk"), "bucket": asked.column("bucket"), "entries": pa.array(entries, pa.binary())})

    return requests.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(bucket, ANSWER)


def mixed(count: np.ndarray, spelt: np.ndarray, tokens: int) -> np.ndarray:
    """Logarithm (10) of tokens' probabilities by their counts and the logarithm of their spelling's probability."""
    if not tokens:
        return spelt
    own = spelt + np.log10(1 - WEIGHT)
    seen = np.log10(WEIGHT * np.maximum(count, 1) / tokens)
    return np.where(count > 0, np.logaddexp(seen * LN10, own * LN10) / LN10, own)


LN10 = np.log(10.0)

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, trains: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every text; rows where ``trains`` is true (or null) train both models."""
    chunks = Chunks(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"), trains.alias(TRAINS)), "text")
    buckets = chunks.parts()

    def words(chunk: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        found = Words(normal(rows, "text"))
        yield from sent(chunk, found.keys, [found.keys, found.counts(training(rows))], buckets)

    def pieces(chunk: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        texts, train = normal(rows, "text"), training(rows)
        keys, total = distinct_counts(strings(texts), np.repeat(train, [len(t) for t in texts]))
        yield from sent(chunk, keys, [keys, total], buckets, squeezed)

    counts = stored(exchanged(chunks.map(words, SENT), [np.uint64, np.int64], totals, found=2), "counts")
    distinct, tokens = found_in_all(counts, 2)
    requests = stored(chunks.map(pieces, SENT), "strings")
    asked = looked_up(requests, tree(stored(counted(requests), "model")))
    log_all = np.log10(tokens + 0.5 * (distinct + 1))

    def score(chunk: int, rows: pa.Table, counts: list[bytes], logs: list[bytes]) -> Iterator[pa.RecordBatch]:
        texts = normal(rows, "text")
        found = Words(texts)
        count = answered(counts, np.int64)
        logs = np.concatenate([from_planes(b, np.float32) for b in logs]).astype(np.float64)
        each = logs[numbered(strings(texts))]
        total = np.concatenate(([0], np.cumsum(each)))
        last = np.cumsum([len(t) for t in texts]) - 1
        spelt = total[found.ends + 1] - total[found.starts]
        words = mixed(count[found.of], spelt, tokens)
        ends = mixed(np.full(len(texts), count[found.end]), each[last], tokens)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": rows.column("id").combine_chunks(),
                "held_out": pa.array(~training(rows)),
                "n_tokens": pa.array(np.diff(found.first) + 1, pa.int64()),
                "n_known": pa.array(found.sums((count > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array([tokens] * len(texts), pa.int64()),
                "base_score": pa.array(found.sums(np.log10(count + 0.5) - log_all)),
                "score": pa.array(found.totals(words, ends)),
            }
        )

    return chunks.map_with([counts, asked], score, SCORES)
