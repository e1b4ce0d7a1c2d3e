"""Alignment of two tokenizers over a corpus.

Both tokenizers cut the same bytes (a blank and the text). Offsets where tokens of both end cut a text into groups, and
inside a group every pair of tokens whose bytes overlap is a link. How often each pair of ids is linked in the whole
corpus gives every link its weight, and every id of B its most frequent ids of A.

The fast path is the identity map, computed once: for every id of A the id of B with the same bytes. Most groups are one
token of each side, which then have the same bytes; such a group is counted by its A id alone, in a vector as long as
the vocabulary, one a task. Only links of all other groups become pairs: they are counted within a chunk of documents,
and the chunk's different pairs are summed by a shuffle.

1. Texts are encoded once and aligned in chunks of some MB; a stored row a chunk holds its documents' counts, the ids of
   its identity links and its other links as places in the chunk's list of pairs.
2. Vectors and pairs are summed to the corpus' counts. A pair inside an irregular group may be an identity pair, so both
   sums meet; a pair is best if no other pair of its B id is more frequent.
3. Every chunk learns the counts of its pairs and sums them by document. The vector (a number per id of A) goes to all
   tasks. The other pairs do too while there are at most ``SENT_PAIRS`` of them; above that the chunks' lists are joined
   to the counts by Spark, one row per chunk and pair, and the answers come back to the chunks by another join.

Defined results: a text that is null or empty, or whose tokens' bytes are not its own on either side (such as one that
has the piece vocabulary's mark for blanks in it), has no tokens, groups or links; special tokens' strings are ordinary
text; rows with equal or null ids are documents like any other; a long text is encoded in parts of ``PART`` characters,
cut where both tokenizers begin anew, if they do so; other columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import blob_of, pack, pieces, stored, table_of, unpack
from millrace.llm.vocabularies import BLANK, Vocabulary, byte_alphabet, divisible, json_tokenizer, parts, piece_model, plain_ids

#: Bytes of text that are aligned at once; a longer text is taken alone.
CHUNK_BYTES = 2 << 20
#: Different pairs, 17 bytes each, that are sent to all tasks.
SENT_PAIRS = 1 << 21
#: Characters of a long text that are encoded at once.
PART = 1 << 18


@dataclass(frozen=True)
class Side:
    """The bytes of a tokenizer's ids."""

    tokens: tuple[bytes, ...]

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.tokens], np.int64)


@lru_cache(maxsize=2)
def byte_side(vocabulary: Vocabulary) -> Side:
    """Bytes of a byte-level vocabulary; ids without an entry have none."""
    entries, letters = json_tokenizer(vocabulary, plain=True).get_vocab(), byte_alphabet()
    tokens = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        if all(c in letters for c in entry):
            tokens[i] = bytes(letters[c] for c in entry)
    return Side(tuple(tokens))


@lru_cache(maxsize=2)
def piece_side(vocabulary: Vocabulary) -> Side:
    model = piece_model(vocabulary)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return Side(
        tuple(
            bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(BLANK, " ").encode()
            for i, name in enumerate(names)
        )
    )


@lru_cache(maxsize=2)
def identity_map(a: Vocabulary, b: Vocabulary) -> np.ndarray:
    """For every id of A the id of B with the same bytes, else -1. A piece comes before a single byte's fallback, whose
    ids are smaller."""
    found = {token: i for i, token in enumerate(piece_side(b).tokens) if token}
    return np.array([found.get(token, -1) if token else -1 for token in byte_side(a).tokens], np.int64)


@lru_cache(maxsize=2)
def labels(a: Vocabulary, b: Vocabulary) -> tuple[list[str], int, int]:
    """Every id with the sign that follows it: A's before another of A or before B's, B's before another or at a group's
    end. Places of A's second list and of B's first in it are given; B's second follows."""
    n, m = len(byte_side(a).tokens), len(piece_side(b).tokens)
    signs = [f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + [f"{i}," for i in range(m)] + [f"{i};" for i in range(m)]
    return signs, n, m


@lru_cache(maxsize=2)
def begin_anew(a: Vocabulary, b: Vocabulary) -> bool:
    """Whether both sides treat the text before a blank that follows a word and the rest apart."""
    made = json.loads(a.raw)
    splits = made["pre_tokenizer"] or {}
    apart = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
    return bool(apart and made["normalizer"] is None and divisible(b))


def encoded(a: Vocabulary, b: Vocabulary, texts: list[str]) -> list[tuple[list[np.ndarray], list[np.ndarray]] | None]:
    """For every text the ids of both tokenizers, part by part; None if there are no tokens."""
    cuts = [list(parts(" " + t, PART if begin_anew(a, b) else len(t) + 1)) if t else [] for t in texts]
    flat = [part for some in cuts for part in some]
    of_a = plain_ids(a, flat)
    of_b = piece_model(b).encode([part[1:] for part in flat], num_threads=1)
    bytes_a, bytes_b = byte_side(a).tokens, piece_side(b).tokens
    out, at = [], 0
    for some in cuts:
        ids_a, ids_b, whole = [], [], bool(some)
        for part in some:
            x, y, want = of_a[at], of_b[at], part.encode()
            whole = whole and b"".join(map(bytes_a.__getitem__, x)) == want == b"".join(map(bytes_b.__getitem__, y))
            ids_a.append(np.array(x, np.int64))
            ids_b.append(np.array(y, np.int64))
            at += 1
        out.append((ids_a, ids_b) if whole else None)
    return out


@dataclass
class Aligned:
    """Links of some texts' tokens, in order: ``a`` and ``b`` are their ids, ``text`` their text, ``identical`` whether
    their group is one token of each side with the map's ids. ``n_groups`` is by text, ``signs`` are the groups' parts in
    order (places in ``labels``) and ``sign_ends`` the texts' ends among them."""

    a: np.ndarray
    b: np.ndarray
    text: np.ndarray
    identical: np.ndarray
    n_groups: np.ndarray
    signs: np.ndarray
    sign_ends: np.ndarray


def aligned(a: Vocabulary, b: Vocabulary, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> Aligned:
    """Align texts, each given by its ids of both sides; a text's tokens cover the same bytes on both."""
    lengths_a, lengths_b, same = byte_side(a).lengths, piece_side(b).lengths, identity_map(a, b)
    _, n, m = labels(a, b)
    tokens_a, tokens_b = np.concatenate(ids_a), np.concatenate(ids_b)
    ends_a, ends_b = np.cumsum(lengths_a[tokens_a]), np.cumsum(lengths_b[tokens_b])
    text_ends = ends_a[np.cumsum([len(x) for x in ids_a]) - 1]
    # Ends of both sides end a group; the ends of either side cut the bytes into one piece per link.
    marks = np.zeros((2, int(text_ends[-1]) + 1), bool)
    marks[0, ends_a] = marks[1, ends_b] = True
    every = np.flatnonzero(marks[0] | marks[1])
    at_a, at_b = marks[0, every], marks[1, every]
    both = at_a & at_b
    # Tokens and groups before a link: the ends before its own.
    link_a, link_b = tokens_a[np.cumsum(at_a) - at_a], tokens_b[np.cumsum(at_b) - at_b]
    group = np.cumsum(both) - both
    group_a, group_b, last_a, last_b = group[at_a], group[at_b], both[at_a], both[at_b]
    size_a, size_b = np.bincount(group_a), np.bincount(group_b)
    identical = ((size_a == 1) & (size_b == 1))[group] & (same[link_a] == link_b)
    # A group's ids of A come first, then those of B: a token's place is its own number plus the other side's before it.
    through_a, before_b = np.cumsum(size_a), np.cumsum(size_b) - size_b
    signs = np.empty(len(tokens_a) + len(tokens_b), np.int64)
    signs[np.arange(len(tokens_a)) + before_b[group_a]] = tokens_a + np.where(last_a, n, 0)
    signs[np.arange(len(tokens_b)) + through_a[group_b]] = 2 * n + tokens_b + np.where(last_b, m, 0)
    links = np.searchsorted(every, text_ends, side="right")
    groups = np.diff(np.cumsum(both)[links - 1], prepend=0)
    text = np.repeat(np.arange(len(text_ends)), np.diff(links, prepend=0))
    sign_ends = np.cumsum([len(x) + len(y) for x, y in zip(ids_a, ids_b)])
    return Aligned(link_a, link_b, text, identical, groups, signs, sign_ends)


def summed(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums by text; ``text`` rises."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return np.diff(total[np.searchsorted(text, np.arange(n + 1))])


def fitting(x: np.ndarray) -> bytes:
    """Packed whole numbers of 4 bytes."""
    return pack(x.astype(np.uint32).tobytes(), 3)


def numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(unpack(blob), np.uint32)


ROWS = (
    "chunk long, docs binary, same binary, other binary, pairs array<long>, pair_counts array<long>, vector array<long>"
)
RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Alignment:
    """The alignment of all texts of ``docs`` by a byte-level vocabulary ``a`` and a piece vocabulary ``b``."""

    def __init__(self, docs: DataFrame, a: Vocabulary, b: Vocabulary, id_column: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, sent_pairs: int = SENT_PAIRS):
        self.spark = docs.sparkSession
        self.a, self.b, self.sent_pairs = a, b, sent_pairs
        self.size = len(piece_side(b).tokens)
        slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
        self.chunks = stored(slim.mapInArrow(lambda batches: chunk_rows(batches, a, b, chunk_bytes), ROWS), "aligned")
        self.totals = stored(self.counted(), "pairs")

    def counted(self) -> DataFrame:
        """(a, b, links, best) of all linked pairs of ids."""
        same = identity_map(self.a, self.b).tolist()
        vectors = self.chunks.where("vector is not null").select(F.posexplode("vector").alias("a", "links")).where("links > 0")
        by_id = vectors.groupBy("a").agg(F.sum("links").alias("links"))
        # One row per id of A, whatever the corpus.
        names = self.spark.createDataFrame(pa.table({"a": pa.array(range(len(same)), pa.int32()), "b": pa.array(same, pa.int64())}))
        regular = by_id.join(F.broadcast(names), "a").select((F.col("a").cast("long") * self.size + F.col("b")).alias("pair"), "links")
        listed = self.chunks.where("vector is null").select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p"))
        irregular = listed.select(F.col("p.pairs").alias("pair"), F.col("p.pair_counts").alias("links"))
        irregular = irregular.groupBy("pair").agg(F.sum("links").alias("links"))
        sums = stored(regular.unionByName(irregular).groupBy("pair").agg(F.sum("links").alias("links")), "sums")
        sums = sums.withColumns({"a": (F.expr(f"pair div {self.size}")), "b": F.col("pair") % self.size})
        most = sums.groupBy("b").agg(F.max("links").alias("most"))
        # One row per id of B, whatever the corpus.
        return sums.join(F.broadcast(most), "b").select("pair", "a", "b", "links", (F.col("links") == F.col("most")).alias("best"))

    def pairs(self) -> DataFrame:
        """(a, b, links, best) of every pair of ids that the corpus links."""
        return self.totals.select("a", "b", "links", "best")

    def best(self) -> DataFrame:
        """For every linked id of B the id of A it is linked with most often (the smallest of equal ones), with that
        number of links and all links of the id: a map to carry embeddings from one vocabulary to the other."""
        best = F.min(F.when(F.col("best"), F.col("a"))).alias("a")
        return self.totals.groupBy("b").agg(best, F.max("links").alias("links"), F.sum("links").alias("all_links"))

    def documents(self) -> DataFrame:
        """One row per document: tokens and groups, links, links whose pair is best, and the sum of their counts."""
        vector = np.zeros((2, len(byte_side(self.a).tokens)), np.int64)
        same = identity_map(self.a, self.b)
        names = self.spark.createDataFrame(pa.table({"pair": pa.array(np.flatnonzero(same >= 0) * self.size + same[same >= 0])}))
        for row in self.totals.join(F.broadcast(names), "pair", "left_semi").select("a", "links", "best").collect():
            vector[:, row["a"]] = row["links"], row["best"]
        chunks = self.chunks.where("vector is null").select("chunk", "docs", "same", "other", "pairs")
        if self.totals.count() <= self.sent_pairs:
            rows = self.totals.select("pair", "links", "best").toArrow().sort_by("pair")
            sent = [rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "links", "best")]
            shared = self.spark.sparkContext.broadcast((vector, *sent))

            def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                vector, pair, links, best = shared.value
                for batch in batches:
                    for docs, same, other, pairs in zip(*(batch.column(c) for c in ("docs", "same", "other", "pairs"))):
                        at = np.searchsorted(pair, pairs.values.to_numpy())
                        yield from weighed(docs.as_py(), same.as_py(), other.as_py(), links[at], best[at], vector)

            return chunks.mapInArrow(each, RESULT)
        asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
        answers = asked.join(self.totals.select("pair", "links", "best"), "pair").groupBy("chunk")
        answers = answers.agg(F.sort_array(F.collect_list(F.struct("place", "links", "best"))).alias("answers"))
        told = chunks.drop("pairs").join(answers, "chunk", "left")
        told = told.select("docs", "same", "other", F.col("answers.links").alias("links"), F.col("answers.best").alias("best"))
        shared = self.spark.sparkContext.broadcast(vector)

        def each_told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for docs, same, other, links, best in zip(*(batch.column(c) for c in ("docs", "same", "other", "links", "best"))):
                    counts = np.array(links.as_py() or [], np.int64), np.array(best.as_py() or [], bool)
                    yield from weighed(docs.as_py(), same.as_py(), other.as_py(), *counts, shared.value)

        return told.mapInArrow(each_told, RESULT)


def chunk_rows(batches: Iterable[pa.RecordBatch], a: Vocabulary, b: Vocabulary, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """A row for every chunk of the task's rows, and a last one with the task's vector of identity links."""
    shape = pa.schema(
        [
            ("chunk", pa.int64()),
            ("docs", pa.binary()),
            ("same", pa.binary()),
            ("other", pa.binary()),
            ("pairs", pa.list_(pa.int64())),
            ("pair_counts", pa.list_(pa.int64())),
            ("vector", pa.list_(pa.int64())),
        ]
    )
    chunk = TaskContext.get().partitionId() << 20
    vector = np.zeros(len(byte_side(a).tokens), np.int64)
    for batch in batches:
        for part in pieces(batch, "text", chunk_bytes) if batch.num_rows else ():
            docs, same, other, pairs, counts = chunk_of(part, a, b, vector)
            values = [[chunk], [docs], [same], [other], [pairs], [counts], [None]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, shape)], schema=shape)
            chunk += 1
    if vector.any():
        values = [[None]] * 6 + [[vector]]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, shape)], schema=shape)


def chunk_of(rows: pa.RecordBatch, a: Vocabulary, b: Vocabulary, vector: np.ndarray) -> tuple[bytes, bytes, bytes, np.ndarray, np.ndarray]:
    """Documents, identity links, other links, and the different pairs of the latter with their counts; identity links
    are added to ``vector``."""
    signs, size = labels(a, b)[0], len(piece_side(b).tokens)
    found = encoded(a, b, rows.column("text").to_pylist())
    n = len(found)
    n_a, n_b, n_groups, n_same, n_other = (np.zeros(n, np.int64) for _ in range(5))
    digests = [""] * n
    same, other = [], []
    whole = [i for i, x in enumerate(found) if x]
    if whole:
        # Every part of a long text is aligned like a text of its own.
        of = np.concatenate([np.full(len(found[i][0]), i) for i in whole])
        ids_a, ids_b = ([x for i in whole for x in found[i][side]] for side in (0, 1))
        links = aligned(a, b, ids_a, ids_b)
        text = of[links.text]
        np.add.at(n_a, of, [len(x) for x in ids_a])
        np.add.at(n_b, of, [len(x) for x in ids_b])
        np.add.at(n_groups, of, links.n_groups)
        n_same, n_other = summed(links.identical, text, n), summed(~links.identical, text, n)
        same, other = links.a[links.identical], links.a[~links.identical] * size + links.b[~links.identical]
        ends = links.sign_ends[np.searchsorted(of, whole, side="right") - 1]
        for i, start, end in zip(whole, np.concatenate(([0], ends[:-1])), ends):
            joined = "".join(map(signs.__getitem__, links.signs[start:end].tolist()))
            digests[i] = hashlib.sha256(joined[:-1].encode()).hexdigest()
        vector += np.bincount(same, minlength=len(vector))
    pairs, places, counts = np.unique(np.asarray(other, np.int64), return_inverse=True, return_counts=True)
    docs = pa.RecordBatch.from_pydict(
        {
            "id": rows.column("id"),
            "n_a": pa.array(n_a),
            "n_b": pa.array(n_b),
            "n_groups": pa.array(n_groups),
            "n_same": pa.array(n_same),
            "n_other": pa.array(n_other),
            "groups_sha256": pa.array(digests, pa.string()),
        }
    )
    return blob_of(docs), fitting(np.asarray(same, np.int64)), fitting(places), pairs, counts


def weighed(docs: bytes, same: bytes, other: bytes, links: np.ndarray, best: np.ndarray, vector: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk: ``links`` and ``best`` belong to its pairs, ``vector`` has both by ids of A."""
    rows, same, other = table_of(docs), numbers(same), numbers(other)
    n_same, n_other = rows.column("n_same").to_numpy(), rows.column("n_other").to_numpy()
    ends_same, ends_other = np.cumsum(n_same), np.cumsum(n_other)

    def by_text(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[ends], prepend=0)

    count = by_text(vector[0][same], ends_same) + by_text(links[other], ends_other)
    n_best = by_text(vector[1][same], ends_same) + by_text(best[other], ends_other)
    columns = {name: rows.column(name).combine_chunks() for name in ("id", "n_a", "n_b", "n_groups")}
    columns |= {"n_links": pa.array(n_same + n_other), "n_best": pa.array(n_best), "count_sum": pa.array(count)}
    columns["groups_sha256"] = rows.column("groups_sha256").combine_chunks()
    yield pa.RecordBatch.from_pydict(columns)
