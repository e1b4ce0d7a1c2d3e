"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text's pieces come from the vocabulary of a SentencePiece model. A word is a blank with the letters up to the next
blank (pieces reach over no blank but those that stand for runs of blanks, which are not used). All segmentations of
a word form a lattice whose paths have the product of their pieces' weights; a path is drawn by forward filtering
(the weight of all ways to each place) and backward sampling (from the end, a piece in proportion to its share). The
random numbers are a hash of the seed, the row's key and the piece's end in the text, so a row has the same
segmentation wherever and whenever it is encoded.

The weight of a piece is ``(1 + rank) ** -sharpness`` with the rank that a BPE model's score gives it (a unigram
model's score is taken as a logarithm), so that long and common pieces are preferred as the model's merges would. What
no piece covers is coded in byte pieces, and so is the blank's own sign where it stands in a text: decoding gives
back every text, byte for byte.

Long words, as in text without blanks, are cut at every character that no piece reaches over: all ways meet there, so
the parts are drawn apart. Everything is done for many words at once: a trie finds the pieces at every place, places
at equal distance from their word's start are filtered together, and all words are sampled together from their ends.

Defined results: null stays null and an empty text has no pieces; a null key counts as a key of its own; equal
rows have equal pieces; other columns, whatever their names, stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import hashing as H
from millrace.llm.chunks import give_back, text_bytes
from millrace.llm.chunks import pieces as batches_of

#: Bytes of text worked on at once.
STEP = 1 << 19
#: Bytes of a word from which it is cut where no piece reaches over.
LONG = 64
#: The blank's sign in a vocabulary.
BLANK = "▁"
#: Bytes of the character that a byte begins.
WIDTHS = np.repeat(np.array([1, 2, 3, 4], np.uint8), [128, 96, 16, 16])
#: Bytes from a word's start up to which a place counts as near.
NEAR = 64


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of every piece that is used (empty: not used), logarithm of its weight, and the ids of the 256 bytes."""

    pieces: tuple[bytes, ...]
    logs: tuple[float, ...]
    bytes_: tuple[int, ...]

    @staticmethod
    def read(path: str, sharpness: float = 1.0) -> Vocabulary:
        """From a model file that the driver can read; it is small and goes to the tasks as a value."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        normal = [not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)) for i in ids]
        names = [model.id_to_piece(i) for i in ids]
        used = [ok and BLANK not in name[1:] for ok, name in zip(normal, names)]
        pieces = [name.replace(BLANK, " ").encode() if ok else b"" for ok, name in zip(used, names)]
        scores = np.array([model.get_score(i) for i in ids])
        ranked = bool((scores == np.round(scores)).all())
        logs = -sharpness * np.log1p(np.maximum(-scores, 0)) if ranked else sharpness * scores
        found = {int(names[i][3:5], 16): i for i in ids if model.is_byte(i)}
        if len(found) < 256:
            raise ValueError("the vocabulary has no piece for every byte, so texts could not be given back")
        worst = float(min(log for log, ok in zip(logs, used) if ok)) - 1.0
        logs = [worst if model.is_byte(i) else float(logs[i]) for i in ids]
        return Vocabulary(tuple(pieces), tuple(logs), tuple(found[b] for b in range(256)))


class Tables:
    """The vocabulary's pieces and their prefixes as a trie, whose steps (a node and the next byte) are hashed."""

    def __init__(self, vocabulary: Vocabulary):
        self.logs = np.array(vocabulary.logs)
        self.bytes_ = np.array(vocabulary.bytes_, np.int32)
        spelt = list(vocabulary.pieces)
        for value, i in enumerate(vocabulary.bytes_):
            spelt[i] = bytes([value])
        self.size = np.array([len(p) for p in spelt])
        self.at = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        self.flat = np.frombuffer(b"".join(spelt), np.uint8)
        known: dict[bytes, int] = {}
        for i, piece in enumerate(vocabulary.pieces):
            for k in range(1, len(piece)):
                known.setdefault(piece[:k], -1)
            if piece:
                known[piece] = i
        names = sorted(known)
        node = {name: i for i, name in enumerate(names)}
        self.none = len(names)  # the node of what is not known
        self.longest = max(map(len, names), default=1)
        self.ids = np.array([*(known[name] for name in names), -1], np.int32)
        deep = [name for name in names if len(name) > 1]
        parents = np.array([node[name[:-1]] for name in deep], np.int32)
        self.inner = np.zeros(self.none + 1, bool)  # nodes with a next step
        self.inner[parents] = True
        self.first = np.array([node.get(bytes([b]), self.none) for b in range(256)], np.int32)
        self.steps = np.full(self.none + 1, -1, np.int64)
        places = np.array([node[name] for name in deep], np.int32)
        self.steps[places] = step_of(parents, np.array([name[-1] for name in deep], np.uint8))
        # A step that finds its slot taken goes to the next free one.
        self.bits = (4 * self.none).bit_length()
        self.slots = np.full(1 << self.bits, self.none, np.int32)
        slot = self.slot(self.steps[places])
        while len(places):
            free = self.slots[slot] == self.none
            self.slots[slot[free]] = places[free]
            left = self.slots[slot] != places
            places, slot = places[left], self.after(slot[left])

    def slot(self, steps: np.ndarray) -> np.ndarray:
        return ((steps.astype(np.uint64) * np.uint64(H.BASE)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def after(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def below(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The node that each node's step with a byte leads to, or ``none``."""
        steps = step_of(nodes, bytes_)
        slot = self.slot(steps)
        out = self.slots[slot]
        open_ = np.flatnonzero((self.steps[out] != steps) & (out != self.none))
        while len(open_):
            slot[open_] = self.after(slot[open_])
            out[open_] = self.slots[slot[open_]]
            open_ = open_[(self.steps[out[open_]] != steps[open_]) & (out[open_] != self.none)]
        return out

    def inside(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each size of pieces with the places inside words where one of that size starts, and its id. Every place
        begins one piece of a size at most."""
        at = np.arange(len(words))
        room = np.repeat(first[1:], np.diff(first)) - at
        nodes = self.first[words]
        for k in range(1, self.longest + 1):
            ids = self.ids[nodes]
            hit = np.flatnonzero(ids >= 0)
            yield k, at[hit], ids[hit]
            on = np.flatnonzero(self.inner[nodes] & (room > k))
            if not len(on):
                return
            at, room = at[on], room[on]
            nodes = self.below(nodes[on], words[at + k])


def step_of(nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
    return nodes.astype(np.int64) << 8 | bytes_


@lru_cache(maxsize=2)
def tables(vocabulary: Vocabulary) -> Tables:
    return Tables(vocabulary)


def words_in(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the words of all texts: a word starts at a blank, at a text's start, and around a line feed."""
    cut = data == 32
    line = data == 10
    cut |= line
    cut[1:] |= line[:-1]
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def segments(t: Tables, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the parts that are sampled apart: words, and within words of more than ``LONG`` bytes (text without
    blanks) every character that no piece reaches over. All ways through a word meet there, so nothing changes but
    that the longest part, whose bytes are taken step by step, stays short."""
    starts = words_in(data, bounds)
    sizes = np.diff(starts, append=len(data))
    long = sizes > LONG
    if not long.any():
        return starts
    first = np.concatenate(([0], np.cumsum(sizes[long])))
    place = np.arange(first[-1]) + np.repeat(starts[long] - first[:-1], sizes[long])
    inner = joints(t, data[place], first)
    return np.sort(np.concatenate((starts, place[inner])))


def joints(t: Tables, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places inside words, at the start of a character, that no piece reaches over."""
    over = np.zeros(len(words) + 1, np.int32)
    for k, piece, _ in t.inside(words, first):
        over[piece + 1] += 1
        over[piece + k] -= 1
    free = (np.cumsum(over[:-1]) == 0) & ((words & 0xC0) != 0x80)
    free[first[:-1]] = False
    return np.flatnonzero(free)


class Lattice:
    """All edges (pieces) between the places of distinct words, by their ends, with their shares by the forward sums.

    Words come longest first. Each has one place more than bytes, and places are numbered by their distance from the
    word's start, then by word: place ``base[distance] + word``. So the edges into all places of a distance are a run."""

    def __init__(self, t: Tables, words: np.ndarray, first: np.ndarray):
        n = len(words)
        sizes = np.diff(first)
        wide = len(sizes) - np.concatenate(([0], np.cumsum(np.bincount(sizes))))[:-1]  # words that reach a distance
        self.base = np.concatenate(([0], np.cumsum(wide)))
        distance = np.arange(n) - np.repeat(first[:-1], sizes)
        before = self.base[distance] + np.repeat(np.arange(len(sizes)), sizes)
        after = before + wide[distance]
        start, piece, size = [], [], []
        single = np.zeros(n, bool)  # the character that starts here is a piece
        width = H.looked_up(WIDTHS, words)
        for k, at, ids in t.inside(words, first):
            start.append(at)
            piece.append(ids)
            size.append(k)
            if k <= 4:
                single[at[width[at] == k]] = True
        # Bytes of characters that are no piece are pieces of one byte.
        lead = (words & 0xC0) != 0x80
        lead[first[:-1][first[:-1] < n]] = True
        covered = single if lead.all() else single[np.maximum.accumulate(np.where(lead, np.arange(n), 0))]
        alone = np.flatnonzero(~covered)
        start.append(alone)
        piece.append(t.bytes_[words[alone]])
        size.append(1)
        # In order of their ends, then of their starts: a place has one edge of each size at most.
        ends = [after[x + (k - 1)] for x, k in zip(start, size)]
        count = np.bincount(np.concatenate(ends), minlength=self.base[-1])
        self.edges = np.concatenate(([0], np.cumsum(count)))  # first edge into each place
        free = self.edges[:-1].copy()
        total = int(self.edges[-1])
        source, self.piece, self.size = np.empty(total, np.int64), np.empty(total, np.int32), np.empty(total, np.min_scalar_type(t.longest))
        for x, ids, k, end in sorted(zip(start, piece, size, ends), key=lambda e: -e[2]):
            at = free[end]
            free[end] = at + 1
            source[at], self.piece[at], self.size[at] = before[x], ids, k
        # The sums of each distance from those of the smaller ones, as logarithms. Near ones have many places: shares are
        # told to a place's largest first, so that each edge takes one exponential. Far ones have few, and take few calls.
        self.share = t.logs[self.piece]
        sums = np.full(self.base[-1], -np.inf)
        sums[: len(sizes)] = 0.0
        reached = np.flatnonzero(count)
        low, many = self.edges[reached], count[reached]
        cuts = np.searchsorted(reached, self.base[1:])
        runs = np.append(low, total)[cuts]
        near, far = cuts[: NEAR + 1][-1], runs[: NEAR + 1][-1]
        whole = np.empty(near)
        for i, j, begin, end in zip(cuts.tolist(), cuts[1:].tolist(), runs.tolist(), runs[1:].tolist()):
            if i == j:
                continue
            x = self.share[begin:end]
            x += sums[source[begin:end]]
            heads = low[i:j] - begin
            if i >= near:
                sums[reached[i:j]] = np.logaddexp.reduceat(x, heads)
                continue
            most = np.maximum.reduceat(x, heads)
            x -= np.repeat(most, many[i:j])
            np.exp(x, out=x)
            whole[i:j] = np.add.reduceat(x, heads)
            sums[reached[i:j]] = most + np.log(whole[i:j])
        self.share[:far] /= np.repeat(whole, many[:near])
        x = self.share[far:]
        x -= np.repeat(sums[reached[near:]], many[near:])
        np.exp(x, out=x)


def uniform(states: np.ndarray) -> np.ndarray:
    return (H.mix(states) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def sampled(t: Tables, data: np.ndarray, bounds: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts in order, and the number of pieces before each text."""
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    starts = segments(t, data, bounds)
    at = np.append(starts[1:], len(data))
    keys, example, of = np.unique(H.word_hashes(data, starts, at), return_index=True, return_inverse=True)
    left = at - starts
    order = np.argsort(-left[example], kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    word, example = rank[of], example[order]
    sizes = left[example]
    first = np.concatenate(([0], np.cumsum(sizes)))
    words = data[np.repeat(starts[example] - first[:-1], sizes) + np.arange(first[-1])]
    lattice = Lattice(t, words, first)
    # The state of a draw is the seed and the place in the text; from a word's end it goes back with the pieces.
    text = np.searchsorted(bounds, starts, side="right") - 1
    state = seeds[text] + (at - bounds[text]).astype(np.uint64) * np.uint64(H.BASE)
    out = np.full(len(data) + 1, -1, np.int32)
    while len(at):
        place = lattice.base[left] + word
        edge = lattice.edges[place]
        last = lattice.edges[place + 1] - 1
        draw = uniform(state)
        open_ = np.flatnonzero(edge < last)
        while len(open_):
            draw[open_] -= lattice.share[edge[open_]]
            open_ = open_[draw[open_] >= 0]
            edge[open_] += 1
            open_ = open_[edge[open_] < last[open_]]
        out[at] = lattice.piece[edge]
        back = lattice.size[edge]
        on = np.flatnonzero(left > back)
        back, word = back[on], word[on]
        at, left = at[on] - back, left[on] - back
        state = state[on] - back * np.uint64(H.BASE)
    found = np.flatnonzero(out >= 0)
    return out[found], np.searchsorted(found, bounds, side="right")


def seeds_of(keys: Iterable, seed: int) -> np.ndarray:
    digests = [hashlib.blake2b(repr(k).encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest() for k in keys]
    return np.frombuffer(b"".join(digests), np.uint64) if digests else np.zeros(0, np.uint64)


def spelt(t: Tables, pieces: np.ndarray) -> np.ndarray:
    """The bytes of pieces."""
    sizes = t.size[pieces]
    return t.flat[np.repeat(t.at[pieces] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """``docs`` with ``pieces``, the sampled piece ids of ``text`` (instead of any column of that name)."""
    kept = [f for f in docs.schema if f.name != "pieces"]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(vocabulary)
        for batch in batches:
            for part in batches_of(batch, text, STEP) if batch.num_rows else ():
                data, bounds = text_bytes(part.column(text))
                ids, first = sampled(t, data, bounds, seeds_of(part.column(key).to_pylist(), seed))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids), mask=part.column(text).is_null())
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "pieces"])
                give_back()

    schema = type(docs.schema)(list(kept)).add("pieces", T.ArrayType(T.IntegerType()))
    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(each, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ``pieces`` as column ``to`` (instead of any column of that name)."""
    kept = [f for f in encoded.schema if f.name != to]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(vocabulary)
        for batch in batches:
            ends = np.cumsum(pa.compute.list_value_length(batch.column("pieces")).fill_null(0).to_numpy())
            start = 0
            while start < batch.num_rows:  # rows with about STEP / 4 pieces at once
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + STEP // 4, side="right")))
                yield finished(t, batch.slice(start, stop - start))
                give_back()
                start = stop

    def finished(t: Tables, batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("pieces")
        ids = column.flatten().to_numpy(zero_copy_only=False)
        counts = pa.compute.list_value_length(column).fill_null(0).to_numpy()
        flat = spelt(t, ids)
        sizes = np.concatenate(([0], np.cumsum(t.size[ids])))
        at = sizes[np.concatenate(([0], np.cumsum(counts)))]
        texts = [None if null else flat[i:j].tobytes() for i, j, null in zip(at, at[1:], column.is_null().to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, to])

    schema = type(encoded.schema)(list(kept)).add(to, T.StringType())
    return encoded.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(each, schema)
