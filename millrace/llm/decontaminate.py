"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of ASCII letters and digits and of non-ASCII characters, lower-cased (A-Z). A first pass counts the test
items' words in all documents. A word n-gram of an item is a rare seed if the frequencies of its words let one expect it
less than ``RARE`` times in a million words, or if it is among the rarer half of its item's; so a test item that was copied
very often does not become common by that. A second pass looks the seeds up in every document; around each place where one
stands the document's words that could align with the item (overlapping places are one) are aligned with it word by
word (match 2, mismatch -1, gap -1), many at once. The score is the best local alignment as a share of what the whole item
would reach, so replaced, left out and put in words lower it a little and chance matches hardly count.

The items' n-grams are sent to the tasks in slices of at most ``SLICE_WORDS`` words; a larger benchmark takes one pass
over the documents for each slice. Everything else is spread over the documents.

Defined results: null or empty texts and items without words match nothing; an item of fewer words than an n-gram
is looked up as a whole; rows with equal ids give one result with the best score, rows with a null id are results
of a null id; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing as H
from millrace.llm.chunks import give_back, pieces, stored, text_bytes

#: Words of a seed.
SEED = 3
#: Words of test items that are sent to the tasks at once.
SLICE_WORDS = 2_000_000
#: Score from which a document counts as contaminated.
LEAST = 0.4
#: Expected places in a million words up to which an n-gram is rare.
RARE = 0.05
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of text worked on at once, and cells of alignments.
STEP = 2 << 20
CELLS = 1 << 20
#: Windows that are aligned at once.
WINDOWS = 4096
#: Keys of matching rows (8 bytes each) that are sent to all tasks.
SENT_KEYS = 1 << 20

#: Bytes between words.
BREAK = np.ones(256, bool)
BREAK[48:58] = BREAK[65:91] = BREAK[97:123] = BREAK[128:] = False


def word_lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words before each text."""
    data, bounds = text_bytes(column)
    data = H.looked_up(H.LOWER, data)
    starts, ends, first = H.words_of(data, bounds, BREAK)
    return H.word_hashes(data, starts, ends), first


def grams(words: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """The n-gram from every word on; one that reaches over the end of its text has the text's own last part."""
    chains = H.chain(np.concatenate((words, np.zeros(k - 1, np.uint64))), k)
    for low, high in zip(first, first[1:]):
        if 0 < high - low < k:
            chains[low] = H.chain(words[low:high], high - low)[0]
    return chains


class Items:
    """Test items' words and n-grams, made on the driver for one slice."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids = ids
        self.words, self.first = word_lists(pa.array(texts, pa.string()))
        sizes = np.diff(self.first)
        chains = grams(self.words, self.first, SEED)
        item = np.repeat(np.arange(len(ids)), sizes)
        place = np.arange(len(self.words)) - self.first[item]
        real = (place + SEED <= sizes[item]) | (place == 0)
        order = np.argsort(chains[real], kind="stable")
        self.vocabulary, self.word = np.unique(self.words, return_inverse=True)
        self.look_up(chains[real][order], item[real][order], place[real][order])

    def look_up(self, gram: np.ndarray, item: np.ndarray, place: np.ndarray) -> None:
        """The n-grams that are looked for, sorted."""
        self.gram, self.item, self.place = gram, item, place
        self.distinct, self.begin = np.unique(gram, return_index=True)
        self.stop = np.append(self.begin[1:], len(gram))
        self.table = np.zeros(1 << 22, bool)
        self.table[(self.distinct >> np.uint64(42)).astype(np.int64)] = True

    def keep_rare(self, counts: np.ndarray, total: int) -> None:
        """Look for the rare n-grams only, by the counts of the items' words among ``total`` words."""
        expected = self.expected(counts, total)
        order = np.lexsort((expected, self.item))
        sizes = np.bincount(self.item, minlength=len(self.ids))
        begins = np.cumsum(sizes) - sizes
        # The median of each item's n-grams; one without any has none to keep.
        low, high = begins + np.maximum(sizes - 1, 0) // 2, begins + sizes // 2
        ordered = np.append(expected[order], 0.0)
        middle = (ordered[np.minimum(low, len(expected))] + ordered[np.minimum(high, len(expected))]) / 2
        rare = (expected <= RARE) | (expected <= middle[self.item])
        self.look_up(self.gram[rare], self.item[rare], self.place[rare])

    def expected(self, counts: np.ndarray, total: int) -> np.ndarray:
        """Of each n-gram, by the frequencies of its words: places in a million words."""
        share = np.log(np.maximum(counts, 1) / max(total, 1))[self.word]
        sums = np.concatenate(([0.0], np.cumsum(share)))
        start = self.first[self.item] + self.place
        return 1e6 * np.exp(sums[np.minimum(start + SEED, self.first[self.item + 1])] - sums[start])

    def hits(self, chains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``chains`` of known n-grams, and the number of each one."""
        at = np.flatnonzero(self.table[(chains >> np.uint64(42)).astype(np.int64)])
        if not len(at) or not len(self.distinct):
            return at[:0], at[:0]
        found = np.minimum(np.searchsorted(self.distinct, chains[at]), len(self.distinct) - 1)
        ok = self.distinct[found] == chains[at]
        return at[ok], found[ok]


def windows(items: Items, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Text, item, seeds and words of every place where an item may stand."""
    at, gram = items.hits(grams(words, first, SEED))
    text = np.searchsorted(first, at, side="right") - 1
    small = np.diff(first)[text] < SEED  # the whole of a short text is its only n-gram
    ok = (at + SEED <= first[text + 1]) | (small & (at == first[text]))
    at, gram, text = at[ok], gram[ok], text[ok]
    count = items.stop[gram] - items.begin[gram]
    each = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(items.begin[gram], count)
    at, gram, text = (np.repeat(x, count) for x in (at, gram, text))
    item, place = items.item[each], items.place[each]
    size = np.diff(items.first)[item]
    slack = size // 4 + 5
    low = np.maximum(at - place - slack, first[text])
    high = np.minimum(at - place + size + slack, first[text + 1])
    order = np.lexsort((low, item, text))
    text, item, low, high, gram = (x[order] for x in (text, item, low, high, gram))
    k = 0
    while k < len(text):
        end, stop = k + 1, high[k]
        while end < len(text) and text[end] == text[k] and item[end] == item[k] and low[end] <= stop:
            stop = max(stop, high[end])
            end += 1
        yield int(text[k]), int(item[k]), np.unique(gram[k:end]), words[low[k] : stop]
        k = end


def align(items: list[np.ndarray], parts: list[np.ndarray]) -> np.ndarray:
    """Best local alignment scores of pairs of word lists, all at once."""
    m, n = max(map(len, items)), max(map(len, parts))
    a = np.zeros((len(items), m), np.uint64)
    b = np.ones((len(parts), n), np.uint64)  # 0 and 1 stand for no word and match nothing
    for i, (x, y) in enumerate(zip(items, parts)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    row = np.zeros((len(items), n + 1), np.int32)
    best = np.zeros(len(items), np.int32)
    ramp = -GAP * np.arange(n + 1, dtype=np.int32)
    for i in range(m):
        new = np.zeros_like(row)
        same = a[:, i : i + 1] == b
        new[:, 1:] = np.maximum(row[:, :-1] + np.where(same, MATCH, MISMATCH), row[:, 1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + ramp, axis=1) - ramp  # gaps along the part
        np.maximum(best, row.max(axis=1), out=best)
    return best


def aligned(items: Items, item: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """The share of each item's full score that its part reaches."""
    out = np.zeros(len(item))
    sizes = np.diff(items.first)[item]
    order = np.argsort([len(p) for p in parts], kind="stable")
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(parts[order[stop]]) <= CELLS // 8:
            stop += 1
        own = order[at:stop]
        texts = [items.words[items.first[i] : items.first[i + 1]] for i in item[own]]
        out[own] = align(texts, [parts[i] for i in own]) / (MATCH * sizes[own])
        at = stop
    return out


RESULT = "row_id long, row_key long, item_id long, score double, n_seeds int"


def word_counts(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """How often each of the items' words stands in all documents, and the number of all words."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, np.zeros(len(items.vocabulary), np.int64)
        for batch in batches:
            for part in pieces(batch, "text", STEP) if batch.num_rows else ():
                words, _ = word_lists(part.column("text"))
                total += len(words)
                if len(seen):
                    found, n = np.unique(words, return_counts=True)
                    at = np.minimum(np.searchsorted(items.vocabulary, found), len(seen) - 1)
                    ok = items.vocabulary[at] == found
                    seen[at[ok]] += n[ok]
                give_back()
        number = np.append(np.flatnonzero(seen), -1)
        yield pa.RecordBatch.from_pydict({"word": pa.array(number), "n": pa.array(np.append(seen[seen > 0], total))})

    # At most one row for each word of the slice.
    found = dict(docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n")).collect())
    return np.array([found.get(i, 0) for i in range(len(items.vocabulary))], np.int64), found.get(-1, 0)


def slice_matches(docs: DataFrame, items: Items, least: float) -> DataFrame:
    """Documents (id, key) and items of one slice that match. The items' words are counted first, so that only rare
    n-grams are looked for and a common one, in however many items and documents it stands, makes no window."""
    items.keep_rare(*word_counts(docs, items))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP) if batch.num_rows else ():
                words, first = word_lists(part.column("text"))
                found = windows(items, words, first)
                while rows := list(islice(found, WINDOWS)):
                    text = pa.array([r[0] for r in rows], pa.int64())
                    scores = aligned(items, np.array([r[1] for r in rows]), [r[3] for r in rows])
                    out = pa.RecordBatch.from_pydict(
                        {
                            "row_id": part.column("row_id").take(text),
                            "row_key": part.column("row_key").take(text),
                            "item_id": pa.array([items.ids[r[1]] for r in rows], pa.int64()),
                            "score": pa.array(scores),
                            "n_seeds": pa.array([len(r[2]) for r in rows], pa.int32()),
                        }
                    )
                    yield out.filter(pa.array(scores >= least))
                give_back()

    return docs.mapInArrow(find, RESULT)


def row_key(id_column: str, text: str) -> Column:
    """The same for rows of equal id and text."""
    return F.xxhash64(F.col(id_column), F.col(text))


def matches(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: float = LEAST) -> DataFrame:
    """Rows row_id, row_key, item_id, score, n_seeds of every place where a document matches a test item."""
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    # No item has more words than half its bytes, rounded up.
    total = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    slices = max(1, int(total // SLICE_WORDS) + 1)
    rows = docs.select(F.col(id_column).cast("long").alias("row_id"), row_key(id_column, text).alias("row_key"), F.col(text).alias("text"))
    parts = []
    for k in range(slices):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == k).distinct().collect()
        own.sort(key=lambda r: (r.id is None, r.id, r.text or ""))
        parts.append(slice_matches(rows, Items([r.id for r in own], [r.text for r in own]), least))
    return reduce(DataFrame.unionByName, parts)


def contaminated(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """doc_id, item_id, score and n_seeds of the best place of every document and item that match."""
    best = matches(docs, benchmark, **names).groupBy("row_id", "item_id")
    return best.agg(F.max("score").alias("score"), F.max("n_seeds").alias("n_seeds")).withColumnRenamed("row_id", "doc_id")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``docs`` without the rows that match a test item. Up to ``SENT_KEYS`` keys of such rows go to all tasks, so that no
    text is shuffled; more are joined."""
    name = f"_{uuid.uuid4().hex}"
    found = matches(docs, benchmark, id_column=id_column, text=text, **names)
    bad = stored(found.select(F.col("row_key").alias(name)).distinct(), "matched")
    bad = F.broadcast(bad) if bad.count() <= SENT_KEYS else bad
    return docs.join(bad, row_key(id_column, text) == F.col(name), "left_anti")
