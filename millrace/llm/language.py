"""Language identification of mixed-language text.

Words get a score for every language: the sum over their byte trigrams (with a blank on either side) of the logarithm
of the trigram's smoothed share in the language. Scripts narrow the candidates: letters are counted by ranges of
code points, and a language in whose training text a script is (almost) absent pays for each word in that script.
A Viterbi pass over the words of a text, with a penalty for each switch of language, labels spans; the language with
most letters is the text's, and the score is its share of the letters.

The model is fitted on a bounded sample of different texts per language (``SAMPLE_ROWS``), chosen by their hash;
its size depends only on ``BIN_BITS`` and the number of languages, all of which are learnt. It is sent to the
tasks whole, ``4 << BIN_BITS`` bytes for each language. All rows are
predicted, over their whole texts.

Defined results: null text, and text without a letter, is ``und`` with score 0; a model without any training row
says ``und`` for all. Equal scores go to the language that is first in order. Only the text is an input of a
prediction; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import hashing as H
from millrace.llm.chunks import pieces, text_bytes

#: Training rows of each language at most, all of different texts, taken in order of a hash of their text.
SAMPLE_ROWS = 1000
#: Bins of trigrams, as a power of two.
BIN_BITS = 16
#: Cost of a switch of language between two words, in natural logarithms.
SWITCH = 8.0
#: Cost of a word in a script that the language is not written in.
FOREIGN = 30.0
#: A script is foreign to a language with less than this share of its letters.
RARE = 0.001
#: Words in a block of the Viterbi pass, and languages up to which blocks are solved for every pair of labels.
BLOCK = 64
PAIRS = 64
#: Bytes of text worked on at once.
STEP = 1 << 20

# First code points of Unicode ranges and the script of the letters from there on.
SCRIPTS = ["other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian", "hangul", "kana", "han"]
RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"),
]
STARTS = np.array([start for start, _ in RANGES])
SCRIPT_OF = np.array([SCRIPTS.index(name) for _, name in RANGES], np.int8)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


@dataclass
class Text:
    """Words of texts with their trigram bins and scripts."""

    first: np.ndarray  # word before each text
    letters: np.ndarray  # letters of each word
    script: np.ndarray  # script of most letters of each word
    bins: np.ndarray  # trigram bins, word after word
    at: np.ndarray  # first bin of each word


def read(data: np.ndarray, bounds: np.ndarray) -> Text:
    """Words are runs without ASCII white space, lower-cased (A-Z)."""
    data = H.LOWER[data]
    starts, ends, first = H.words_of(data, bounds)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[lead].astype(np.int32)
    padded = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int32) & 0x3F
    for low, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        at = np.flatnonzero((data[lead] >= low) & (data[lead] < (0xE0, 0xF0, 0xF8)[more - 1]))
        value = code[at] & mask
        for k in range(1, more + 1):
            value = (value << 6) | padded[lead[at] + k]
        code[at] = value
    code[code >= 0x110000] = 0
    letter = letters()[code]
    script = SCRIPT_OF[np.searchsorted(STARTS, code[letter], side="right") - 1]
    word = np.searchsorted(starts, lead[letter], side="right") - 1
    n = len(starts)
    counts = np.bincount(word * len(SCRIPTS) + script, minlength=n * len(SCRIPTS)).reshape(n, len(SCRIPTS))
    sizes = ends - starts
    # Each word with a blank on either side, one after the other; its trigrams start at each of its bytes.
    at = np.concatenate(([0], np.cumsum(sizes + 2)))
    line = np.full(int(at[-1]) + 2, 32, np.uint32)
    where = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    line[np.repeat(at[:-1] + 1, sizes) + where] = data[np.repeat(starts, sizes) + where]
    gram = (line[:-2] << 16) | (line[1:-1] << 8) | line[2:]
    bins = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BIN_BITS)).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    return Text(first, counts.sum(axis=1), counts.argmax(axis=1), bins[np.repeat(at[:-1], sizes) + where], begin)


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # bins by languages
    foreign: np.ndarray  # scripts by languages

    def word_scores(self, text: Text) -> np.ndarray:
        if not len(text.at):
            return np.zeros((0, len(self.languages)), np.float32)
        scores = np.add.reduceat(self.logs[text.bins], text.at, axis=0)
        scores[text.letters == 0] = 0
        return scores - self.foreign[text.script] * (text.letters > 0)[:, None]


def best_path(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The label of every word: the best sum of scores less ``switch`` for each change, text by text.

    Blocks of words are solved side by side for every pair of first and last label, then the blocks of a text one
    after the other, then the labels within all blocks side by side again."""
    n, k = scores.shape
    if k > PAIRS:
        return path_by_words(scores, first, switch)
    sizes = np.diff(first)
    blocks = -(-sizes // BLOCK)
    before = np.concatenate(([0], np.cumsum(blocks)))
    text = np.repeat(np.arange(len(sizes)), blocks)
    start = first[text] + (np.arange(before[-1]) - before[text]) * BLOCK
    size = np.minimum(BLOCK, first[text + 1] - start)
    change = np.where(np.eye(k, dtype=bool), 0, -switch).astype(np.float32)
    # best[b, i, j]: from label i before block b to label j at its end
    best = np.broadcast_to(np.where(np.eye(k, dtype=bool), 0, -np.inf).astype(np.float32), (len(start), k, k)).copy()
    for step in range(BLOCK):
        live = np.flatnonzero(size > step)
        if not len(live):
            break
        old = best[live]
        moved = np.maximum(old, old.max(axis=2, keepdims=True) - np.float32(switch))
        best[live] = moved + scores[start[live] + step][:, None, :]
    total = np.zeros((len(sizes), k), np.float64)
    came = np.zeros((len(start), k), np.int16)
    for step in range(int(blocks.max(initial=0))):
        live = np.flatnonzero(blocks > step)
        b = before[live] + step
        ways = total[live][:, :, None] + best[b]
        came[b] = ways.argmax(axis=1)
        total[live] = ways.max(axis=1)
        total[live] -= total[live].max(axis=1, keepdims=True)
    last = np.zeros(len(start), np.int16)
    label = total.argmax(axis=1).astype(np.int16)
    entry = np.zeros(len(start), np.int16)
    for step in range(int(blocks.max(initial=0)) - 1, -1, -1):
        live = np.flatnonzero(blocks > step)
        b = before[live] + step
        last[b] = label[live]
        entry[b] = came[b, label[live]]
        label[live] = entry[b]
    # Within the blocks: scores from the entry label on, then back from the last label.
    own = np.where(np.arange(k)[None, :] == entry[:, None], 0, -np.inf).astype(np.float32)
    stay = np.zeros((BLOCK, len(start), k), np.int8 if k < 128 else np.int16)
    for step in range(min(BLOCK, int(size.max(initial=0)))):
        live = np.flatnonzero(size > step)
        old = own[live]
        top = old.argmax(axis=1)
        jump = old.max(axis=1, keepdims=True) - np.float32(switch)
        stay[step, live] = np.where(old >= jump, np.arange(k)[None, :], top[:, None])
        own[live] = np.maximum(old, jump) + scores[start[live] + step]
    out = np.zeros(n, np.int16)
    at = last.copy()
    for step in range(min(BLOCK, int(size.max(initial=0))) - 1, -1, -1):
        live = np.flatnonzero(size > step)
        out[start[live] + step] = at[live]
        at[live] = stay[step, live, at[live]]
    return out


def path_by_words(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """``best_path`` for many languages: word after word, all texts and labels side by side."""
    n, k = scores.shape
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    start, size = first[:-1][order], sizes[order]
    live = [int(np.searchsorted(-size, -step)) for step in range(int(size.max(initial=0)))]  # texts of more words
    total = np.zeros((len(size), k))
    stay, top = np.zeros((n, k), bool), np.zeros(n, np.int32)
    for step, m in enumerate(live):
        at, old = start[:m] + step, total[:m]
        jump = old.max(axis=1, keepdims=True) - switch
        stay[at], top[at] = old >= jump, old.argmax(axis=1)
        total[:m] = np.maximum(old, jump) - jump + scores[at]
    out = np.zeros(n, np.int32)
    label = total.argmax(axis=1)
    for step in range(len(live) - 1, -1, -1):
        m = live[step]
        at, own = start[:m] + step, label[:m]
        out[at] = own
        label[:m] = np.where(stay[at, own], own, top[at])
    return out


def sampled(used: DataFrame) -> tuple[list[str], DataFrame]:
    """The languages, and ``SAMPLE_ROWS`` different texts of each, or all of them if there are fewer."""
    order = F.xxhash64(F.lit("sample"), "text")
    texts = used.select("lang", order.alias("order")).groupBy("lang", "order").agg(F.lit(1).alias("one"))
    sizes = texts.groupBy("lang").agg(F.count("*").alias("n")).collect()
    share = {r.lang: min(1.0, 2.0 * SAMPLE_ROWS / r.n) for r in sizes}
    # About twice the wanted texts by a hash of them, of which the first ones in its order stay.
    low, high = -(1 << 63), (1 << 63) - 1
    bounds = [x for lang, part in share.items() for x in (F.lit(lang), F.lit(high if part == 1 else int((2 * part - 1) * high)))]
    bound = F.coalesce(F.create_map(*bounds)[F.col("lang")] if bounds else F.lit(None), F.lit(low))
    picked = used.withColumn("order", order).where(F.col("order") <= bound)
    once = picked.groupBy("lang", "order").agg(F.min("text").alias("text"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
    return sorted(share), ranked.where(F.col("rank") <= SAMPLE_ROWS).select("lang", "text")


def fit(docs: DataFrame, language: str, text: str, bins: int = 1 << BIN_BITS) -> Model:
    """The model of the rows of ``docs``: a bounded sample of each language's texts, counted in tasks."""
    used = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(
        F.col(language).cast("string").alias("lang"), F.col(text).alias("text")
    )
    languages, sample = sampled(used)
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP):
                data, bounds = text_bytes(part.column("text"))
                read_ = read(data, bounds)
                name = np.array([number[x] for x in part.column("lang").to_pylist()])
                word = np.repeat(name, np.diff(read_.first))
                sizes = np.diff(np.append(read_.at, len(read_.bins)))
                kept = read_.letters > 0
                grams = np.repeat(np.where(kept, word, -1), sizes)
                keys, n = np.unique(grams[grams >= 0] * bins + read_.bins[grams >= 0], return_counts=True)
                scripts = np.bincount(word * len(SCRIPTS) + read_.script, weights=read_.letters, minlength=1)
                found = np.flatnonzero(scripts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(np.concatenate((keys, -1 - found)), pa.int64()),
                        "n": pa.array(np.concatenate((n, scripts[found].astype(np.int64))), pa.int64()),
                    }
                )

    counts = np.zeros((bins, len(languages)), np.float32)
    scripts = np.zeros((len(languages), len(SCRIPTS)))
    if languages:
        rows = sample.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        key, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
        counts[key[key >= 0] % bins, key[key >= 0] // bins] = n[key >= 0]
        scripts[(-1 - key[key < 0]) // len(SCRIPTS), (-1 - key[key < 0]) % len(SCRIPTS)] = n[key < 0]
    counts += np.float32(0.5)
    every = counts.sum(axis=0, dtype=np.float64)
    logs = np.log(counts, out=counts)
    logs -= np.log(every).astype(np.float32)
    rare = scripts < RARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, logs, (rare.T * FOREIGN).astype(np.float32))


def labelled(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[Text, np.ndarray]:
    text = read(data, bounds)
    return text, best_path(model.word_scores(text), text.first, SWITCH)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_spans``: from word, to word, language of each span."""
    names = pa.array(model.languages, pa.string())
    step = STEP * PAIRS // max(PAIRS, len(model.languages))  # scores are words by languages

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text, step) if batch.num_rows else ():
                yield finished(part)

    def finished(part: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = text_bytes(part.column(text))
        n, k = part.num_rows, max(len(model.languages), 1)
        pred, score = [None] * n, np.zeros(n)
        spans: pa.Array = pa.array([[] for _ in range(n)], SPANS)
        if model.languages:
            found, label = labelled(model, data, bounds)
            doc = np.repeat(np.arange(n), np.diff(found.first))
            by = np.bincount(doc * k + label, weights=found.letters, minlength=n * k).reshape(n, k)
            total = by.sum(axis=1)
            best = by.argmax(axis=1)
            score = np.where(total > 0, by.max(axis=1) / np.maximum(total, 1), 0.0)
            pred = [model.languages[b] if t else None for b, t in zip(best, total)]
            new = np.ones(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            values = pa.StructArray.from_arrays(
                [
                    pa.array(at - found.first[doc[at]], pa.int32()),
                    pa.array(np.append(at[1:], len(label)) - found.first[doc[at]], pa.int32()),
                    names.take(pa.array(label[at], pa.int32())),
                ],
                ["first", "stop", "lang"],
            )
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[at], np.arange(n + 1)), pa.int32()), values)
        columns = [*part.columns, pa.array([p or "und" for p in pred], pa.string()), pa.array(score), spans]
        return pa.RecordBatch.from_arrays(columns, [*part.schema.names, "lang_pred", "lang_score", "lang_spans"])

    fields = [f for f in docs.schema if f.name not in ("lang_pred", "lang_score", "lang_spans")]
    schema = type(docs.schema)(list(fields)).add("lang_pred", T.StringType()).add("lang_score", T.DoubleType())
    span = T.StructType().add("first", T.IntegerType()).add("stop", T.IntegerType()).add("lang", T.StringType())
    schema = schema.add("lang_spans", T.ArrayType(span))
    return docs.select(*[F.col(f"`{f.name}`") for f in fields]).mapInArrow(each, schema)


SPANS = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))


def identify(docs: DataFrame, trains: Column, language: str = "lang", text: str = "text") -> DataFrame:
    """``predict`` with a model fitted on the rows where ``trains`` is true."""
    return predict(docs, fit(docs.where(trains), language, text), text)
