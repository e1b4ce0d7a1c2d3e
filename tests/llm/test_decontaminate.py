"""Decontamination: alignment against a plain one; exact, edited and clean documents."""

import random

import numpy as np
import pytest

from millrace.llm import decontaminate as D

SCHEMA = "doc_id long, text string, item int, row_id string, row_key string"


def plain(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (D.MATCH if x == y else D.MISMATCH), h[i - 1, j] + D.GAP, h[i, j - 1] + D.GAP)
    return h.max()


def test_align():
    rng = np.random.default_rng(1)
    items = [rng.integers(2, 6, rng.integers(1, 20)).astype(np.uint64) for _ in range(60)]
    parts = [rng.integers(2, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(60)]
    assert D.align(items, parts).tolist() == [plain(a, b) for a, b in zip(items, parts)]


def made():
    rng = random.Random(1)
    vocabulary = ["the", "of", "and"] + ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    text = lambda n: [rng.choice(vocabulary[:3] if rng.random() < 0.3 else vocabulary) for _ in range(n)]
    items = [(i, text(rng.randint(15, 50))) for i in range(12)] + [(50, ["Short"] * 2)]
    docs, want = [], set()
    for i, (item, words) in enumerate(items[:12]):
        docs.append((i, text(40) + [w.upper() + "," for w in words] + text(40)))
        edited = [w if rng.random() > 0.12 else "edited" for w in words if rng.random() > 0.05]
        docs.append((100 + i, text(200) + edited + text(3)))
        want |= {(i, item), (100 + i, item)}
        docs.append((200 + i, text(300)))
    docs.append((300, ["short", "short"]))
    want.add((300, 50))
    rows = [(i, " ".join(t), 1, "x", "y") for i, t in docs]
    rows += [(400, None, 0, "", ""), (401, "", None, None, None), (None, rows[0][1], 0, "", ""), rows[0], (402, "the of and " * 40_000, 0, "", "")]
    want.add((None, items[0][0]))
    return rows, [(i, " ".join(t)) for i, t in items] + [(60, None), (61, "")], want


@pytest.mark.parametrize("slice_words", [2_000_000, 100])
def test_contaminated(spark, monkeypatch, slice_words):
    monkeypatch.setattr(D, "SLICE_WORDS", slice_words)
    rows, items, want = made()
    docs, benchmark = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    if slice_words == 100:
        benchmark = benchmark.where("item_id < 3")
        want = {(d, i) for d, i in want if i < 3}
    got = D.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r.score == 1 for r in got if r.doc_id is not None and r.doc_id < 100)
    if slice_words > 100:
        left = D.decontaminate(docs, benchmark)
        assert left.schema == docs.schema
        bad = {d for d, _ in want}
        assert sorted(map(str, left.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id not in bad)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert D.contaminated(docs, items).collect() == []
    docs = spark.createDataFrame([(1, "a b c d", 0, "", "")], SCHEMA)
    assert D.contaminated(docs, items.where("item_id = 2")).collect() == []
    assert [r.doc_id for r in D.decontaminate(docs, items.where("item_id = 2")).collect()] == [1]


def test_generic_items_make_few_windows(spark, monkeypatch):
    """Items that all begin with the same words meet documents that have these words only by them: no table of all pairs,
    and none of them matches."""
    rng = random.Random(9)
    made_up = lambda: "".join(rng.choice("bcdfgklm") for _ in range(6))
    start = "which of the following is the"
    items = [(i, f"{start} {' '.join(made_up() for _ in range(8))}") for i in range(2000)]
    docs = [(i, f"{start} {made_up()} " * 3) for i in range(300)] + [(900, "so " * 50 + items[7][1] + " and on" * 20)]
    tests = D.Items([i for i, _ in items], [t for _, t in items])
    df, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(df, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in got] == [(900, 7, 1.0)]
    tests.keep_rare(*D.word_counts(df, tests))
    words, first = D.word_lists(D.pa.array([t for _, t in docs]))
    assert len(list(D.windows(tests, words, first))) < 50


def test_all_documents_and_items_by_loops(spark):
    """The whole operator against plain alignments of every document with every item: what is found scores as there, and
    every copy with up to a fifth of its words replaced is found."""
    rng = random.Random(12)
    vocabulary = [f"w{int(rng.paretovariate(0.4)) % 700}" for _ in range(3000)]
    items = [(i, rng.choices(vocabulary, k=rng.randint(20, 40))) for i in range(15)]
    docs, copies = [], set()
    for i in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 80))
        if i % 3 == 0:
            item, words = rng.choice(items)
            swapped = set(rng.sample(range(len(words)), len(words) // 5))
            body[len(body) // 2 : len(body) // 2] = [f"x{rng.random()}".replace(".", "") if k in swapped else w for k, w in enumerate(words)]
            copies.add((i, item))
        docs.append((i, body))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated(df, benchmark).collect()}
    numbers = {w: n for n, w in enumerate(sorted({w for _, t in [*docs, *items] for w in t}))}
    best = {
        (i, k): plain([numbers[w] for w in words], [numbers[w] for w in text]) / (2 * len(words))
        for i, text in docs
        for k, words in items
        if text
    }
    assert copies <= set(got)
    assert all(score <= best[pair] + 1e-9 and score >= D.LEAST for pair, score in got.items())
    assert all(abs(got[pair] - best[pair]) < 1e-9 for pair in copies)
    assert all(best[pair] < 0.6 for pair in best if pair not in got)


def test_clashing_column_and_many_keys(spark, monkeypatch):
    rows = [(1, "one two three four five six seven", "a"), (2, "nothing like it at all", "b"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row_key string")
    benchmark = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    for sent in (D.SENT_KEYS, 0):
        monkeypatch.setattr(D, "SENT_KEYS", sent)
        left = D.decontaminate(docs, benchmark)
        assert sorted(map(tuple, left.collect()), key=repr) == sorted(rows[1:], key=repr) and left.columns == docs.columns
