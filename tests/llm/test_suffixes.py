"""Suffix-array dedup against a plain set of windows."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import chunks as C
from millrace.llm import suffixes as S

SCHEMA = "doc_id long, text string, chunk string, bucket int, rows string"


def brute(rows, width):
    least = {}
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in texts:
        if i is not None:
            for p in range(len(b) - width + 1):
                w = b[p : p + width]
                least[w] = min(least.get(w, i), i)
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - width + 1 if i is not None else 0):
            if least[b[p : p + width]] < i:
                gone[p : p + width] = [True] * width
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def made(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : rng.randint(a, len(p))], word()]
        rows.append((i * 7 % n, "".join(parts), "x", 1, "y"))
    rows += [(5, "a" * 200, None, None, None), (6, "a" * 130 + "b", "", 2, ""), (None, rows[0][1] * 2, "", 2, ""), (3, None, "", 2, "")]
    rows += [(7, "", "", 0, ""), rows[2], (1000, rows[3][1], "", 0, ""), (1001, rows[3][1] + "ü" * 60, "", 0, "")]
    return rows


@pytest.mark.parametrize("seed, hot", [(1, None), (2, 0), (3, 1), (4, 2)])
def test_digest(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(S.Strings, "STEP", 300)
    if hot is not None:
        monkeypatch.setattr(S, "HOT", hot)
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, S.repeat_digest(df, width=30).collect()), key=repr)
    assert got == brute(rows, 30)


def test_long_text_in_many_steps(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef ") for _ in range(C.CHUNK_BYTES // 4))
    rows = [(2, text, "", 0, ""), (1, text[1000:90000] + "!" + text[500:2000], "", 0, ""), (3, text[7:], "", 0, "")]
    got = {r.doc_id: r for r in S.repeat_digest(spark.createDataFrame(rows, SCHEMA), width=50).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 90000 - 500 and got[3].n_removed == len(text) - 7
    assert got[2].n_spans == 1


def test_empty_table(spark):
    assert S.repeat_digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_texts(spark):
    a, b = "x1 " * 3 + "abcdefghijklmnopqrstuvwxyz" * 3, "é" * 40 + "abcdefghijklmnopqrstuvwxyz" * 3
    rows = [(1, a, 5), (2, b, 5), (3, a, 5), (4, None, None)]
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_chars int"), width=50)
    assert sorted(map(tuple, got.collect())) == [(1, a, 5), (2, "é" * 40, 40), (4, None, None)]


def test_merge_of_transforms():
    """Merged transforms give the intervals that sorting all suffixes gives."""
    rng = random.Random(5)
    texts = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 9))) for _ in range(20)}) for _ in range(4)]
    bwts = [S.transform(t) for t in texts]
    runs = np.array([len(t) - 5 for part in texts for t in part])
    docs = np.arange(len(runs))[::-1].copy()
    flat = [t for part in texts for t in part]
    least = {}
    for d, t in zip(docs, flat):
        for p in range(len(t) - 5):
            least[t[p : p + 6]] = min(least.get(t[p : p + 6], d), d)
    want = [sum(1 << p for p in range(len(t) - 5) if least[t[p : p + 6]] < d) for d, t in zip(docs, flat)]
    assert S.repeated(bwts, runs, docs, 6).tolist() == want


def test_only_suffixes_behind_windows_are_carried(monkeypatch):
    """The interleave has a row per window, not one per byte of the strings."""
    rng = random.Random(6)
    texts = [sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(30, 36))) for _ in range(20)}) for _ in range(3)]
    bwts = [S.transform(t) for t in texts]
    runs = np.array([len(t) - 29 for part in texts for t in part])
    sizes, sort = [], np.argsort

    def counted(x, **how):
        sizes.append(len(x))
        return sort(x, **how)

    monkeypatch.setattr(S.np, "argsort", counted)
    S.repeated(bwts, runs, np.arange(len(runs)), 30)
    assert sizes == [len(b) for b in bwts] + [runs.sum()] * 30
