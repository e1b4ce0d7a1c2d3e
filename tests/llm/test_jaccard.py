"""N-gram Jaccard join against all pairs."""

import random
import re

import pytest

from millrace.llm import jaccard as J

SCHEMA = "doc_id long, text string, chunk string, token int, rows string"


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def brute(rows, k, percent):
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [x[0] for j, x in enumerate(rows) if find(j) == find(i) and x[0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def made(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(40)]
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.7:
            text = list(rng.choice(texts))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = [rng.choice(words) for _ in range(rng.randint(1, 80))]
            if rng.random() < 0.5:
                text += passage
        texts.append(text)
        rows.append((rng.randrange(10**6), rng.choice(" \n").join(text), "x", 1, "y"))
    rows += [(1, None, "", 0, ""), (2, "", "", 0, ""), (3, " \n", "", 0, ""), (4, "One two", "", 0, ""), (5, "one\ttwo ", "", 0, "")]
    rows += [(None, rows[0][1], "", 0, ""), (None, "alone of all", None, None, None), rows[1], (rows[1][0], "another text here", "", 0, "")]
    return rows


@pytest.mark.parametrize("seed, k, percent, size", [(1, 4, 85, 256), (2, 5, 80, 3)])
def test_components(spark, monkeypatch, seed, k, percent, size):
    monkeypatch.setattr(J, "GROUP_CLASSES", size)
    monkeypatch.setattr(J, "QUESTIONS", size)
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = J.Similar(df, words=k, percent=percent)
    got = sorted(((r.id, r.n, r.component) for r in found.documents().collect()), key=repr)
    want = brute(rows, k, percent)
    assert got == want
    kept = found.kept()
    assert kept.schema == df.schema
    left = sorted(kept.collect(), key=repr)
    groups = {(c, i if c is None or not n else 0) for i, n, c in want}
    assert len(left) >= len({c for _, _, c in want}) and all(tuple(r) in rows for r in left)
    again = J.Similar(kept, words=k, percent=percent).documents()
    assert again.where("n > 0").groupBy("component").count().where("count > 1 and component is not null").count() <= 1
    assert len(groups) <= len(left) + 2


def test_empty_table(spark):
    found = J.Similar(spark.createDataFrame([], SCHEMA))
    assert found.documents().collect() == [] and found.kept().collect() == []


def test_chain_of_links(spark):
    """A component is more than the documents similar to its smallest id."""
    words = [f"x{i}" for i in range(120)]
    rows = [(100 - i, " ".join(words[i * 3 : i * 3 + 60])) for i in range(20)]
    got = J.Similar(spark.createDataFrame(rows, "doc_id long, text string"), words=4, percent=85).documents()
    assert {r.component for r in got.collect()} == {81}
