"""What a task's Python worker takes at once and keeps: several of them share an executor's memory with its JVM."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import chunks, hashing, jaccard, suffixes

N = 1 << 20


def peak(fn):
    """Bytes that ``fn`` takes at most, without what was there before."""
    tracemalloc.start()
    try:
        out = fn()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.fixture
def text():
    """2 MB of words."""
    draw = np.random.default_rng(0).integers(97, 123, 2 << 20).astype(np.uint8)
    draw[::6] = 32
    return draw


def test_powers_of_a_step_stay_small(text):
    hashing._powers.cache_clear()
    starts, ends, _ = hashing.words_of(text, np.array([0, len(text)]))
    _, took = peak(lambda: hashing.word_hashes(text, starts, ends))
    assert took < 8 * len(starts) + (12 << 20)
    assert sum(x.nbytes for x in hashing.powers(hashing.STEP + 1)) <= 4 << 20


def test_step_changes_no_hash(text):
    starts, ends, _ = hashing.words_of(text[: 1 << 18], np.array([0, 1 << 18]))
    whole = hashing.word_hashes(text[: 1 << 18], starts, ends, 1 << 19)
    assert (hashing.word_hashes(text[: 1 << 18], starts, ends, 1000) == whole).all()


def test_bytes_are_looked_up_without_index(text):
    got, took = peak(lambda: hashing.looked_up(hashing.SPACE, text))
    assert (got == hashing.SPACE[text]).all() and took < 4 * len(text)
    shingled, took = peak(lambda: hashing.words_of(text, np.array([0, len(text)])))
    assert len(shingled[0]) == len(shingled[1]) and took < 9 * len(text)


def test_document_counts_by_shares():
    rng = np.random.default_rng(1)
    key, count = rng.integers(0, N // 2, N).astype(np.uint32), rng.integers(1, 9, N).astype(np.uint8)
    (got,), took = peak(lambda: jaccard.document_counts([key, count]))
    total = np.bincount(key, weights=count, minlength=N // 2)
    assert (got == np.floor(np.log2(total[key]))).all()
    assert took < 16 * N


def test_classes_by_shares():
    rng = np.random.default_rng(2)
    key = rng.integers(0, N // 4, N).astype(np.uint32)
    name, doc = rng.integers(1, 3, N).astype(np.uint64), rng.integers(0, 50, N)
    (got,), took = peak(lambda: suffixes.classes([key, name, doc]))
    least = np.full((N // 4, 3), 1 << 40)
    np.minimum.at(least, (key, name.astype(int)), doc)
    one, two = least[:, 1][key], least[:, 2][key]
    both = (one < 1 << 40) & (two < 1 << 40) & (one != two)
    own = np.where(both, suffixes.OPEN, suffixes.ALONE)
    assert (got == np.where(doc > least[key, name.astype(int)], suffixes.LATER, own)).all()
    assert took < 32 * N


def test_shares_hold_equal_keys_together():
    keys = np.random.default_rng(3).integers(0, 1000, 5000).astype(np.uint64)
    found = list(chunks.shares(keys))
    assert sorted(np.concatenate(found)) == list(range(5000))
    of = np.empty(5000, int)
    for i, at in enumerate(found):
        of[at] = i
    assert all(len(set(of[keys == k])) == 1 for k in np.unique(keys))
    assert list(chunks.shares(np.zeros(0, np.uint32))) == []


def test_entries_are_read_in_place():
    blob = np.arange(10, dtype=np.uint32).tobytes() + chunks.narrow(np.arange(5, 15))
    entry = pa.array([b"x", blob], pa.binary())[1]
    view = memoryview(entry.as_buffer()).cast("B")
    got = chunks.columns_of(view, 10, [np.uint32, np.int64])
    assert (got[0] == np.arange(10)).all() and (got[1] == np.arange(5, 15)).all()
