"""SentencePiece: round trips, reproducible draws, and their distribution against all segmentations."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import pieces as P

SCHEMA = "doc_id long, text string, pieces string, decoded int, rows string"
BYTES = tuple(range(256))


def tiny(words, sharpness=1.0):
    spelt = (b"",) * 256 + tuple(w.encode() for w in words)
    logs = (-9.0,) * 256 + tuple(-sharpness * math.log(i + 2) for i in range(len(words)))
    return P.Vocabulary(spelt, logs, BYTES)


def draw(t, text, seeds):
    data = np.frombuffer(text.encode() * len(seeds), np.uint8)
    bounds = np.arange(len(seeds) + 1) * len(text.encode())
    ids, first = P.sampled(t, data, bounds, seeds)
    return [tuple(ids[a:b].tolist()) for a, b in zip(first, first[1:])]


def ways(v, text):
    """All segmentations with their weights."""
    if not text:
        return {(): 1.0}
    known = {p: i for i, p in enumerate(v.pieces) if p}
    out = {}
    for k in range(1, len(text) + 1):
        i = known.get(text[:k])
        if i is not None:
            for rest, w in ways(v, text[k:]).items():
                out[(i, *rest)] = w * math.exp(v.logs[i])
    return out


def test_distribution():
    v = tiny(["a", "b", "ab", "ba", "aba", " ", " a", "bab"])
    every = ways(v, b" abab")
    total = sum(every.values())
    got = Counter(draw(P.Tables(v), " abab", P.seeds_of(range(20_000), 3)))
    assert set(got) <= set(every)
    for path, weight in every.items():
        assert abs(got[path] / 20_000 - weight / total) < 0.015


def test_reproducible_and_independent_of_the_batch():
    v = tiny(["a", "b", "ab", "ba", " a", "é", "aé"])
    t = P.Tables(v)
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n▁日") for _ in range(rng.randint(0, 200))).encode() for _ in range(50)]
    seeds = P.seeds_of(range(50), 1)
    bounds = np.cumsum([0, *map(len, texts)])
    ids, first = P.sampled(t, np.frombuffer(b"".join(texts), np.uint8), bounds, seeds)
    for i, text in enumerate(texts):
        own = ids[first[i] : first[i + 1]]
        alone, _ = P.sampled(t, np.frombuffer(text, np.uint8), np.array([0, len(text)]), seeds[i : i + 1])
        assert own.tolist() == alone.tolist()
        assert P.spelt(t, own).tobytes() == text
    assert draw(t, "abab" * 20, P.seeds_of([1], 1)) != draw(t, "abab" * 20, P.seeds_of([1], 2))


def test_columns(spark):
    v = tiny(["the", " the", "a", " of", "er"])
    texts = [None, "", "the other of a", "▁ \x00\r\n", "日本 the", "x" * 100_000, "the other of a"]
    rows = [(i if i != 5 else None, t, "x", 1, "y") for i, t in enumerate(texts)] + [(2, texts[2], "x", 1, "y")]
    out = P.decode(P.encode(spark.createDataFrame(rows, SCHEMA).repartition(2), v), v).collect()
    assert all(r.decoded == r.text and (r.pieces is None) == (r.text is None) and r.rows == "y" for r in out)
    assert len({tuple(r.pieces) for r in out if r.doc_id == 2}) == 1 and len(out) == len(rows)
    empty = P.decode(P.encode(spark.createDataFrame([], SCHEMA), v), v)
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "rows", "pieces", "decoded"]


def test_model_file():
    v = P.Vocabulary.read("/opt/tokenizers/piece_bpe_32k.model")
    t = P.tables(v)
    text = "The quick brown fox jumps; über größere Füchse, 日本語! \ttabs\n" * 20
    ids, _ = P.sampled(t, np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), P.seeds_of([1], 0))
    assert P.spelt(t, ids).tobytes().decode() == text and len(ids) < len(text) * 0.7
    with pytest.raises(ValueError, match="every byte"):
        import sentencepiece

        class Few(sentencepiece.SentencePieceProcessor):
            def is_byte(self, i):
                return False

        old, sentencepiece.SentencePieceProcessor = sentencepiece.SentencePieceProcessor, Few
        try:
            P.Vocabulary.read("/opt/tokenizers/piece_bpe_32k.model")
        finally:
            sentencepiece.SentencePieceProcessor = old


def unspaced(kind, n, seed=4):
    rng = random.Random(seed)
    if kind == "han":
        return "".join(chr(rng.randrange(0x4E00, 0x9000)) if rng.random() < 0.5 else rng.choice("的一是不了人我在有他") for _ in range(n))
    return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))


@pytest.mark.parametrize("kind", ["han", "base64"])
def test_cut_words_have_the_pieces_of_whole_ones(monkeypatch, kind):
    """The parts' draws are those of the whole word."""
    t = P.tables(P.Vocabulary.read("/opt/tokenizers/piece_bpe_32k.model"))
    text = (unspaced(kind, 700) + " and é\n" + unspaced(kind, 90, 5)).encode()
    data, bounds = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    cut, _ = P.sampled(t, data, bounds, P.seeds_of([3], 1))
    parts = P.segments(t, data, bounds)
    monkeypatch.setattr(P, "LONG", 1 << 30)
    whole, _ = P.sampled(t, data, bounds, P.seeds_of([3], 1))
    assert cut.tolist() == whole.tolist() and P.spelt(t, cut).tobytes() == text
    assert len(parts) > 2 * len(P.segments(t, data, bounds))


@pytest.mark.parametrize("kind, n, seconds", [("han", 350_000, 4), ("base64", 1_000_000, 20)])
def test_a_megabyte_without_blanks(kind, n, seconds):
    import time

    t = P.tables(P.Vocabulary.read("/opt/tokenizers/piece_bpe_32k.model"))
    text = unspaced(kind, n).encode()
    start = time.process_time()
    ids, _ = P.sampled(t, np.frombuffer(text, np.uint8), np.array([0, len(text)]), P.seeds_of([1], 0))
    assert time.process_time() - start < seconds and P.spelt(t, ids).tobytes() == text


def test_trie_finds_every_piece():
    """Steps that share a slot are told apart, and what is no piece or prefix is not found."""
    rng = random.Random(5)
    known = {bytes(rng.choice(b"abc \xc3") for _ in range(rng.randint(1, 9))) for _ in range(3000)}
    t = P.Tables(P.Vocabulary((b"",) * 256 + tuple(sorted(known)), (0.0,) * (256 + len(known)), BYTES))
    ids = {piece: 256 + i for i, piece in enumerate(sorted(known))}
    words = [bytes(rng.choice(b"abcd \xc3") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    first = np.cumsum([0, *map(len, words)])
    got = {(int(x), k): int(i) for k, at, found in t.inside(np.frombuffer(b"".join(words), np.uint8), first) for x, i in zip(at, found)}
    spans = ((low, w, i, k) for low, w in zip(first, words) for i in range(len(w)) for k in range(1, 10) if i + k <= len(w))
    assert got == {(int(low) + i, k): ids[w[i : i + k]] for low, w, i, k in spans if w[i : i + k] in ids}
    assert any(t.below(np.array([n]), np.array([b], np.uint8)) == t.none for n in range(9) for b in b"d\x00")


def test_shares_near_and_far():
    """An edge's share is its part of the weight of all ways to its end; a word's shares are the same beside others."""
    t = P.Tables(tiny(["a", "b", "ab", "ba", "aba", " a", "é", "bé"]))
    rng = random.Random(6)
    texts = [(" " + "".join(rng.choice("abé日") for _ in range(n))).encode() for n in (200, P.NEAR, 30, 7, 3, 0)]
    texts.sort(key=len, reverse=True)
    many = P.Lattice(t, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    for word, text in enumerate(texts):
        alone = P.Lattice(t, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        sums = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            place = many.base[end] + word
            edges, own = slice(*many.edges[place : place + 2]), slice(*alone.edges[alone.base[end] : alone.base[end] + 2])
            assert many.share[edges].tolist() == alone.share[own].tolist()
            assert many.piece[edges].tolist() == alone.piece[own].tolist()
            ways_ = [sums[end - int(k)] + t.logs[i] for k, i in zip(many.size[edges], many.piece[edges])]
            assert all(text[end - int(k) : end] == P.spelt(t, np.array([i])).tobytes() for k, i in zip(many.size[edges], many.piece[edges]))
            if ways_:
                sums[end] = float(np.logaddexp.reduce(ways_))
                assert np.allclose(many.share[edges], np.exp(np.array(ways_) - sums[end]), rtol=1e-9)


def test_work_for_ordinary_text(monkeypatch):
    """CPU seconds went into hashes of every place for every size of pieces and into single sums of logarithms: now only
    whole words are hashed, and no edge near a word's start is added by itself."""
    t = P.tables(P.Vocabulary.read("/opt/tokenizers/piece_bpe_32k.model"))
    rng = random.Random(7)
    syllables = "the and ing tion er re con pro ver un de lo ma ni sch ei gr ö é".split()
    text = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(2000)).encode()
    hashed, hashes = [], P.H.slice_hashes
    monkeypatch.setattr(P.H, "slice_hashes", lambda sums, start, stop: (hashed.append(len(start)), hashes(sums, start, stop))[1])
    monkeypatch.setattr(np, "logaddexp", None)
    ids, _ = P.sampled(t, np.frombuffer(text, np.uint8), np.array([0, len(text)]), P.seeds_of([1], 0))
    assert P.spelt(t, ids).tobytes() == text and sum(hashed) == 2000
