"""Alignment of two tokenizers against plain loops over tokens."""

import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
import pytest

from millrace.llm import alignment as A
from millrace.llm import queries
from millrace.llm.vocabularies import BLANK, json_tokenizer, parts, piece_model, plain_ids, ranked

SCHEMA = "doc_id long, text string, id string, pair long, links long"
ODD = [
    None,
    "",
    " ",
    "a",
    "   two  blanks ",
    f"{BLANK}marks inside",
    "<s>[INST] </s> <unk> <|endoftext|> <0x41>",
    "Größe ﬁ Ａ é İ 日本語テキスト 🙂🙂 ∑",
    "line\nline\r\n\ttab \x00 nul \n  blanks\n ",
    "antidisestablishmentarianism " * 3,
    "word\n  more " * 2000,
]


@cache
def sides():
    return queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


@cache
def token_bytes():
    a, b = sides()
    model = piece_model(b)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    of_b = [
        bytes.fromhex(n[3:5]) if model.is_byte(i) else n.replace(BLANK, " ").encode() for i, n in enumerate(names)
    ]
    letters = A.byte_alphabet()
    return {i: bytes(letters.get(c, 0) for c in t) for t, i in json_tokenizer(a, plain=True).get_vocab().items()}, of_b


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at += len(table[i])
    return out


def brute(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, sha), by comparing all tokens that overlap."""
    a, b = sides()
    of_a, of_b = token_bytes()
    found, pairs = [], Counter()
    for text in texts:
        x, y, want = [], [], b""
        if text:
            want = (" " + text).encode()
            x = spans(json_tokenizer(a, plain=True).encode(" " + text, add_special_tokens=False).ids, of_a)
            y = spans(piece_model(b).encode(text), of_b)
        if b"".join(of_a[i] for *_, i in x) != want or b"".join(of_b[i] for *_, i in y) != want:
            x, y = [], []
        cuts = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
        groups, links, low = [], [], 0
        i = j = 0
        for cut in cuts:
            ga, gb = [], []
            while i < len(x) and x[i][1] <= cut:
                ga.append(x[i])
                i += 1
            while j < len(y) and y[j][1] <= cut:
                gb.append(y[j])
                j += 1
            groups.append(",".join(str(t[2]) for t in ga) + "|" + ",".join(str(t[2]) for t in gb))
            links += [(s[2], t[2]) for s in ga for t in gb if s[0] < t[1] and t[0] < s[1]]
            low = cut
        pairs.update(links)
        found.append((len(x), len(y), groups, links))
    most = {}
    for (_, t), n in pairs.items():
        most[t] = max(most.get(t, 0), n)
    return [
        (
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(pairs[p] == most[p[1]] for p in links),
            sum(pairs[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, groups, links in found
    ], pairs


def some_texts(seed, n=80):
    rng = random.Random(seed)
    words = ["the", "tokenization", "größer", "x\n", "日本", "12345", "Don't", " ", BLANK, "<s>", "<|endoftext|>", "naïveté"]
    return [" ".join(rng.choices(words, weights=[9, 5, 5, 3, 3, 5, 5, 3, 0.1, 1, 1, 5], k=rng.randint(0, 60))) for _ in range(n)]


def values(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


@pytest.mark.parametrize("sent, chunk", [(1 << 20, 2 << 20), (0, 700), (0, 1 << 20)])
def test_against_loops(spark, sent, chunk):
    texts = ODD + some_texts(1) + ["a copy of some text, tokenized alike"] * 30
    rows = [(i, t, "i", 1, 2) for i, t in enumerate(texts)] + [(None, "no id", "", 0, 0), (4, "one id twice", "", 0, 0)]
    found = A.Alignment(spark.createDataFrame(rows, SCHEMA).repartition(4), *sides(), chunk_bytes=chunk, sent_pairs=sent)
    want, pairs = brute([r[1] for r in rows])
    got = [(r.id, *values(r)) for r in found.documents().collect()]
    assert sorted(got, key=repr) == sorted([(r[0], *w) for r, w in zip(rows, want)], key=repr)
    listed = found.pairs().collect()
    assert {(r.a, r.b): r.links for r in listed} == pairs and len(listed) == len(pairs)
    best = {r.b: (r.a, r.links, r.all_links) for r in found.best().collect()}
    for b in {b for _, b in pairs}:
        mine = {a: n for (a, other), n in pairs.items() if other == b}
        top = max(mine.values())
        assert best[b] == (min(a for a, n in mine.items() if n == top), top, sum(mine.values()))


def test_identity_map():
    of_a, of_b = token_bytes()
    found = A.identity_map(*sides())
    assert all(of_a[i] == of_b[t] for i, t in enumerate(found) if t >= 0)
    model = piece_model(sides()[1])
    have = {x for i, x in enumerate(of_b) if not model.is_byte(i)}
    assert all(not model.is_byte(int(t)) for i, t in enumerate(found) if of_a[i] in have)
    assert (found >= 0).sum() > 5000


def test_parts_of_a_long_text(monkeypatch):
    """Cut anywhere it may be, a text has the tokens it has as a whole."""
    a, b = sides()
    assert A.begin_anew(a, b)
    for text in ODD[2:] + some_texts(3, 30):
        whole = json_tokenizer(a, plain=True).encode(" " + text, add_special_tokens=False).ids
        for step in (1, 7, 64):
            cut = list(parts(" " + text, step))
            assert [i for p in cut for i in json_tokenizer(a, plain=True).encode(p, add_special_tokens=False).ids] == whole
            assert [i for p in cut for i in piece_model(b).encode(p[1:])] == piece_model(b).encode(text)
    monkeypatch.setattr(A, "PART", 40)
    texts = [t for t in ODD + some_texts(5, 20) if t]
    for text, got in zip(texts, A.encoded(a, b, texts)):
        if got:
            assert np.concatenate(got[1]).tolist() == piece_model(b).encode(text)


def test_ranks_give_the_librarys_ids():
    """The fast way against the library, on words of the vocabulary put together and on characters of all kinds."""
    a, _ = sides()
    assert ranked(a) is not None and ranked(queries.vocabulary("word_bpe_49k.json")) is None
    rng, entries = random.Random(11), [t.decode(errors="replace") for t in token_bytes()[0].values()]
    kinds = [(32, 127), (0, 0x250), (0x400, 0x500), (0x4E00, 0xA000), (0x1F300, 0x1F700)]
    texts = ["".join(rng.choices(entries, k=rng.randint(1, 6))) for _ in range(4000)]
    texts += ["".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randint(1, 25))) for _ in range(4000)]
    texts += [t or "" for t in ODD] + ["x" * 30_000]
    want = json_tokenizer(a, plain=True).encode_batch(texts, add_special_tokens=False)
    assert plain_ids(a, texts) == [w.ids for w in want]


def test_empty_table(spark):
    found = A.Alignment(spark.createDataFrame([], SCHEMA), *sides())
    assert found.documents().collect() == [] and found.pairs().collect() == []


def test_query_over_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want, _ = brute([r.text for r in docs])
    got = {r.doc_id: values(r) for r in queries.op11_cross_tokenizer_alignment(spark, sf_dir).collect()}
    assert got == {r.doc_id: w for r, w in zip(docs, want)}
