"""Token counts against the libraries, and what the cache holds and saves."""

import random
from functools import cache

import pytest

from millrace.llm import counts as C
from millrace.llm import queries
from millrace.llm.vocabularies import divisible, json_tokenizer, parts, piece_ids, piece_model

SCHEMA = "doc_id long, text string, kept int, digest string, n_tokens long, version string"
NAMES = ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [
    None,
    "",
    " ",
    "   two  blanks ",
    "▁marks▁ inside ▁",
    "<s>[INST] </s> <unk> <|endoftext|> <|ENDOFTEXT|> <|startoftext|>",
    "Größe ﬁ Ａ é İ 日本語テキスト 🙂🙂",
    "line\nline\r\n\ttab \x00 nul",
    "Same Text",
    "same  text",
    "x" * 20000,
    "word " * 30000,
]


@cache
def vocabulary_of(name):
    return queries.vocabulary(name)


def rows_of(texts):
    return [(i, t, 1, "d", 5, "v") for i, t in enumerate(texts)]


def expected(name, text):
    vocabulary = vocabulary_of(name)
    if name.endswith(".model"):
        return len(piece_model(vocabulary).encode(text or ""))
    return len(json_tokenizer(vocabulary).encode(text or "", add_special_tokens=False))


def some_texts(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "größer", "x\n", "日本", "12", "Don't", "  ", "▁", "<s>", "<|endoftext|>"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", NAMES)
def test_counts_are_the_librarys(spark, tmp_path, name):
    texts = ODD + some_texts(1) + ["a copy of a text"] * 40
    rows = rows_of(texts) + [(None, "no id", 0, "", 0, ""), (3, "second row of an id", 0, "", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = C.count(df, vocabulary_of(name), str(tmp_path / "cache"), ["doc_id"]).rows.collect()
    want = [(r[0], len((r[1] or "").encode()), expected(name, r[1])) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("sent", [0, 1 << 17])
def test_only_misses_are_encoded(spark, tmp_path, monkeypatch, sent):
    stored_at, vocabulary = str(tmp_path / "cache"), vocabulary_of(NAMES[0])
    first, more = some_texts(2, 60), some_texts(3, 60)
    old = C.count(spark.createDataFrame(rows_of(first), SCHEMA), vocabulary, stored_at, ["doc_id"], sent_misses=sent)
    assert old.misses == old.distinct == len({t for t in first})
    same = C.count(spark.createDataFrame(rows_of(first), SCHEMA), vocabulary, stored_at, ["doc_id"], sent_misses=sent)
    assert (same.distinct, same.misses) == (old.distinct, 0)
    both = C.count(spark.createDataFrame(rows_of(first + more + more), SCHEMA), vocabulary, stored_at, ["doc_id"], sent_misses=sent)
    assert both.misses == len(set(more) - set(first))
    assert {r.doc_id: r.n_tokens for r in both.rows.collect()} == {
        i: expected(NAMES[0], t) for i, t in enumerate(first + more + more)
    }
    stored = spark.read.parquet(stored_at)
    assert stored.count() == stored.select("digest").distinct().count() == len(set(first + more))
    # Another tokenizer has counts of its own.
    other = C.count(spark.createDataFrame(rows_of(first), SCHEMA), vocabulary_of(NAMES[1]), stored_at, ["doc_id"])
    assert other.misses == other.distinct


def test_cache_rows_that_stand_twice(spark, tmp_path):
    """Two runs may add the same digest at once."""
    stored_at, vocabulary = str(tmp_path / "cache"), vocabulary_of(NAMES[0])
    df = spark.createDataFrame(rows_of(["a b", "c", "c"]), SCHEMA)
    first = C.count(df, vocabulary, stored_at, ["doc_id"]).rows.collect()
    for part in spark.read.parquet(stored_at).select("version").distinct().collect():
        rows = spark.read.parquet(stored_at).where(f"version = '{part.version}'").select("digest", "n_tokens").collect()
        C.append_to_cache(spark.createDataFrame(rows, "digest binary, n_tokens long"), stored_at, part.version)
    again = C.count(df, vocabulary, stored_at, ["doc_id"])
    assert again.misses == 0 and sorted(again.rows.collect()) == sorted(first)


def test_normal_forms_meet(spark, tmp_path):
    df = spark.createDataFrame(rows_of(["Some  Text", "some text", "SOME\ttext"]), SCHEMA)
    assert C.count(df, vocabulary_of("word_bpe_49k.json"), str(tmp_path / "words"), ["doc_id"]).distinct == 1
    assert C.count(df, vocabulary_of("byte_bpe_50k.json"), str(tmp_path / "bytes"), ["doc_id"]).distinct == 3


def test_parts_give_the_same_pieces():
    vocabulary = vocabulary_of(NAMES[0])
    assert divisible(vocabulary)
    for text in ODD[1:] + some_texts(4):
        for step in (1, 3, 50):
            cut = list(parts(" " + text, step))
            assert "".join(cut) == " " + text
            got = [i for p in cut for i in piece_model(vocabulary).encode(p[1:])]
            assert got == piece_model(vocabulary).encode(text)
        assert piece_ids(vocabulary, [text]) == [piece_model(vocabulary).encode(text)]


def test_empty_table_and_names(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    found = C.count(empty, vocabulary_of(NAMES[0]), str(tmp_path / "none"), ["doc_id", "kept"])
    assert found.rows.collect() == [] and found.misses == 0
    with pytest.raises(ValueError):
        C.count(empty, vocabulary_of(NAMES[0]), str(tmp_path / "none"), ["doc_id", "n_tokens"])


def test_query_over_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op12_token_counts(spark, sf_dir).collect()}
    want = {r.doc_id: (len((r.text or "").encode()), n := expected(NAMES[0], r.text), n > 4096) for r in docs}
    assert got == want
