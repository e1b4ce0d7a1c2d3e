"""Binary shards: the permutation is a bijection, files have a fixed stride, and reading gives the tokens back."""

import os
import random

import numpy as np
import pytest

from millrace.llm import queries
from millrace.llm import shards as S

SCHEMA = "doc_id long, text string, shard int, slot string, tokens string"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    slots = S.permuted(np.arange(n), n, 42)
    assert sorted(slots.tolist()) == list(range(n))
    assert S.slots_back(slots, n, 42).tolist() == list(range(n))
    if n > 100:
        assert (slots != S.permuted(np.arange(n), n, 43)).any()
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.15


@pytest.fixture(scope="module")
def vocabulary():
    return queries.bytepairs()


def test_round_trip(spark, vocabulary, tmp_path):
    rng = random.Random(1)
    words = ["the", "größer", "x\n", "of ", "日本", "12"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))), 1, "s", "t") for i in range(120)]
    rows += [(None, "no id", 0, "", ""), (7, None, None, None, None), rows[3], (500, "y " * 5000, 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = S.write(df, str(tmp_path / "shards"), vocabulary, key=5, length=16, records=50, chunk_bytes=3000)
    got = S.read(spark, out).collect()
    assert sorted(r.slot for r in got) == list(range(out.count)) and all(r.whole for r in got)
    encode, end = S.encoding(vocabulary)
    numbers = {r.slot: r.number for r in out.sequences.collect()}
    tokens = [t for r in sorted(got, key=lambda r: numbers[r.slot]) for t in r.tokens]
    texts, part = [], []
    for t in tokens:
        if t == end:
            texts.append(encode.decode(part))
            part = []
        else:
            part.append(t)
    assert sorted(texts) == sorted(r[1] or "" for r in rows) and part == []
    listed = {i for r in out.sequences.collect() for i in r.doc_ids}
    assert listed == {r[0] for r in rows}
    for shard in range(-(-out.count // 50)):
        files = [f for f in os.listdir(tmp_path / f"shards/shard={shard}") if f.startswith("part-")]
        size = os.path.getsize(tmp_path / f"shards/shard={shard}" / files[0])
        assert len(files) == 1 and size == min(50, out.count - 50 * shard) * out.stride
    some = S.read(spark, out, 45, 103).collect()
    assert sorted(r.slot for r in some) == list(range(45, 103))
    assert {r.slot: r.tokens for r in some} == {r.slot: r.tokens for r in got if 45 <= r.slot < 103}


def test_empty_table(spark, vocabulary, tmp_path):
    assert S.summary(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), vocabulary).collect() == []


def test_tasks_write_ranges_of_shards(spark, vocabulary, tmp_path, monkeypatch):
    """Every task has neighbouring shards, also where there are more of them than tasks."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(S, "TASK_BYTES", 1 << 12)
    df = spark.createDataFrame([(i, "some words " * 40) for i in range(60)], "doc_id long, text string").repartition(4)
    out = S.write(df, str(tmp_path / "shards"), vocabulary, key=2, length=16, records=2)
    files = {int(d.split("=")[1]): f for d in os.listdir(out.path) if "=" in d for f in os.listdir(f"{out.path}/{d}") if f.startswith("part-")}
    tasks = [int(files[shard].split("-")[1]) for shard in sorted(files)]
    assert tasks == sorted(tasks) and len(tasks) == -(-out.count // 2) > len(set(tasks)) > 8
    assert S.read(spark, out).where(~F.col("whole")).count() == 0
