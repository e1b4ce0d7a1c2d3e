"""The pipeline's stages, one after the other, each against a plain version of its decision."""

import os

import pytest

import corpus_pipeline
from millrace.llm import decontaminate, queries, quality
from tests.llm.test_jaccard import brute as components

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def without_repeats(rows, width):
    least = {}
    for i, text in rows:
        b = text.encode()
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            least[w] = min(least.get(w, i), i)
    out = {}
    for i, text in rows:
        b = text.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if least[b[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        if kept.strip() or not any(gone):
            out[i] = kept
    return out


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before, kept[k] = docs.select("doc_id", "text").collect(), {r.doc_id for r in out.select("doc_id").collect()}
        if k == 0:
            assert kept[k] == {r.doc_id for r in quality.judged(docs).collect() if r.kept}
            assert 0.5 * len(before) < len(kept[k]) < len(before)
        if k == 1:
            want = components([tuple(r) for r in before], 5, 80)
            assert kept[k] == {c for _, _, c in want}
        if k == 2:
            got = {r.doc_id: r.text for r in out.collect()}
            assert got == without_repeats([tuple(r) for r in before], 50)
            assert all(r.n_chars == len(r.text) for r in out.collect())
        if k == 3:
            items = queries.table(spark, SF_DIR, "benchmark")
            bad = {r.doc_id for r in decontaminate.contaminated(docs, items).collect()}
            assert bad and kept[k] == {r.doc_id for r in before} - bad
        if k < 4:
            assert out.columns == columns and out.count() == len(kept[k])
            docs = out
        else:
            assert kept[k] == kept[k - 1] and out.where("lossless").count() == len(kept[k])
            assert out.where("size(pieces) = 0").count() == docs.where("text = ''").count()


def test_run_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
