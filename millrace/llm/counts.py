"""Token counts from a cache of digests.

A text's tokens depend on its normalised content and on the tokenizer only. The cache is a table of (version, digest,
n_tokens): ``version`` is the digest of the tokenizer's file and library, ``digest`` the SHA-256 of a text as the
tokenizer's own normaliser leaves it. A run takes these steps:

1. Every text is digested once; a narrow row (columns to keep, digest, bytes) is stored, the text is not.
2. The different digests are joined to the cache's rows of this version. What has no count is a miss.
3. One text of each miss is encoded. Up to ``SENT_MISSES`` misses their digests go to all tasks, so only missing
   texts are shuffled; above that, texts are first reduced to one a digest and task, then meet the misses by a join,
   which is left out where nothing was known. Encoding takes a hundred times longer than that shuffle.
4. The new counts are appended to the cache, and the narrow rows get their counts by digest.

A text that is a third of all rows arrives once per task at the one place that encodes it; its narrow rows
are spread over tasks by Spark's skew join. The cache is only appended to; a count depends on its key alone, so runs
that add the same digest at once, or a run that is lost after half of its append, leave a cache that is still right.

Defined results: null text counts as empty and has no tokens unless the tokenizer gives an empty text some; rows with
equal or null ids are rows like any other; long texts are counted whole (a piece model takes them in parts where that
gives the same tokens); other columns, whatever their names, play no part; an empty table gives no rows and leaves the
cache as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chunks import pieces, stored
from millrace.llm.vocabularies import Vocabulary, json_tokenizer, piece_ids, piece_model
from millrace.operators.sinks import append_to, read_table

#: Misses whose digests (32 bytes each) are sent to all tasks.
SENT_MISSES = 1 << 17
#: Bytes of text that are encoded at once; a longer text is taken alone.
STEP_BYTES = 1 << 20

CACHE = "version STRING, digest BINARY, n_tokens BIGINT"


def normal_forms(vocabulary: Vocabulary, texts: list[str]) -> list[bytes]:
    """What the tokens depend on. A form in which the normaliser made up the string of a special token is set apart:
    such strings are looked for in the text as it is given."""
    if vocabulary.kind == "model":
        model = piece_model(vocabulary)
        return [model.normalize(text).encode() for text in texts]
    tokenizer = json_tokenizer(vocabulary)
    if tokenizer.normalizer is None:
        return [text.encode() for text in texts]
    marks = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    forms = []
    for text in texts:
        form = tokenizer.normalizer.normalize_str(text)
        apart = any(mark in form or mark in text for mark in marks)
        forms.append(b"\x00" + text.encode() if apart else b"\x01" + form.encode())
    return forms


def token_counts(vocabulary: Vocabulary, texts: list[str]) -> list[int]:
    """Tokens of whole texts as the library gives them, without begin, end or other added tokens."""
    if vocabulary.kind == "model":
        return [len(ids) for ids in piece_ids(vocabulary, texts)]
    return [len(found) for found in json_tokenizer(vocabulary).encode_batch_fast(texts, add_special_tokens=False)]


@dataclass(frozen=True)
class Counted:
    """``rows``: the wanted columns with n_bytes and n_tokens. ``distinct``, ``misses``: different texts, and those of
    them that had to be encoded."""

    rows: DataFrame
    distinct: int
    misses: int


def known_counts(spark, cache: str, version: str) -> DataFrame:
    """The cache's counts of one tokenizer, one row a digest; other versions' files are not read."""
    rows = read_table(spark, cache, CACHE).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count(docs: DataFrame, vocabulary: Vocabulary, cache: str, keep: list[str], text: str = "text", sent_misses: int = SENT_MISSES) -> Counted:
    """Count the tokens of every text of ``docs`` with the cache at the path ``cache``."""
    if {"n_bytes", "n_tokens"} & set(keep):
        raise ValueError("n_bytes and n_tokens are the names of the counts")
    spark, version = docs.sparkSession, vocabulary.version
    slim = docs.select(F.struct(*keep).alias("kept"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES) if batch.num_rows else ():
                forms = normal_forms(vocabulary, part.column("text").to_pylist())
                digests = pa.array([hashlib.sha256(form).digest() for form in forms], pa.binary())
                columns = [*part.columns, digests]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "digest"])

    shape = T.StructType([*slim.schema.fields, T.StructField("digest", T.BinaryType())])
    keyed = slim.mapInArrow(digested, shape)
    rows = stored(keyed.select("kept", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")

    known = known_counts(spark, cache, version)
    looked_up = stored(rows.select("digest").distinct().join(known, "digest", "left"), "looked_up")
    distinct, misses = looked_up.agg(F.count("*"), F.count_if(F.col("n_tokens").isNull())).first()
    counts = looked_up.where("n_tokens is not null")
    if misses:
        missing = looked_up.where("n_tokens is null").select("digest")
        texts = slim.select("text").mapInArrow(digested, "text string, digest binary")
        few, some = misses <= sent_misses, misses < distinct
        if few and some:
            texts = texts.join(F.broadcast(missing), "digest", "left_semi")
        single = texts.groupBy("digest").agg(F.first("text").alias("text"))
        if some and not few:
            single = single.join(missing, "digest", "left_semi")
        encoded = stored(encode(single, vocabulary), "encoded")
        append_to_cache(encoded, cache, version)
        counts = counts.unionByName(encoded)
    found = rows.join(counts, "digest").select("kept.*", "n_bytes", "n_tokens")
    return Counted(found, distinct, misses)


def encode(single: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text)."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", STEP_BYTES) if batch.num_rows else ():
                n = pa.array(token_counts(vocabulary, part.column("text").to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("digest"), n], ["digest", "n_tokens"])

    return single.mapInArrow(each, "digest binary, n_tokens long")


def append_to_cache(encoded: DataFrame, cache: str, version: str) -> None:
    """Each version has a folder of its own, so that a run reads the counts of its tokenizer only."""
    append_to(encoded.select("digest", "n_tokens"), f"{cache.rstrip('/')}/version={version}")
