"""Documents through quality rules, joins of near copies, repeats, decontamination and tokenisation.

Each stage is one operator over all rows that the one before it kept; its result is written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, pieces, quality, queries, suffixes
from millrace.llm.chunks import stored

# Five-word shingles and a similarity of 0.8 for near copies, 50 bytes for repeats.
WORDS, PERCENT, WIDTH = 5, 80, 50


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return jaccard.Similar(docs, words=WORDS, percent=PERCENT).kept()


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeat an earlier document."""
    return suffixes.remove_repeats(docs, width=WIDTH)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold a test item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding gives its text back."""
    vocabulary = queries.sentence_pieces()
    encoded = pieces.encode(docs, vocabulary, seed=queries.SEED).withColumn("text_sha256", F.sha2("text", 256)).drop("text")
    decoded = pieces.decode(encoded, vocabulary, to="text")
    return decoded.withColumn("lossless", F.sha2("text", 256).eqNullSafe(F.col("text_sha256"))).drop("text")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# Components, byte repeats, alignments and sampled segmentations are not expressible in SQL at this size.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
