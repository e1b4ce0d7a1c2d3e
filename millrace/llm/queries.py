"""Queries of the numbered operators over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, chat, counts, decontaminate, jaccard, language, licenses, lm, pieces, quality, shards, suffixes, vocabularies, whitening
from millrace.session import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Where the vocabulary files are; only the driver reads them.
TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pattern that belongs to the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Key of the training order and seed of the sampled segmentations.
ORDER_KEY = 20240601
SEED = 7
#: Tokens above which a document is over the limit.
TOKEN_LIMIT = 4096


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def not_remainder(divisor: int, remainder: int) -> Column:
    """Rows whose crc32 of the id as text leaves another remainder; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor != remainder


def bytepairs() -> shards.Bytepairs:
    return shards.Bytepairs.read(f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken", PATTERN)


def sentence_pieces() -> pieces.Vocabulary:
    return pieces.Vocabulary.read(f"{TOKENIZERS}/piece_bpe_32k.model")


def vocabulary(name: str) -> vocabularies.Vocabulary:
    return vocabularies.Vocabulary.read(f"{TOKENIZERS}/{name}")


@query
def op1_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as binary shards in training order, read back: one row per sequence with its place and documents."""
    return shards.summary(table(spark, sf_dir, "documents"), scratch(spark, "shards"), bytepairs(), key=ORDER_KEY)


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    found = jaccard.Similar(table(spark, sf_dir, "documents"), words=4, percent=85).documents()
    return found.selectExpr("id as doc_id", "n as n_shingles", "component as component_id")


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, decoded again: the decoded text's digest is the text's."""
    vocabulary = sentence_pieces()
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, seed=SEED)
    slim = encoded.select("doc_id", F.octet_length("text").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"), "pieces")
    return pieces.decode(slim, vocabulary).select(
        "doc_id",
        F.col("n_bytes").cast("long").alias("n_bytes"),
        F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("lossless"),
    )


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item or an edited copy of one, with the alignment's score."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances to the language references and verdict of every document."""
    return quality.judged(table(spark, sf_dir, "documents"))


@query
def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.scanned(table(spark, sf_dir, "documents"))


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a suffix tree and by word counts, learnt from four fifths of them."""
    return lm.scores(table(spark, sf_dir, "documents"), not_remainder(5, 1))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    trains = F.coalesce(not_remainder(4, 2), F.lit(True))
    found = language.identify(docs.select("doc_id", "text", "lang", trains.alias("trains")), F.col("trains"))
    return found.select("doc_id", (~F.col("trains")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 50 bytes or more of a document with a smaller id."""
    return suffixes.repeat_digest(table(spark, sf_dir, "documents"), width=50)


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that is full of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema)
    return chat.digest(rows.unionByName(more))


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens by two tokenizers, weighed by the whole corpus' links."""
    docs = table(spark, sf_dir, "documents")
    found = alignment.Alignment(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return found.documents().withColumnRenamed("id", "doc_id")


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, each different text encoded once, from a cache that starts empty."""
    docs, cache = table(spark, sf_dir, "documents"), scratch(spark, "token_counts")
    rows = counts.count(docs, vocabulary("piece_bpe_32k.model"), cache, keep=["doc_id"]).rows
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the first eight whitened components of all vectors' covariance."""
    return whitening.digest(table(spark, sf_dir, "embeddings"), components=8)


# ---- SQL ----------------------------------------------------------------------------------

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# All pairs that share a shingle, and the closure of their links: for tables of some thousand documents.
SQL["op2_ngram_jaccard_join"] = f"""
    WITH RECURSIVE words AS (
           SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
         shingles AS (
           SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                                               WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                               ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS g
           FROM words),
         sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
         pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
                   FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
         links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                   WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
         reached AS (SELECT doc_id, doc_id AS root FROM documents
                     UNION SELECT b, root FROM reached JOIN links ON a = doc_id),
         lowest AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM documents LEFT JOIN sizes USING (doc_id) JOIN lowest USING (doc_id)"""

# Every string of 50 bytes with the smallest document it starts in; starts at most 50 apart make one run.
SQL["op9_suffix_array_dedup"] = """
    WITH bytes AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
         sized AS (SELECT *, octet_length(t) AS n FROM bytes),
         grams AS (SELECT doc_id, pos, array_slice(t, pos, pos + 49) AS g
                   FROM (SELECT doc_id, t, unnest(range(1, n - 48)) AS pos FROM sized WHERE n >= 50)),
         least_of AS (SELECT g, min(doc_id) AS first_id FROM grams GROUP BY g),
         hits AS (SELECT doc_id, pos, pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 AS apart
                  FROM grams JOIN least_of USING (g) WHERE doc_id > first_id),
         numbered AS (SELECT doc_id, pos, sum(CASE WHEN apart IS FALSE THEN 0 ELSE 1 END)
                                         OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM hits),
         runs AS (SELECT doc_id, run, min(pos) AS low, max(pos) + 49 AS high FROM numbered GROUP BY doc_id, run),
         edges AS (SELECT doc_id, low, high FROM runs UNION ALL SELECT doc_id, n + 1, n + 1 FROM sized),
         parts AS (SELECT doc_id, low, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) + 1 AS since FROM edges),
         kept AS (SELECT doc_id, string_agg(CASE WHEN since < low THEN hex(array_slice(t, since, low - 1)) ELSE '' END, ''
                                            ORDER BY low) AS k
                  FROM parts JOIN sized USING (doc_id) GROUP BY doc_id),
         removed AS (SELECT doc_id, sum(high - low + 1) AS bytes_, count(*) AS spans FROM runs GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(bytes_, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
           sha256(unhex(k)) AS kept_sha256
    FROM sized JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

# Control strings of the template are 17 characters a turn; every escaped character takes one more.
SQL["op10_chat_formatting"] = """
    WITH said AS (
           SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(17 + 2 * length(role || text) - length(replace(replace(role || text, '~', ''), '[', ''))) AS BIGINT)
             AS formatted_chars
    FROM said GROUP BY conv_id"""
