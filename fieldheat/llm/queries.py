"""The operators as named queries over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldheat.llm.common import load
from fieldheat.llm.decontamination import benchmark_hits
from fieldheat.llm.embedding_dedup import near_vectors
from fieldheat.llm.exact_fit import pack_exactly
from fieldheat.llm.line_dedup import dedup_lines
from fieldheat.llm.lm_scoring import cross_entropy_difference
from fieldheat.llm.oracle import ORACLE_SQL
from fieldheat.llm.packing import pack
from fieldheat.llm.simhash import near_duplicates
from fieldheat.llm.substring_dedup import dedup_substrings
from fieldheat.llm.token_counts import token_counts
from fieldheat.llm.toxicity import held_out, toxicity
from fieldheat.llm.url_filters import filter_urls
from fieldheat.llm.vector_codes import codebook_digest, compress_vectors
from fieldheat.llm.whitening import whiten

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    found = near_duplicates(load(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more every document is like the documents of good quality than like all documents."""
    good = load(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(load(spark, sf_dir, "documents"), good)


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without words in twenty-word windows that start earlier."""
    kept = dedup_substrings(load(spark, sf_dir, "documents"), window=20)
    return kept.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, by a model that has seen labels outside the held-out fifth only."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity(docs, load(spark, sf_dir, "labels"))
    return found.select(
        "doc.doc_id",
        held_out(F.col("doc.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they are more than 2048."""
    counted = token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def packed_digest(docs: DataFrame) -> DataFrame:
    """Pieces of all documents, with a checksum in place of their ids."""
    packed = pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, window=2048)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of at most 2048 tokens."""
    return packed_digest(load(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the lines that ten documents share."""
    kept = dedup_lines(load(spark, sf_dir, "documents"), min_docs=10, min_length=1)
    digest = F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc.doc_id", "n_lines", "n_dropped", digest)


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of the vectors that agree in label and nearly in direction."""
    return near_vectors(load(spark, sf_dir, "embeddings"), threshold=0.93).withColumnRenamed("id", "vec_id")


URL_RULES = """
SELECT * FROM VALUES
    ('org', '/', 'allow'),
    ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'),
    ('com', '/de/', 'block')
AS rules(host, path, verdict)
"""


@query
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address, rule and verdict of every page."""
    judged = filter_urls(load(spark, sf_dir, "pages"), spark.sql(URL_RULES))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in ten words of a benchmark item."""
    found = benchmark_hits(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), window=10)
    begins_and_ends = F.transform("spans", lambda at, n: F.when(n % 2 == 0, -at).otherwise(at))
    n_hit = F.aggregate(begins_and_ends, F.lit(0).cast("long"), lambda total, at: total + at)
    names = F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>")))
    return found.select(
        "doc.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of at most 2048 tokens as exact complements and best fit give."""
    docs = load(spark, sf_dir, "documents")
    packed = pack_exactly(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, window=2048)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code of eight parts for every vector, and how far it is from the vector."""
    found, books = compress_vectors(load(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, factor=4096)
    return found.select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(codebook_digest(books)).alias("codebooks_sha256"),
    )


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirty-two whitened components of every vector."""
    found = whiten(load(spark, sf_dir, "embeddings"), components=32, factor=64, shift=1_000_000)
    return found.withColumnRenamed("id", "vec_id")
