"""The corpus pipeline: documents through five stages to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldheat.llm.common import load, row_key, stage
from fieldheat.llm.decontamination import benchmark_hits
from fieldheat.llm.line_dedup import dedup_lines
from fieldheat.llm.queries import packed_digest
from fieldheat.llm.simhash import near_duplicates
from fieldheat.llm.toxicity import toxicity

# Learned, hashed and searched stages have no SQL; the tests compare them with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not score 0.5 or more, unchanged. Null and empty texts stay."""
    found = toxicity(docs, load(spark, sf_dir, "labels"))
    return found.where("score < 0.5").select("doc.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that ten or more documents share. Null texts stay null."""
    found = dedup_lines(docs, min_docs=10, min_length=1)
    columns = [F.col("kept") if c == "text" else F.col("doc").getField(c) for c in docs.columns]
    return found.select(*[column.alias(c) for column, c in zip(columns, docs.columns)])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, then with the least hash of its row.

    A null id comes first. Of repeated rows (same id and text) one stays. Documents without words are one group.
    """
    keyed = docs.select(F.struct("*").alias("doc"), *row_key("doc_id", "text"))
    ident = F.struct(F.col("doc.doc_id").alias("doc_id"), "r1", "r2").alias("id")
    found = near_duplicates(keyed.select(ident, F.col("doc.text").alias("text")), shingle=3, radius=3, id_col="id")
    kept = found.where("id = component_id").select("id.r1", "id.r2").distinct()
    return keyed.join(kept, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]).select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words of a benchmark item, unchanged. Documents without words stay."""
    found = benchmark_hits(docs, load(spark, sf_dir, "benchmark"), window=10)
    return found.where(F.size("spans") == 0).select("doc.*")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: the pieces of every document, with checksums of their ids."""
    return packed_digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over everything that the one before kept, written and read again in between."""
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
