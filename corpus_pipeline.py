"""A training corpus from ``documents``: stages that each keep, change or encode what the one before them kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe.llm import bpe, dart_minhash, decontaminate, secret_scan, toxicity
from pulseframe.llm.common import table
from pulseframe.sources.staging import stage as written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Trained on the labels of the documents that are there."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest id."""
    return dart_minhash.without_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret becomes a mark; all documents and columns stay, ``n_chars`` counts the new text."""
    clean = secret_scan.redact_documents(docs)
    if "n_chars" not in clean.columns:
        return clean
    kind = clean.schema["n_chars"].dataType
    length = F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind))
    return clean.withColumn("n_chars", length)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    return bpe.token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("dart_minhash", drop_near_copies),
    ("spaced_seeds", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode_tokens),
]

# Trained scores, sketches and token ids are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
