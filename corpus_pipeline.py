"""From raw documents to tokens: language, exact copies, near copies, mixing, encoding.

Every stage takes (spark, docs, folder) and returns a table, which is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``. NULL texts count as empty; a table without rows
passes through as one. The rules for ties, repeated rows and NULLs are those of the operator that a stage calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.bpe import encode_and_decode
from wayfare.llm.common import read, save
from wayfare.llm.exact_dedup import drop_exact_copies
from wayfare.llm.language_id import drop_rejected, fit_language_model
from wayfare.llm.mixing import mixed_documents
from wayfare.llm.simhash import drop_near_copies


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that the model is sure of; texts without a letter, and NULL ones, go."""
    return drop_rejected(docs, fit_language_model(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts whose fingerprints hang together by at most four differing bits, the one with the smallest doc_id."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix passes them: not at all, once or twice."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every document."""
    return encode_and_decode(docs, tokenizer_path()).select(F.col("id").alias("doc_id"), "n_tokens", "ids", "decoded")


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("mixing", mixture),
    ("bpe", tokens),
]

# fingerprints, components and trained models are beyond SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, folder), name)
    return docs
