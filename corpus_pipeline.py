"""The corpus pipeline: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.llm.corpus import free_name, stored, table
from musterroll.llm.decontaminate import with_matches
from musterroll.llm.quality_rules import kept_documents
from musterroll.llm.queries import bpe_digests
from musterroll.llm.secrets import with_secrets
from musterroll.llm.simhash import SimHash, one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules and their host's verdict keep; rows without doc_id too."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest doc_id.

    Near copies have fingerprints of 3-word shingles that differ in at most two bits, or
    that a chain of such fingerprints joins.
    """
    return one_of_each(docs, SimHash(words=3, bits=2))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a confirmed benchmark item."""
    into = free_name(docs, "matches")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"), into=into)
    return found.where(F.size(into) == 0).select(docs.columns)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by their kind; n_chars, if any, is counted anew."""
    masked = with_secrets(docs, masked=True, into=free_name(docs, "spans")).select(docs.columns)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row its doc_id, token count and digests of the ids and of the decoded bytes."""
    return bpe_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_masking", secret_masking),
    ("tokens", tokens),
]

# BPE merges, BM25 retrieval and components of near copies are beyond SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, each result but the last stored in between."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
