"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.llm import bpe, language_id, lm_scoring, quality_classifier
from musterroll.llm.corpus import table
from musterroll.llm.decontaminate import with_matches
from musterroll.llm.quality_rules import judged_documents
from musterroll.llm.secrets import digest_columns, with_secrets
from musterroll.llm.simhash import hex_digits, near_duplicates
from musterroll.llm.spelling import spelling_forms
from musterroll.llm.sql import ORACLE_SQL
from musterroll.llm.substring_dedup import without_repeats
from musterroll.llm.token_counts import token_counts
from musterroll.llm.vector_codes import vector_codes
from musterroll.llm.warc import derivatives, responses

__all__ = ["ORACLE_SQL", "QUERIES"]
# The tables have no time of capture.
CAPTURED = "2024-01-01T00:00:00Z"


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses(table(spark, sf_dir, "pages"), CAPTURED))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of each document."""
    return bpe.decoded(bpe.encoded(docs)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_documents(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(table(spark, sf_dir, "documents"))
    return language_id.languages(table(spark, sf_dir, "pages"), model)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = quality_classifier.fit(docs, labels)
    return quality_classifier.scored(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = digest_columns()
    return with_secrets(docs).select("doc_id", *[c.alias(name) for name, c in columns.items()])


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm_scoring.scored(table(spark, sf_dir, "documents"), held_out)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_derivatives,
        op2_byte_bpe,
        op3_substring_dedup,
        op4_simhash,
        op5_host_rules,
        op6_token_counts,
        op7_decontamination,
        op8_language_id,
        op9_quality_classifier,
        op10_secrets,
        op11_lm_scoring,
        op12_vector_codes,
        op13_spelling,
    )
}
