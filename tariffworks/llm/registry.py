"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tariffworks.llm import (
    alignment, bwt, chat, chosen_path, licenses, merkle, mixing, packing, pq, secrets, sql, surrogates, toxicity, winnow,
)
from tariffworks.llm.common import table


def op1_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return pq.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_collection_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages removed from all documents."""
    return bwt.remove_repeats(table(spark, sf_dir, "documents"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from the perspective of each participant."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op4_linked_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    return surrogates.replace_entities(table(spark, sf_dir, "documents"))


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return winnow.fingerprints(table(spark, sf_dir, "documents"))


def op8_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weights takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in all documents, with corpus-wide counts of linked ids."""
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


def op12_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in all documents."""
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, some tampered with, against the root of the table."""
    return merkle.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_product_quantisation, op2_collection_bwt, op3_perspectives, op4_linked_credentials,
    op5_surrogates, op6_chosen_path, op7_winnowing, op8_complement_packing,
    op9_pu_toxicity, op10_source_schedule, op11_token_alignment, op12_license_signatures, op13_merkle_manifest,
)}

QUERIES["pipeline"] = corpus_pipeline.run

SQL = sql.SQL
