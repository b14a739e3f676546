"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the docs of the next.  All but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tariffworks.llm import chosen_path, mixing, packing, surrogates, toxicity
from tariffworks.llm.common import table
from tariffworks.session import configure, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component."""
    return chosen_path.distinct_documents(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    return surrogates.replace_entities(docs).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: A trained model, sketches and keyed hashes decide here; SQL expresses none of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    configure(spark)
    base = shared_folder(spark)
    if base is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = f"{base}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{k}-{name}")
    return docs
