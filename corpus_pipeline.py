"""From raw documents to packed sequences: toxicity, near-duplicates, secrets, source mix, packing.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir), works on all rows its
predecessor kept and returns a DataFrame, which is written as Parquet under the shared
scratch folder and read again as the next one's documents. All but the last return the
columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, secrets, simhash, toxicity
from tidemark.llm.common import materialize, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model learns from the labels of the given documents."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret's span is replaced by a mark; all documents stay."""
    return secrets.redact(docs, secrets.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, by length and checksum of their ids."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the toxicity model nor the packing; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
