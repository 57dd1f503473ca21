"""Training-corpus pipeline: each stage is written as Parquet and read again as the next one's documents."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideline.llm import decontaminate, packing, pii, quality, simhash
from tideline.llm.queries import TOKENIZER, table
from tideline.llm.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality.keep_good(docs, quality.learn_from(docs, table(spark, sf_dir, "labels")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.remove(docs, decontaminate.build_index(docs, table(spark, sf_dir, "benchmark")))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    return pii.redact(docs, pii.fit_sample(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all remaining documents, one row per piece."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii_redaction", redaction),
    ("packing", pack_sequences),
]
# Learned rules, fingerprints and tokenizers have no SQL form; the operators' tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
