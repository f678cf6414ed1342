"""Training-data pipeline over ``documents``: five stages, each written as Parquet.

Quality rules, SimHash near-dedup, benchmark decontamination, mixing sources
to target weights, token-ID records. A stage takes ``(spark, docs, sf_dir)``
and works on all rows its predecessor kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from encore.llm import curriculum, decontaminate, quality, records, simhash
from encore.llm.common import materialize, read
from encore.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs, shingle=4, max_distance=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no item of ``benchmark`` leaks."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: documents as often as the mix takes them, by training position."""
    return curriculum.mix(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Record files of token ids in the order of the training sequence; one row for each record read back."""
    return records.encode_documents(docs, tokenizer("word_bpe_49k.json"), order=records.stored_order())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_records", token_records),
]

# The stages hash with XXH64, walk random embeddings and tokenize: not SQL.
# tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, writing and rereading between them."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
