"""From raw documents to packed sequences: quality classifier, exact
duplicates, near duplicates, mixing to target weights, packing. Every stage
works on all that the one before kept; each result is written as Parquet to the
shared folder and read again as the next stage's documents.

Defined results: those of the operators (``catchment.llm``). Extra columns of
``documents`` are carried along by all stages but the last, which returns the
packed pieces. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catchment.llm import exact, mixing, neardup, packing, quality
from catchment.llm.queries import table, tokenizer_path
from catchment.llm.shared import ship_package
from catchment.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest id) of each group of equal texts."""
    return exact.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked at 0.8 on five-word shingles."""
    ship_package(spark)
    return neardup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the taken documents in sequences of at most 2048 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

# A trained classifier, hashed draws and a tokenizer are beyond SQL; the tests
# compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
