"""A pipeline over the documents table: quality rules, exact deduplication, near-duplicate join, personal
data masking, packing. Every stage works on all rows its predecessor kept; its output is written as
Parquet to the shared checkpoint folder and reread as the next stage's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapmart.llm.common import documents, stored
from snapmart.llm.compression import keep_good
from snapmart.llm.exact_dedup import drop_copies
from snapmart.llm.ngram_join import keep_one_row_of_each
from snapmart.llm.packing import pack
from snapmart.llm.pii import mask
from snapmart.llm.queries import split_pattern, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands reject go."""
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles one row stays, with the smallest id."""
    return keep_one_row_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"), split_pattern())


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("PII", private),
          ("best-fit packing", packed)]

#: zstandard ratios, the network and the packing search have no SQL; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"pipeline_{at}")
    return docs
