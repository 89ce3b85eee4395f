"""A training corpus from raw documents: the stages in order, each written and read again.

Defined cases of every stage: rows with nulls in any column, empty and very long texts and
repeated rows are ordinary rows, an empty table gives an empty one, and columns are returned
as they are whatever their names; the docstring of each operator says what becomes of such
rows. So of all rows without text one stays after exact dedup, each stage tells rows apart by
number and not by doc_id, and the last stage gives a row without text no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_bpe, decontaminate, exact_dedup, near_dedup, quality
from tidemark.session import materialize, utc

#: Vocabulary of the last stage.
RANKS = "byte_bpe_multi_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exactly_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with n_tokens and ids, and whether the ids decode to the text again."""
    return byte_bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, round_trip=True)


STAGES = [
    ("good_quality", good_quality),
    ("exactly_deduplicated", exactly_deduplicated),
    ("near_deduplicated", near_deduplicated),
    ("decontaminated", decontaminated),
    ("encoded", encoded),
]

#: The first stage is trained, so SQL cannot give the rows; the tests hold every later stage
#: against brute force on the rows of the stage before it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = utc(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
