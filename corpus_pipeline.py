"""A corpus pipeline of five stages, from ``documents`` to packed sequences.

Each stage takes the documents that its predecessor kept, decides on all of
them, and returns the documents it keeps with their columns; the last returns
the packed pieces. Between stages the table is written as Parquet and read
again, so a lost executor costs a stage at most.

Missing texts and texts without a letter go with the first stage. Rows without
``doc_id`` have no place in an order: they stay through line deduplication, and
the near-duplicate stage keeps them. Repeated rows are one document there, of
which one row stays; two texts of one ``doc_id`` are two documents. An empty table gives no rows. Extra columns are carried
along, whatever their names, up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditlake.llm import language, line_dedup, packing, simhash, suffix_dedup
from creditlake.llm.common import fold, table
from creditlake.staging import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.keep_identified(docs, fold("doc_id") != 0)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of repeated three-line windows."""
    return line_dedup.dedup_lines(docs)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints of three-word shingles link at two bits or fewer."""
    return simhash.keep_first(docs)


def dedup_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that also start elsewhere."""
    return suffix_dedup.dedup_strings(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near copies", dedup_near_copies),
    ("strings", dedup_strings),
    ("packing", pack_sequences),
]

# Training, fingerprints and tokenizers have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
