"""Corpus pipeline: the stages a training corpus passes, in order.

Each stage takes ``(spark, docs, sf_dir)``, ``docs`` being what the stage
before it kept, and returns a frame that is written as Parquet and read again
as the next stage's ``docs``.  All but the last return the columns of
``documents``, whatever these are; the last returns token ids.

Edge cases: an empty table passes every stage empty; null texts are treated as
empty texts, which the quality classifier judges by their statistics; rows
are dropped by id and text, so texts that share a null or other id are judged
one by one; a null id passes the near-duplicate stage; repeated rows are one
document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonage.llm import bpe, decontaminate, exact_dedup, jaccard_join, quality, queries
from zonage.llm.common import settled
from zonage.session import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 1/2 go; the classifier is the one of query
    op8, fitted on the labelled training rows of the whole table."""
    return quality.keep_good(docs, queries.quality_model(spark, sf_dir))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, only the row with the largest doc_id goes on."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the smallest doc_id goes on."""
    return jaccard_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed as little-endian unsigned 32-bit
    integers, their number, and the SHA-256 of the text that they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.encode_and_decode(docs, path, pattern)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                          F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("jaccard_join", near_stage),
          ("decontaminate", benchmark_stage), ("byte_bpe", token_stage)]

# The quality model and the byte-pair merges can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
