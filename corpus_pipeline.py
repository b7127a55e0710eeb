"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs``. Null texts fail the first stage; documents are told apart by doc_id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rescuelens.llm import decontamination, line_dedup, near_dedup, packing, quality, staging


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the trained model."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_rows(docs, quality.train(docs, labels))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; only what is left blank is dropped."""
    return line_dedup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by five-word shingles at 0.8."""
    return near_dedup.first_of_each(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a test item."""
    return decontamination.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids (little-endian unsigned 32 bits), sequence and offset."""
    pieces = packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.sequences(pieces).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "sequence_id",
        F.col("offset").cast("long").alias("offset"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_overlap),
    ("packing", packed_sequences),
]

# tokenising and the trained model have no SQL; tests hold the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
