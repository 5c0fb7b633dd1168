"""Corpus pipeline: toxicity, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every stage but the
last returns documents with the columns it was given. ``run`` writes what a stage
returns as Parquet in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from branchbook.llm import decontam, minhash, packing, sufdedup, toxicity
from branchbook.llm.common import stored
from branchbook.llm.queries import rank_file, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return minhash.deduplicate(docs)


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur more than once leave the texts."""
    return sufdedup.cleaned(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 1024 tokens."""
    return packing.pack(docs, rank_file(), added=rank_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("suffix_dedup", repeats_out),
    ("decontamination", benchmark_out),
    ("packing", packed),
]
# Trained weights, MinHash signatures and a linear program decide the rows: no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
