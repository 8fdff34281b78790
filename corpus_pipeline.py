"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order; each result is written as Parquet to the
shared folder and read back as the next stage's documents, so a lost executor
costs the tasks of one stage.  When it is written, the stage's own scratch
tables and the documents it was given are removed.  All stages but the last
return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import decontaminate, neardup, packing, quality_rules, substring
from mercato.llm.common import read_table, remove_scratch, scratch_made, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers go (operator 3)."""
    return quality_rules.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (operator 5)."""
    return neardup.deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages seen before are cut out of the texts (operator 10)."""
    return substring.dedup_substrings(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts (operator 7)."""
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in training sequences (operator 2)."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Iterated estimates, rolling hashes and a tokenizer are beyond SQL; the
# tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, given = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        before = len(scratch_made(spark)) - len(given)
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        *done, output = scratch_made(spark)[before:]
        remove_scratch(spark, done)
        given = [output]
    return docs
