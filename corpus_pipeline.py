"""The corpus pipeline: raw documents in, packed training sequences out.

Each stage is one of the operators in ``letterlake.llm`` and works on all that its predecessor kept.
A document whose text or id is null is a document like any other (see the operators).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from letterlake.llm import decontamination, exact_dedup, ngram_join, packing, quality
from letterlake.llm.common import kept, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def alike_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word 5-gram sets with a Jaccard similarity of 0.8 or more."""
    return ngram_join.drop_alike(docs, n=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", alike_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

# Perplexities and token ids are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
