"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark
decontamination, mixing sources to target weights.

Every stage works on all that its predecessor kept; each but the last returns the
columns of its input. Stages are written as Parquet in the shared folder and read
again, so a lost executor costs at most the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickframe.llm import classify, decontam, exact, mixing, simhash
from tickframe.llm.common import table
from tickframe.session import scratch_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored 0.3 or more. Learns from the labelled rows that
    ``op3`` learns from; null and empty texts stay."""
    train = classify.training_labels(table(spark, sf_dir, "labels"), "toxic", 4, 2)
    return classify.drop_toxic(docs, classify.fit_toxic(docs, train), 0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) the document with the largest id stays."""
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints within 2 bits the smallest id stays."""
    return simhash.drop_near_copies(docs, shingle=3, radius=2, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that repeat a benchmark item."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as it is drawn, with its number of the ``copy``."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, most=2.0)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources", mixing_sources)]

#: Neither the learned toxicity model nor XXH64 fingerprints can be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
