"""Documents to a training mix: quality rules, toxicity, near duplicates, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxrisk.llm import jaccard, line_rules, mixing, spaced_seeds, toxicity
from wxrisk.llm.common import stages, table
from wxrisk.session import scratch_block


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, then documents that the rules reject."""
    return line_rules.keep_clean(docs)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from labels that are not held out."""
    return toxicity.keep_harmless(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8 or more."""
    return jaccard.one_of_each_group(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return spaced_seeds.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy of a document that it takes."""
    return mixing.emitted(docs)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", harmless),
    ("ngram_jaccard_join", distinct),
    ("benchmark_decontamination", decontaminated),
    ("mixing", mix),
]

#: The near-duplicate and toxicity stages cannot be expressed in SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    When a stage is written, what it staged itself and the result before it are deleted.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        stage = stages(docs, f"pipeline-{name}")
        with scratch_block():
            docs = stage(step(spark, docs, sf_dir), name)
        if before:
            before.remove()
        before = stage
    return docs
