"""From raw documents to a training mix: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cohortlift.llm import decontamination, mixing, quality, secret_scan, simhash
from cohortlift.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the posterior of the votes reject go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays. Five-word shingles and 192 bits in three words: documents link if 7 bits or fewer differ in a word
    and 39 or fewer in all, which is the number expected at a Jaccard similarity of 0.8 (29) and two deviations."""
    return simhash.one_of_each(docs, size=5, words=3, threshold=7, total=39)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; a document of nothing else goes."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order."""
    return mixing.training_order(docs)


STAGES = [
    ("quality", quality_rules),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", scan_secrets),
    ("mixing", mix_sources),
]

#: No SQL: anchors, components and expectation-maximisation are no single statement. tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared folder before the next reads it."""
    steps = [f for _, f in STAGES]
    docs = reduce(lambda d, f: stored(f(spark, d, sf_dir)), steps[:-1], read(spark, sf_dir, "documents"))
    return steps[-1](spark, docs, sf_dir)
