"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift.llm import decontamination, licenses, merkle, mixing, quality, search, secret_scan, simhash, substrings, token_store, toxicity, urls, warc
from cohortlift.llm.common import own_folder, read


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), size=4, words=1, threshold=4)
    return found.select("doc_id", F.lower(F.hex("print")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixed(read(spark, sf_dir, "documents")).withColumn("first_position", F.get("positions", F.lit(0)))
    listed = F.array_join(F.transform("positions", lambda p: F.format_string("%.6f", p)), ",").alias("positions")
    plan = plan.select("doc_id", "size", "source_size", "target", "taken", "copies", "first_position", listed)
    return plan.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("spans")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(read(spark, sf_dir, "pages"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read(spark, sf_dir, "documents"), own_folder(spark, "tokens")
    token_store.write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.digests(token_store.read(spark, folder, docs.schema["doc_id"].dataType.simpleString()))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_substrings, op3_mixing, op4_decontamination, op5_secrets, op6_quality, op7_warc, op8_urls, op9_licenses, op10_toxicity,
        op11_tokens, op12_search, op13_merkle)
}
