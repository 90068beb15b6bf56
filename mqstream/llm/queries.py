"""The corpus operators as driver queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontaminate, language_id, license_scan, line_dedup, near_dedup, packing, quality, resharding, secret_scan
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and web pages, each with its own kind of host; one text model."""
    docs = language_id.of_documents(table(spark, sf_dir, "documents")).withColumn("page_id", F.lit(None).cast("long"))
    pages = language_id.of_pages(table(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    return language_id.identify(docs.unionByName(pages))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op8_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.digest(resharding.reshard(table(spark, sf_dir, "documents")))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_ann": op7_ann,
    "op8_resharding": op8_resharding,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
}

ORACLES: dict[str, str] = {
    "op1_near_dedup": near_dedup.SQL,
    "op4_secret_scan": secret_scan.sql(),
    "op7_ann": ann.SQL,
    "op9_license_scan": license_scan.sql(),
    "op10_line_dedup": line_dedup.SQL,
}
