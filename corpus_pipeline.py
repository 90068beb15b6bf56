"""The corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the
shared folder and rereads it as the next stage's documents. All stages but the last return the columns of
documents. Stages decide by rows: a row with a null or repeated id goes or stays for what it holds itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mqstream.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from mqstream.llm.common import saved, settled, small, table
from mqstream.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no stated language, or not surely in one, go. The verdict follows from a row's text, language and source,
    so 128 bits of their hashes tell which rows it is on."""
    said = [F.coalesce(c, F.lit("")) for c in ("text", "lang", "source")]
    keys = [F.xxhash64(*said).alias("k1"), F.xxhash64(F.lit(1), *said).alias("k2")]
    found = language_id.identify(language_id.of_documents(docs, *keys))
    gone = settled(found.where(~F.col("accepted")).select("k1", "k2").distinct(), "rejected")
    return docs.select("*", *keys).join(small(gone), ["k1", "k2"], "left_anti").select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    return line_dedup.dedup(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, as set for stages, similarity 0.8."""
    return near_dedup.one_of_each(docs, words=5).select(COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    return packing.pack(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Language ID, MinHash and packing are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
